"""Operator 11: hard-negative mining with LEMP-style coordinate pruning.

Vectors become whole numbers, floor(256 x), and scores are whole inner products. The
searched rows lie in files sorted by label and length; a task cuts them into buckets of
``BUCKET_ROWS``, each with its longest length and, per coordinate, the list of its
directions' values in order. For an anchor and a lowest score that still counts,

* a bucket none of whose lengths can reach the score is passed over;
* on the anchor's ``FOCUS`` largest coordinates the score leaves a range of feasible
  values: if the angle of anchor and row is at most t, their angles with an axis differ
  by at most t. The range is looked up in each sorted list, the shortest list gives the
  candidates, and the others' ranges are intersected with it;
* what is left is verified by its whole inner product.

The lowest score rises while a task reads on, as in a top-k search. First each anchor's
positives are found, then, for the windows that these set, its negatives. Anchors are a
stated query set against all rows: they go in chunks of ``CHUNK_BYTES`` at most, one
pass and one broadcast each, released before the next. A task hands on its best few
per anchor; the best of all are chosen after a shuffle by anchor, where a third of all
rows with one label changes nothing.

Rows with a null id, label or vector, or with a null or non-finite component, take no
part. Of rows with one id, the one with the greatest label (then vector) stands. Rows of
another dimension than the anchor's are not compared with it; empty vectors score 0. Ties
go to the smaller id. Fewer positives or negatives than asked for are all returned; an
anchor without a positive, and an empty table, give no rows. Scores must fit a long:
longer vectors (beyond 2^31 after scaling) raise an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaysql.llm.common import table, written
from relaysql.session import ship_package

BUCKET_ROWS = 4096
TASK_ROWS = 65536                  # rows of a file, at most some
FOCUS = 4
CHUNK_BYTES = 32 << 20
SLACK = 1e-9                       # of angles and lengths, far above a double's error
EXACT = float(1 << 53)             # inner products of doubles below this are whole and exact
LONGEST = float(1 << 31)
NONE = np.iinfo(np.int64).min


def scaled_vectors(embeddings: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, q, length): whole-number vectors in files sorted by label and length."""
    x = F.col("embedding")
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
           & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    q = F.transform(x, lambda c: F.floor(c.cast("double") * 256.0))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(fit)
    rows = rows.select("vec_id", label.cast("long").alias("label"), q.alias("q"))
    one = rows.groupBy("vec_id").agg(F.max(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")
    length = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    one = one.withColumn("length", F.when(length < LONGEST, length).otherwise(F.raise_error(F.lit("scores of such long vectors do not fit a long"))))
    n = max(4 * embeddings.sparkSession.sparkContext.defaultParallelism, embeddings.count() // TASK_ROWS + 1)
    return written(one.repartitionByRange(n, "label", "length", "vec_id").sortWithinPartitions("label", F.desc("length"), "vec_id"), "vectors")


class Bucket:
    """Rows of one dimension: directions, their sorted coordinate lists, length bounds."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.lengths = ids, labels, lengths
        self.q, self.longest = q, float(lengths.max())
        self.exact = q.astype(np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            self.direction = np.where(lengths[:, None] > 0, self.exact / lengths[:, None], 0.0)
        self.order = np.argsort(self.direction, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.direction, self.order, axis=0)
        self.label_range = labels.min(), labels.max()

    def candidates(self, anchor: np.ndarray, norm: float, least: float) -> np.ndarray:
        """Places of all rows whose inner product with ``anchor`` may reach ``least``."""
        every = np.arange(len(self.ids))
        if least <= 0 or not anchor.size:
            return every                            # no angle is too wide
        t = least / (norm * self.longest) if norm * self.longest > 0 else 2.0
        if t > 1 + SLACK:
            return every[:0]
        wide = np.arccos(min(t, 1.0)) + SLACK
        unit = anchor / norm
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(np.pi, angle + wide)) - SLACK, np.cos(np.maximum(0, angle - wide)) + SLACK
        spans = [(np.searchsorted(self.values[:, f], a, "left"), np.searchsorted(self.values[:, f], b, "right"))
                 for f, a, b in zip(focus, low, high)]
        first = int(np.argmin([b - a for a, b in spans]))
        found = self.order[spans[first][0]:spans[first][1], focus[first]]
        for k, f in enumerate(focus):
            if k != first and len(found):
                x = self.direction[found, f]
                found = found[(x >= low[k]) & (x <= high[k])]
        return found

    def scores(self, places: np.ndarray, anchor: np.ndarray, norm: float) -> np.ndarray:
        if norm * self.longest < EXACT:
            return (self.exact[places] @ anchor).astype(np.int64)
        return self.q[places] @ anchor.astype(np.int64)


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        for a in range(0, len(batch), BUCKET_ROWS):
            part = batch.slice(a, BUCKET_ROWS)
            ids, labels, lengths, flat, sizes = _columns(part)
            ends = np.cumsum(sizes)
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                at = (ends[rows] - d)[:, None] + np.arange(d)
                yield Bucket(ids[rows], labels[rows], flat[at].reshape(len(rows), d), lengths[rows])


def _columns(part: pa.RecordBatch):
    q = part.column("q")
    return (np.asarray(part.column("vec_id")), np.asarray(part.column("label")), np.asarray(part.column("length")),
            np.asarray(q.flatten(), dtype=np.int64), np.asarray(q.value_lengths(), dtype=np.int64))


class Best:
    """The best ``k`` (score, id) seen: greater scores first, ties by smaller id."""

    def __init__(self, k: int, low: int = NONE, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """No lower score can still enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if self.high is not None:
            good &= scores <= self.high
        if good.any():
            s, i = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
            first = np.lexsort((i, -s))[:self.k]
            self.scores, self.ids = s[first], i[first]


def _search(batches: Iterator[pa.RecordBatch], anchors: list, same_label: bool) -> None:
    """Offer every row of the same, or of another label to each anchor's lists."""
    for bucket in buckets(batches):
        for anchor_id, label, vector, norm, bests in anchors:
            if vector.size != bucket.q.shape[1]:
                continue
            if same_label and not bucket.label_range[0] <= label <= bucket.label_range[1]:
                continue
            places = bucket.candidates(vector, norm, min(b.least for b in bests))
            places = places[(bucket.labels[places] == label) == same_label]
            if same_label:
                places = places[bucket.ids[places] != anchor_id]
            if len(places):
                scores = bucket.scores(places, vector, norm)
                for best in bests:
                    best.add(scores, bucket.ids[places])


def _chunks(anchors: DataFrame) -> Iterator[pa.Table]:
    """The query set in parts of bounded size, measured first."""
    total = anchors.select(F.sum(8 * F.size("q") + 200).alias("n")).first()["n"] or 0
    n = int(2 * total // CHUNK_BYTES) + 1
    for k in range(n):
        part = (anchors if n == 1 else anchors.where(f"pmod(xxhash64(vec_id), {n}) = {k}")).toArrow()
        if part.num_rows:
            yield part


def _anchor_rows(part: pa.Table):
    part = part.combine_chunks().to_batches()[0]
    ids, labels, lengths, flat, sizes = _columns(part)
    ends = np.cumsum(sizes)
    for i in range(len(ids)):
        yield i, int(ids[i]), int(labels[i]), flat[ends[i] - sizes[i]:ends[i]].astype(np.float64), float(lengths[i])


def _in_passes(rows: DataFrame, anchors: DataFrame, run, schema: str, name: str) -> DataFrame:
    """``run(batches, chunk)`` over all rows for each chunk of anchors, written."""
    spark = rows.sparkSession
    ship_package(spark)
    found = None
    for part in _chunks(anchors):
        sent = spark.sparkContext.broadcast(part)
        done = written(rows.mapInArrow(lambda batches, sent=sent: run(batches, sent.value), schema), name)
        sent.destroy()
        found = done if found is None else found.unionByName(done)
    return found if found is not None else spark.createDataFrame([], schema)


def positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each anchor's first ``k`` rows of its label."""
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def run(batches, part):
        lists = [(a, label, v, norm, [Best(k)]) for _, a, label, v, norm in _anchor_rows(part)]
        _search(batches, lists, same_label=True)
        for a, *_, (best,) in lists:
            if len(best.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best.ids), a)), pa.array(best.ids), pa.array(best.scores)], schema=schema)

    found = _in_passes(rows, anchors, run, "anchor_id long, positive_id long, positive_score long", "positives")
    nth = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    return written(found.withColumn("rank", nth).where(f"rank <= {int(k)}").drop("rank"), "positives")


def hard_negatives(embeddings: DataFrame, anchor: Column, label: Column | None = None, n_positives: int = 5,
                   n_negatives: int = 10, low_percent: int = 30, high_percent: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row of ``embeddings`` (vec_id, embedding, label) for which ``anchor`` holds
    and each of its positives, the best rows of other labels whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's. ``label`` computes the label.
    """
    rows = scaled_vectors(embeddings, F.col("label") if label is None else label)
    anchors = rows.where(anchor)
    pairs = positives(rows, anchors, n_positives)
    windows = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(          # at most n_positives each
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")])

    def run(batches, part):
        given = part.column("positives").to_pylist()
        lists, owners = [], []
        for i, a, own, v, norm in _anchor_rows(part):
            bests = []
            for p in given[i]:
                s = p["positive_score"]
                low, high = -(-low_percent * s // 100), high_percent * s // 100
                if low <= high:                     # never so for negative scores
                    bests.append(Best(n_negatives, low, high))
                    owners.append((a, p["positive_id"], s, bests[-1]))
            if bests:
                lists.append((a, own, v, norm, bests))
        _search(batches, lists, same_label=False)
        for a, p, s, best in owners:
            n = len(best.ids)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, x, np.int64)) for x in (a, p, s)]
                                                 + [pa.array(best.ids), pa.array(best.scores)], schema=schema)

    found = _in_passes(rows, anchors.join(windows, "vec_id"), run,
                       "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", "negatives")
    nth = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", nth).where(f"rank <= {int(n_negatives)}").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``; anchors are the rows whose id is divisible by 100."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=moved)


ORACLE = """
WITH v AS (
  SELECT vec_id, max({'label': CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END,
                      'q': [floor(256 * x::DOUBLE) for x in embedding]}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id
), rows_ AS (SELECT vec_id, r.label AS label, r.q AS q FROM v
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0
), pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM pos p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
