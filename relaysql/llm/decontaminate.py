"""Operator 1: benchmark decontamination with suffix arrays of the training texts.

Each slice of training texts is a shard: its words become numbers of the
benchmark's vocabulary (exact lookup; other words end a run, nothing that holds
one can match), and the suffixes that run long enough to hold a window are sorted
into an array. Every test suffix is searched in it by its first ``WINDOW`` words,
and each place found is extended to the longest verbatim match. A match is
reported once, from its leftmost word: item, place in the item, place in the
document, length, all in words. The texts are never shuffled.

The benchmark is the query set. Its size is measured, and it is broadcast in
blocks of at most ``BLOCK_BYTES`` of text. One pass searches up to ``STEP_BYTES`` of blocks
(their arrays, all held by a worker) with one Python worker per task. A benchmark beyond
that takes further passes over the same rows, stored in between with what was found, so that a worker's
memory is bounded whatever the benchmark's size; a single block is always one pass.

Null texts have no words. A null item id marks words, but is not listed or
counted; items with one id count once. Repeated documents each get a row. Empty
tables: no documents give no rows, no items give no hits. Other columns of the
documents are not read by ``find_matches``; ``remove_contaminated`` returns them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import LOWER, bounded_blocks, flat_bytes, release, slices, table, words, written
from relaysql.session import ship_package

WINDOW = 10
SLICE_BYTES = 16 << 20
BLOCK_BYTES = 4 << 20       # its arrays take some 20 times as much
STEP_BYTES = 256 << 20
PAIRS_AT_ONCE = 1 << 20

# The words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True

MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))
SCHEMA = ("n_words bigint, matches array<struct<item_id:string,item_start:bigint,start:bigint,length:bigint>>")


def text_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    data, offsets = flat_bytes(column)
    return words(LOWER[data], offsets, _INSIDE)


class TestSuffixes:
    """The benchmark's words as numbers, and its suffixes that begin a window."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        found, first = text_words(pa.array([t for _, t in items], pa.string()))
        coded = found.dictionary_encode()
        self.ids = [i for i, _ in items]
        self.vocabulary = coded.dictionary
        self.window = window
        self.seq = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1       # 0 is no word
        n = np.diff(first)
        self.item = np.repeat(np.arange(len(items)), n)                # of each word
        self.first, self.end = first[:-1][self.item], first[1:][self.item]
        self.need = np.minimum(window, n)[self.item]                   # words of a window
        self.suffix = np.flatnonzero(self.end - np.arange(len(self.seq)) >= self.need)
        at = self.suffix[:, None] + np.arange(window)
        rows = np.where(np.arange(window) < self.need[self.suffix][:, None], self.seq[np.minimum(at, max(len(self.seq) - 1, 0))], 0)
        # windows with one text are searched once
        self.low, self.which = np.unique(keys(rows), return_inverse=True) if len(rows) else (keys(rows), np.zeros(0, np.int64))
        width = np.zeros(len(self.low), np.int64)
        width[self.which] = self.need[self.suffix]
        above = self.low.view(">u4").reshape(-1, window).astype(np.int64)
        self.high = keys(np.where(np.arange(window) < width[:, None], above, 0xFFFFFFFF))
        order = np.argsort(self.which, kind="stable")
        self.members = self.suffix[order]                              # test suffixes by distinct window
        self.member_at = np.searchsorted(self.which[order], np.arange(len(self.low) + 1))
        self.least = int(self.need[self.suffix].min()) if len(self.suffix) else window
        self.nbytes = self.vocabulary.nbytes + sum(a.nbytes for a in vars(self).values() if isinstance(a, np.ndarray))


def keys(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as fixed-width strings that sort alike."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


class ShardSuffixes:
    """The suffix array of one shard."""

    def __init__(self, column: pa.Array, test: TestSuffixes):
        found, self.first = text_words(column)
        code = pc.index_in(found, value_set=test.vocabulary)
        self.seq = pc.fill_null(code, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        n = len(self.seq)
        # where the run of known words that a word stands in ends; texts end runs too
        stops = np.unique(np.concatenate([np.flatnonzero(self.seq == 0), self.first, [n]]))
        self.run_end = stops[np.minimum(np.searchsorted(stops, np.arange(n), side="right"), len(stops) - 1)] if n else stops[:0]
        known = np.flatnonzero((self.seq > 0) & (self.run_end - np.arange(n) >= test.least))
        at = known[:, None] + np.arange(test.window)
        rows = np.where(at < self.run_end[known][:, None], self.seq[np.minimum(at, max(n - 1, 0))] if n else 0, 0)
        key = keys(rows)
        order = np.argsort(key, kind="stable")
        self.array, self.key = known[order], key[order]

    def matches(self, test: TestSuffixes):
        """(test word, shard word, length) of every longest match, in bounded portions."""
        low, high = np.searchsorted(self.key, test.low), np.searchsorted(self.key, test.high, side="right")
        for w in np.flatnonzero(high > low):
            members = test.members[test.member_at[w]:test.member_at[w + 1]]
            step = max(1, PAIRS_AT_ONCE // len(members))
            for a in range(low[w], high[w], step):
                p = self.array[a:min(a + step, high[w])]
                t, p = np.repeat(members, len(p)), np.tile(p, len(members))
                # a pair whose words before it agree is part of a longer match
                inner = (t > test.first[t]) & (p > 0) & (self.seq[p - 1] == test.seq[t - 1]) & (self.run_end[p - 1] == self.run_end[p])
                t, p = t[~inner], p[~inner]
                length = test.need[t].copy()
                open_ = np.arange(len(t))
                while len(open_):
                    a_, b_ = t[open_] + length[open_], p[open_] + length[open_]
                    go = (a_ < test.end[t[open_]]) & (b_ < self.run_end[p[open_]])
                    go[go] = test.seq[a_[go]] == self.seq[b_[go]]
                    open_ = open_[go]
                    length[open_] += 1
                yield t, p, length


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES, step_bytes: int = STEP_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (or the columns ``carry``), n_words and matches of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    kept = [F.col(c) for c in carry] if carry else [F.col(id_col).cast("bigint").alias("doc_id")]
    df = docs.select(F.struct(*kept).alias("_row"), F.col(text_col).cast("string").alias("_text"),
                     F.lit(0).cast("bigint").alias("n_words"),
                     F.expr("CAST(array() AS array<struct<item_id:string,item_start:bigint,start:bigint,length:bigint>>)").alias("matches"))
    row_type = df.schema["_row"].dataType.simpleString()
    out = f"_row {row_type}, _text string, {SCHEMA}"
    step, size, before = [], 0, None
    for block in bounded_blocks(items, "octet_length(coalesce(text, '')) + 16", "item_id, text", block_bytes):
        test = TestSuffixes([(r["item_id"], r["text"]) for r in block], window)
        if step and size + test.nbytes > step_bytes:
            stored = written(df.mapInArrow(_searcher(step), out), "decontaminate-step")
            if before is not None:
                release(before)
            df = before = stored
            step, size = [], 0
        step.append(spark.sparkContext.broadcast(test))
        size += test.nbytes
    df = df.mapInArrow(_searcher(step), out)
    return df.select("_row.*", "n_words", "matches")


def _searcher(blocks: list):
    def search(batches):
        tests = [block.value for block in blocks]
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                found, n_words = [[] for _ in range(len(part))], np.zeros(len(part), np.int64)
                for test in tests:
                    shard = ShardSuffixes(part.column("_text"), test)
                    n_words = np.diff(shard.first).astype(np.int64)
                    for t, p, length in shard.matches(test):
                        doc = np.searchsorted(shard.first, p, side="right") - 1
                        for d, ti, pi, n in zip(doc.tolist(), t.tolist(), p.tolist(), length.tolist()):
                            found[d].append({"item_id": test.ids[test.item[ti]], "item_start": ti - int(test.first[ti]),
                                             "start": pi - int(shard.first[d]), "length": n})
                before = part.column("matches")
                if before.values is not None and len(before.values):
                    found = [a + b for a, b in zip(before.to_pylist(), found)]
                yield pa.RecordBatch.from_arrays([
                    part.column("_row"), part.column("_text"), pa.array(n_words),
                    pa.array(found, MATCH)], names=["_row", "_text", "n_words", "matches"])
    return search


# words under any match: matches in order of their starts, each adding what lies beyond the last end
N_HIT = """aggregate(array_sort(transform(matches, m -> struct(m.start AS a, m.start + m.length AS b))),
  named_struct('upto', 0L, 'n', 0L),
  (s, x) -> named_struct('upto', greatest(s.upto, x.b), 'n', s.n + greatest(0L, x.b - greatest(s.upto, x.a))), s -> s.n)"""
ITEMS = "array_sort(array_distinct(filter(transform(matches, m -> m.item_id), i -> i IS NOT NULL)))"


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    columns = tuple(docs.columns)
    packed = docs.select(F.struct(*(F.col(c) for c in columns)).alias("_all"), F.col(text_col).alias("_in"))
    return find_matches(packed, benchmark, text_col="_in", carry=("_all",)).where("size(matches) = 0").select("_all.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.selectExpr("doc_id", "n_words", f"{N_HIT} AS n_hit", f"{ITEMS} AS items").selectExpr(
        "doc_id", "n_words", "n_hit", "CAST(size(items) AS BIGINT) AS n_items",
        "sha2(array_join(items, ','), 256) AS items_sha256", "n_hit > 0 AS contaminated")


ORACLE = r"""
WITH low AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, doc_id AS n, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR), item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT kind, id, n, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM low),
item_windows AS (
  SELECT id, least(10, len(words)) AS k, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS p, words FROM w WHERE kind = 'b' AND len(words) > 0),
iw AS (SELECT DISTINCT id, k, list_slice(words, p, p + k - 1) AS win FROM item_windows),
ks AS (SELECT DISTINCT k FROM iw),
doc_windows AS (
  SELECT n, k, unnest(range(1, len(words) - k + 2)) AS p, words FROM w, ks WHERE kind = 'd' AND len(words) >= k),
hits AS (
  SELECT d.n, d.p, d.k, iw.id FROM (SELECT n, k, p, list_slice(words, p, p + k - 1) AS win FROM doc_windows) d
  JOIN iw ON iw.k = d.k AND iw.win = d.win),
hit_words AS (SELECT n, count(DISTINCT q) AS n_hit FROM (SELECT n, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT n, p, k FROM hits)) GROUP BY n),
hit_items AS (SELECT n, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS items FROM hits GROUP BY n)
SELECT w.n AS doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit_words h ON h.n = w.n LEFT JOIN hit_items i ON i.n = w.n WHERE kind = 'd'
"""
