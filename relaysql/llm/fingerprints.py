"""Operator 12: document fingerprints from content-defined chunks.

A text's UTF-8 bytes are cut where a gear hash of the last 32 bytes falls on a mask,
so equal passages are cut alike wherever they stand. The cuts are normalised: before a
chunk has ``NORMAL`` bytes the mask has more bits than after it, which draws lengths
together; no chunk but a text's last is shorter than ``SHORTEST``, none longer than
``LONGEST``. A fingerprint is the set of distinct chunks, each as digest and length
(``16 hex digits:length``, in order, comma-joined); an empty text has the empty
fingerprint.

``likeness(a, b)`` is the length-weighted containment of a in b: bytes of a's distinct
chunks that b has as well, by the bytes of a's. It is 1 for equal fingerprints (also two
empty ones) and 0 where one only is empty.

``compare_with_edits`` sets each text beside an edited one and the next document's, in
descending order of ids (rows of one id by text, null texts first). Documents are dealt
once, by ranges of ids whose bounds come from approximate quantiles, so that many small
tasks read their range in order, one text ahead; the first row of each range is also
sent to the range before it. No text is gathered and nothing but the bounds (one id a
range) goes through the driver.

Null texts count as empty. A row without an id has no next document: its last half is
cut off, and its next fingerprint is the empty one; such rows are dealt by their texts.
A lone document is its own next one. Repeated rows each get a row. Whole texts are read
whatever their length. Other columns are not read by the query; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import mix64, table
from relaysql.session import ship_package

WINDOW = 32                        # bytes that decide a cut
SHORTEST, NORMAL, LONGEST = 16, 64, 512
STRICT_BITS, LOOSE_BITS = 7, 5     # of the mask before and after NORMAL bytes
RANGE_BYTES, MOST_RANGES = 16 << 20, 1 << 16      # beyond that many, ranges are longer
SLICE_BYTES = 4 << 20

# 256 values of the gear, and a last one for the gap between texts
_GEAR = np.append((mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32), np.uint32(0))


def gear_hashes(codes: np.ndarray) -> np.ndarray:
    """The gear hash that ends at each byte: sum of ``gear[byte] << age`` over ``WINDOW``
    bytes, built by doubling the span."""
    h = _GEAR[codes]
    span = 1
    while span < WINDOW:
        older = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += older
        span *= 2
    return h


def cuts(texts: list[bytes]) -> list[list[int]]:
    """The ends of each text's chunks."""
    gap = np.full(WINDOW, 256, np.uint16)
    parts, starts, at = [], [], 0
    for t in texts:
        parts += [np.frombuffer(t, np.uint8).astype(np.uint16), gap]
        starts.append(at)
        at += len(t) + WINDOW
    if not at:
        return [[] for _ in texts]
    h = gear_hashes(np.concatenate(parts))
    loose = np.flatnonzero((h >> np.uint32(32 - LOOSE_BITS)) == 0)
    strict = (h[loose] >> np.uint32(32 - STRICT_BITS)) == 0
    first = np.searchsorted(loose, starts).tolist()
    last = np.searchsorted(loose, [s + len(t) for s, t in zip(starts, texts)]).tolist()
    loose, strict = loose.tolist(), strict.tolist()
    return [_text_cuts([p - s + 1 for p in loose[a:b]], strict[a:b], len(t)) for t, s, a, b in zip(texts, starts, first, last)]


def _text_cuts(places: list[int], strict: list[bool], n: int) -> list[int]:
    out, start = [], 0
    for end, firm in zip(places, strict):
        while end - start > LONGEST:                # no mask met: cut at the longest
            start += LONGEST
            out.append(start)
        size = end - start
        if size >= SHORTEST and (firm or size >= NORMAL):
            out.append(end)
            start = end
    while n - start > LONGEST:
        start += LONGEST
        out.append(start)
    if start < n:
        out.append(n)
    return out


def chunk_sets(texts: list[bytes]) -> list[dict[str, int]]:
    """Per text, the distinct chunks: digest -> length."""
    out = []
    for t, ends in zip(texts, cuts(texts)):
        found, start = {}, 0
        for end in ends:
            found[hashlib.blake2b(t[start:end], digest_size=8).hexdigest()] = end - start
            start = end
        out.append(found)
    return out


def fingerprint(chunks: dict[str, int]) -> str:
    return ",".join(f"{d}:{n}" for d, n in sorted(chunks.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > SLICE_BYTES:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def with_fingerprints(docs: DataFrame, column: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` and the fingerprint of ``column``; a narrow step."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def prints(texts):
        import pandas as pd

        given = [(t or "").encode() for t in texts]
        return pd.Series([fingerprint(c) for a, b in _slices(given) for c in chunk_sets(given[a:b])], dtype=object)

    return docs.withColumn(name, prints(F.col(column)))


def in_order(docs: DataFrame) -> DataFrame:
    """(part, tail, doc_id, text): ranges of descending ids, each sorted and followed by
    the first row of the next range; the last range by the very first row. Rows without
    an id lie in parts of their own, below 0."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNotNull().alias("given"))
    total = docs.agg(F.sum(F.octet_length("text") + 40).alias("n")).first()["n"] or 0
    spark = docs.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, min(MOST_RANGES, int(total // RANGE_BYTES) + 1))
    bounds = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)).first()[0] or []
    bounds = sorted(set(bounds), reverse=True)      # one id a range
    # range 0 holds the ids above the first bound: as many bounds as are not below the id, by
    # binary search over a constant array
    limits = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)] or [F.lit(1)])
    above = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(limits, at + step - 1) >= F.col("doc_id")), at + step).otherwise(at))
    part = F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(n))).otherwise(above).cast("int")
    placed = docs.withColumn("part", part)
    firsts = placed.where("part >= 0").groupBy("part").agg(F.max("doc_id").alias("first")).orderBy("part").collect()   # one row a range
    heads = [(r["first"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]     # the part before; before the first, the last
    sent = spark.createDataFrame(heads, "head long, to int")
    tails = placed.join(F.broadcast(sent), placed["doc_id"] == sent["head"]).select("doc_id", "text", "given", F.col("to").alias("part"), F.lit(True).alias("tail"))
    rows = placed.withColumn("tail", F.lit(False)).unionByName(tails)
    return rows.repartition(n, "part").sortWithinPartitions("part", "tail", F.desc("doc_id"), "given", "text").select("part", "tail", "doc_id", "text")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None                                     # (part, id, text): waits for the next row
    for batch in batches:
        pairs, rows = [], zip(batch.column("part").to_pylist(), batch.column("tail").to_pylist(),
                              batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
        for part, tail, doc_id, text in rows:
            if held is not None and held[0] == part:
                pairs.append((held[1], held[2], text))
                held = None
            if part < 0:
                pairs.append((doc_id, text, ""))
            elif not tail:
                held = part, doc_id, text
            else:
                held = None                         # more tails: rows of the same id
        yield from _results(pairs)
    # every range ends with a tail, so nothing is held here


def _results(pairs: list) -> Iterator[pa.RecordBatch]:
    size = [len(t) + len(u) for _, t, u in pairs]
    a = 0
    while a < len(pairs):
        b, total = a, 0
        while b < len(pairs) and (b == a or total + size[b] <= SLICE_BYTES):
            total += size[b]
            b += 1
        some = pairs[a:b]
        edits = [edited_text(t, u).encode() for _, t, u in some]
        texts = [t.encode() for _, t, _ in some]
        # a following text is mostly the next row's own
        more = [i for i, (_, _, u) in enumerate(some) if i + 1 == len(some) or some[i + 1][1] is not u]
        own, made = chunk_sets(texts), chunk_sets(edits)
        extra = dict(zip(more, chunk_sets([some[i][2].encode() for i in more])))
        nexts = [extra[i] if i in extra else own[i + 1] for i in range(len(some))]
        yield pa.RecordBatch.from_arrays([
            pa.array([d for d, _, _ in some], pa.int64()), pa.array([len(t) for _, t, _ in some], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edits]), pa.array([fingerprint(c) for c in own], pa.string()),
            pa.array([fingerprint(c) for c in made], pa.string()), pa.array([likeness(o, m) for o, m in zip(own, made)], pa.float64()),
            pa.array([likeness(o, m) for o, m in zip(own, nexts)], pa.float64())], schema=_RESULT)
        a = b


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ship_package(docs.sparkSession)
    return in_order(docs).mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                               "edited_fingerprint string, near_edited double, near_next double")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return compare_with_edits(table(spark, sf_dir, "documents"))
