"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from relaysql.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: cuts the lineage,
    and survives the loss of any executor."""
    path = shared_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    stored.stored_at = path
    return stored


def release(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, end to end, and ``len + 1`` offsets.
    Null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int):
    """``batch`` cut into runs of rows whose ``column`` holds at most ``limit`` bytes;
    a longer row comes alone. No row is left out."""
    _, offsets = flat_bytes(batch.column(column))
    start, n = 0, len(batch)
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3's constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of bytes for which the 256-entry table ``inside`` holds, text by
    text; and the number of words before each text (one more entry than texts)."""
    keep = inside[data]
    begins = keep.copy()
    if len(data):
        begins[1:] &= ~keep[:-1]
        first = offsets[:-1][offsets[:-1] < len(data)]
        begins[first] = keep[first]                # a word never crosses texts
    starts = np.flatnonzero(begins)
    before = np.concatenate([[0], np.cumsum(keep)])
    ends = np.concatenate([before[starts], before[-1:]]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[keep])])
    return found, np.searchsorted(starts, offsets)


LOWER = np.arange(256, dtype=np.uint8)      # A-Z to a-z, everything else as it is
LOWER[65:91] += 32


def bounded_blocks(df: DataFrame, size: str, key: str, limit: int):
    """The rows of ``df`` as lists of at most about ``limit`` units of the SQL
    expression ``size``: measured first, then dealt by the hash of ``key``. Used for
    query sets and rule lists, which are searched block by block."""
    total = df.selectExpr(f"sum({size}) AS n").first()["n"] or 0
    n = int(2 * total // limit) + 1
    for k in range(n):
        part = df if n == 1 else df.where(f"pmod(xxhash64({key}), {n}) = {k}")
        yield list(part.toLocalIterator())


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(found: pa.Array) -> np.ndarray:
    """A 64-bit hash of each entry of a binary array; each distinct word is hashed once."""
    coded = found.dictionary_encode()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return mix64(own[coded.indices.to_numpy()]) if len(found) else np.zeros(0, np.uint64)
