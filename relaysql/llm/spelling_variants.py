"""Operator 13: spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point makes them equal,
that is if common prefix plus common suffix reach the longer length less one. One edit
leaves the first half of the shorter word alone, or all after it, so words are compared
in blocks that share a length and a half: each word lies in four, by its own length and
by one less (where it is the longer), by the front and by the back. A block of more than
``TILE`` words is dealt into tiles by the words' hash, each pair of tiles is a task's
unit of its own, and a tile is sent once per partner; so no block, however common its
half, is gathered anywhere, and no word is left out.

Within units a task holds the words as padded matrices of code points, once from the
left and once from the right, and compares rows with the rows that follow at every
distance the units have; pairs that are near come out, each from one block only (from a
back block only if the fronts differ).

A word's form is its near word of the largest count (ties: first in code-point order)
if that has ``RATIO`` times the word's count. Counts grow that much with every form, so
a chain has no cycle and at most 19 forms, and five doublings of the way reach its end.

Null texts have no words; repeated rows count again. In the query a row without an id is
hashed with an empty id. Words of any length are compared (matrices hold at most
``CELLS`` cells; a unit of longer words is compared row by row). An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import table, written
from relaysql.session import ship_package

TILE = 256
RATIO = 10
CELLS = 16 << 20
BATCH_ROWS = 1 << 16
DOUBLINGS = 5                      # 2^5 forms: more than a 64-bit count can grow by tens
MOST_HELD = 200_000                # distinct words a task holds before it hands them on

# Words are runs of these letters, A-Z lower-cased; every 31st is misspelt.
LETTER = "[A-Za-zÀ-ÿ]"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPOIL_EVERY = 31
SHORTEST, LEAST_COUNT = 7, 2


def runs(text: bytes, shortest: int = 1) -> Counter:
    """The lower-cased runs of a UTF-8 text that have at least ``shortest`` letters."""
    return Counter(re.findall(f"{LETTER}{{{shortest},}}", text.translate(LOWER).decode()))


def misspelt(doc_id: int | None, run: str) -> str:
    """The query's planted misspelling: one code point less if the hash says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SPOIL_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _as_it_is(doc_id: int | None, run: str) -> str:
    return run


def word_counts(docs: DataFrame, change: Callable[[int | None, str], str] = _as_it_is, shortest: int = SHORTEST,
                least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all texts, for words of at least ``shortest`` code points."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                text = text.as_py()
                for run, n in runs(text, shortest).items() if text else ():
                    word = change(doc_id, run)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) > MOST_HELD:
                    yield out()
                    held.clear()
        yield out()

    found = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _blocks(words: DataFrame) -> DataFrame:
    """(size, side, half, word, n, longer): each word in its four blocks."""
    length = F.length("word")
    parts = []
    for longer in (False, True):                    # as the shorter word, or one of equal length; as the longer
        placed = words.withColumn("length", length).withColumn("size", length - int(longer))
        # what follows the front half of the shorter word is as long in both, but for the edit
        front = F.expr("substring(word, 1, size div 2)")
        back = F.expr("substring(word, length - (size - size div 2) + 1, size - size div 2)")
        for side, half in ((0, front), (1, back)):          # words of one letter share the empty front
            parts.append(placed.where("size > 0").select("size", F.lit(side).alias("side"), half.alias("half"), "word", "n", F.lit(longer).alias("longer")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _units(words: DataFrame) -> DataFrame:
    """Blocks cut in tiles: (size, side, half, a, b, second, word, n, longer), tile pair
    a <= b, ``second`` for the rows of b where they differ."""
    blocks = _blocks(words)
    key = ["size", "side", "half"]
    # a block is worth anything only with two words, one of which is not the longer
    sizes = blocks.groupBy(*key).agg(F.count("*").alias("m"), F.min("longer").alias("useless")).where("m > 1 and not useless")
    placed = blocks.join(sizes.select(*key, F.ceil(F.col("m") / TILE).cast("int").alias("tiles")), key)
    placed = placed.withColumn("tile", F.when(F.col("tiles") == 1, 0).otherwise(F.expr("cast(pmod(xxhash64(word), tiles) as int)")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(
        F.least(t, F.col("tile")).alias("a"), F.greatest(t, F.col("tile")).alias("b"), (t < F.col("tile")).alias("second")))
    return placed.select(*key, "word", "n", "longer", F.inline(pairs))


def _matrix(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded code points from the left, from the right, and the lengths."""
    lengths = np.array([len(w) for w in words])
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    return left, right, lengths


def _first_difference(same: np.ndarray) -> np.ndarray:
    """Per row, how many leading columns are the same."""
    return np.where(same.all(axis=1), same.shape[1], np.argmin(same, axis=1))


def _near(left, right, lengths, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows are one edit apart, and their common prefixes."""
    longer = np.maximum(lengths[i], lengths[j])
    shorter = np.minimum(lengths[i], lengths[j])
    prefix = np.minimum(_first_difference(left[i] == left[j]), shorter)
    suffix = np.minimum(_first_difference((right[i] == right[j])[:, ::-1]), shorter)
    return (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & ~((longer == shorter) & (prefix == longer)), prefix


def near_pairs(words: list[str], unit: np.ndarray, size: np.ndarray, back: np.ndarray, longer: np.ndarray,
               second: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of near words within units, which stand one after the other."""
    coded = [w.encode("latin-1") for w in words]
    found_i, found_j = [], []
    a, n = 0, len(words)
    starts = np.append(np.flatnonzero(np.append(True, unit[1:] != unit[:-1])), n) if n else np.zeros(1, np.int64)
    u = 0
    while a < n:
        # as many whole units as the matrices may hold, at least one
        width, v = 0, u
        while v + 1 < len(starts):
            wide = max(width, max(len(w) for w in coded[starts[v]:starts[v + 1]]))
            if v > u and (starts[v + 1] - a) * wide > CELLS:
                break
            width, v = wide, v + 1
        b = int(starts[v])
        left, right, lengths = _matrix(coded[a:b], width) if (b - a) * width <= 4 * CELLS else (None, None, None)
        rows = np.arange(a, b)
        step = max(1, CELLS // max(1, width))
        for d in range(1, int(np.diff(starts[u:v + 1]).max(initial=0))):
            i = rows[:-d][unit[a:b - d] == unit[a + d:b]]
            if not len(i):
                break
            j = i + d
            i, j = (x[~(longer[i] & longer[j]) & (~split[i] | (second[i] != second[j]))] for x in (i, j))
            for k in range(0, len(i), step):
                x, y = i[k:k + step], j[k:k + step]
                if left is None:
                    # very long words: one pair after another, in matrices of two rows
                    tested = [_near(*_matrix([coded[p], coded[q]], width), np.array([0]), np.array([1])) for p, q in zip(x, y)]
                    good, prefix = np.concatenate([t[0] for t in tested]), np.concatenate([t[1] for t in tested])
                else:
                    good, prefix = _near(left, right, lengths, x - a, y - a)
                good &= ~back[x] | (prefix < size[x] // 2)
                found_i.append(x[good])
                found_j.append(y[good])
        a, u = b, v
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j])


_PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("other_n", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) < BATCH_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        unit = _unit_numbers(rows)
        cut = int(np.searchsorted(unit, unit[-1]))          # the last unit may go on
        if cut:
            yield from _pairs(rows.slice(0, cut), unit[:cut])
        held = rows.slice(cut).combine_chunks().to_batches()
    if held and sum(len(b) for b in held):
        rows = pa.Table.from_batches(held).combine_chunks()
        yield from _pairs(rows, _unit_numbers(rows))


def _unit_numbers(rows: pa.Table) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    for name in ("size", "side", "half", "a", "b"):
        c = rows.column(name)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        if len(c) > 1:
            new[1:] |= pa.compute.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return np.cumsum(new)


def _pairs(rows: pa.Table, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = rows.column("word").to_pylist()
    n = rows.column("n").to_numpy()
    col = lambda name: rows.column(name).to_numpy()
    i, j = near_pairs(words, unit, col("size"), col("side") == 1, col("longer"), col("second"), col("a") != col("b"))
    for x, y in ((i, j), (j, i)):
        for k in range(0, len(x), BATCH_ROWS):
            p, q = x[k:k + BATCH_ROWS], y[k:k + BATCH_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([words[r] for r in p], pa.string()), pa.array(n[p]),
                                              pa.array([words[r] for r in q], pa.string()), pa.array(n[q])], schema=_PAIRS)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all near pairs of the distinct ``words`` (word, n), both ways."""
    ship_package(words.sparkSession)
    key = ["size", "side", "half", "a", "b"]
    units = _units(words).repartition(*key).sortWithinPartitions(*key)
    return units.mapInArrow(_compare, "word string, n long, other string, other_n long")


def spelling_variants(counts: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``counts`` (word, n)."""
    words = written(counts, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    seen = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    formed = F.col("best").isNotNull() & (form_n >= RATIO * F.col("n"))
    judged = written(words.join(seen, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.form")).alias("form"), F.when(formed, form_n).alias("form_n")), "judged")
    way = written(judged.where("form is not null").select("word", F.col("form").alias("root")), "way")
    for _ in range(DOUBLINGS):
        further = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        way = written(way.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "way")
    return judged.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all of ``documents``, every 31st run misspelt."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), change=misspelt))
