"""Operator 3: repeated strings removed with external induced sorting.

Every byte that a 100-byte string covers which also starts earlier (smaller id, or
earlier in the same text) is removed. The order of all suffixes is never written
out; it is induced from sample suffixes, as induced sorting does:

* Sample positions are chosen by content: the position whose 32-byte gram has the
  smallest hash among the grams of a window. Equal windows choose equal samples,
  so a window is compared only with windows around samples of one gram.
* A sample's run is the windows that chose it. Runs that agree as a whole are one
  class (named by a hash of all their bytes, as induced sorting names equal
  substrings), and all but the first run of a class are repeats. Grams that occur
  in one class only are done.
* The suffixes at the remaining samples are sorted by Spark's external sort, per
  shard of a 66-byte key, with the common prefix of neighbours. From them the
  suffixes one, two, three ... bytes further left are induced: tuples leave the
  order of one step, go into a queue of 256 buckets by the byte before them, and
  come out in the order of the next step, their common prefix one more than the
  least they passed. Where 100 bytes are common, all but the earliest are repeats.
  A shard is taken through this in portions; of one that exceeds a portion, the
  queues and the bytes are kept in files, so memory is bounded by the portion.

A class is handed on once per slice of texts with its first member, the others
being known repeats, so copies in great numbers do not pile up under a key. Which
grams go through the second scan is told by a bitmap of fixed size; what it lets
through by accident is sorted and found unique.

Null texts are empty. Rows with one id are ordered by a hash of their text; rows
equal in id and text are one document, each with its result. A null id comes
last. Texts of any length are taken in blocks. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import _BASE, _INVERSE, _powers, flat_bytes, mix64, slices, table, written
from relaysql.session import ship_package

LENGTH = 100                       # bytes of a repeated string
GRAM = 32
REACH = LENGTH - GRAM              # a sample lies at most this far behind its window's start
SIDE = REACH // 2                  # of the bytes beside the gram, one side has at least so many
SLICE_BYTES = 8 << 20
BLOCK = 1 << 20                    # window starts handled at once
PORTION = 1 << 15                  # suffix tuples held in memory at once
BITMAP_BITS = 27
APART = -1000                      # common prefix of suffixes in different shards

_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_POWERS: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _POWERS:
        _POWERS.extend([_powers(_BASE, BLOCK + LENGTH + 1), _powers(_INVERSE, BLOCK + LENGTH + 1)])
    return _POWERS


def runs(data: np.ndarray, offsets: np.ndarray):
    """Blocks of (first window, last window, sample, gram hash, hash of all the run's bytes)."""
    up, down = _tables()
    last_start = np.repeat(offsets[1:] - LENGTH, np.diff(offsets))     # of a window, per byte
    for b0 in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        b1 = min(b0 + BLOCK, len(data) - LENGTH + 1)                    # window starts b0..b1-1
        part = data[b0:b1 + LENGTH - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODE[part] * up[:len(part)])])
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * down[:len(part) - GRAM + 1])
        # smaller hash first, then the rightmost
        least = (grams & ~np.uint64((1 << 24) - 1)) | (np.uint64((1 << 24) - 1) - np.arange(len(grams), dtype=np.uint64))
        span, width = 1, REACH + 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:-(width - span)], least[width - span:])
        sample = ((1 << 24) - 1 - (least & np.uint64((1 << 24) - 1)).astype(np.int64))
        at = np.arange(b1 - b0)
        whole = at + b0 <= last_start[b0:b1]                            # the window lies in one text
        head = whole.copy()
        head[1:] &= ~(whole[:-1] & (sample[1:] == sample[:-1]))
        first = np.flatnonzero(head)
        tail = whole.copy()
        tail[:-1] &= ~(whole[1:] & (sample[1:] == sample[:-1]))
        last = np.flatnonzero(tail)
        a = sample[first]
        body = mix64((sums[last + LENGTH] - sums[first]) * down[first]) ^ mix64((
            (last - first).astype(np.uint64) << np.uint64(8)) | (a - first).astype(np.uint64))
        yield first + b0, last + b0, a + b0, grams[a], mix64(body)


class Runs:
    """All runs of a slice; of each class the first run, the others as repeats."""

    def __init__(self, part: pa.RecordBatch):
        self.data, self.offsets = flat_bytes(part.column("text"))
        found = list(runs(self.data, self.offsets)) or [tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))]
        self.first, self.last, self.sample, self.gram, self.body = (np.concatenate(x) for x in zip(*found))
        doc, tie = (part.column(c).to_numpy() for c in ("doc", "tie"))
        self.text = np.searchsorted(self.offsets, self.first, side="right") - 1
        self.doc, self.tie = doc[self.text], tie[self.text]
        self.begin = self.offsets[self.text]
        name = mix64(self.gram ^ mix64(self.body))
        order = np.lexsort((self.first - self.begin, self.tie, self.doc, name))
        again = np.zeros(len(order), bool)
        again[1:] = name[order][1:] == name[order][:-1]
        lead = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))]
        # a row equal in id and text is the same document, not a repeat
        same = (self.doc[order] == self.doc[lead]) & (self.tie[order] == self.tie[lead]) & (
            self.first[order] - self.begin[order] == self.first[lead] - self.begin[lead])
        self.heads = np.sort(order[~again])
        self.repeats = np.sort(order[again & ~same])


def merged(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping or touching spans of a document put together."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    if not len(doc):
        return doc, tie, start, end
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])])
    # running furthest end within a document: lift each document above all before it
    lift = np.cumsum(new) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    new[1:] |= (start + lift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], tie[at], start[at], np.maximum.reduceat(end, at)


RUN, SPAN, GRAMS = 0, 1, 2
ROWS = ["tag", "gram", "body", "doc", "tie", "start", "end"]
ROWS_SCHEMA = "tag tinyint, gram bigint, body bigint, doc bigint, tie bigint, start bigint, end bigint"


def _rows(tag: int, n: int, **columns: np.ndarray) -> pa.RecordBatch:
    zero = np.zeros(n, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, tag, np.int8)), *(pa.array(columns.get(c, zero)) for c in ROWS[1:])], names=ROWS)


def _spans(doc, tie, start, end) -> pa.RecordBatch:
    doc, tie, start, end = merged(doc, tie, start, end)
    return _rows(SPAN, len(doc), doc=doc, tie=tie, start=start, end=end)


def _classes(docs: DataFrame) -> DataFrame:
    """Spans of runs that repeat an earlier run as a whole, and the grams (tag GRAMS)
    that stand in several classes."""
    def make(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                r = Runs(part)
                h, x = r.heads, r.repeats
                yield _rows(RUN, len(h), gram=r.gram[h].view(np.int64), body=r.body[h].view(np.int64), doc=r.doc[h], tie=r.tie[h],
                            start=r.first[h] - r.begin[h], end=r.last[h] - r.begin[h] + LENGTH)
                yield _spans(r.doc[x], r.tie[x], r.first[x] - r.begin[x], r.last[x] - r.begin[x] + LENGTH)

    def gather(batches):
        held = {c: [] for c in ROWS[1:]}
        for batch in batches:
            run = batch.column("tag").to_numpy() == RUN
            if not run.all():
                yield batch.filter(pa.array(~run))
            for c in held:
                held[c].append(batch.column(c).to_numpy()[run])
        if not held["gram"]:
            return
        gram, body, doc, tie, start, end = (np.concatenate(held.pop(c)) for c in ROWS[1:])
        order = np.lexsort((start, tie, doc, body, gram))
        gram, body, doc, tie, start, end = (x[order] for x in (gram, body, doc, tie, start, end))
        gram_new = np.concatenate([[True], gram[1:] != gram[:-1]])[:len(gram)]
        class_new = gram_new.copy()
        class_new[1:] |= body[1:] != body[:-1]
        lead = np.maximum.accumulate(np.where(class_new, np.arange(len(gram)), 0))
        again = (doc != doc[lead]) | (tie != tie[lead]) | (start != start[lead])
        yield _spans(doc[again], tie[again], start[again], end[again])
        several = np.unique(gram[class_new & ~gram_new])
        yield _rows(GRAMS, len(several), gram=several)

    dealt = docs.mapInArrow(make, ROWS_SCHEMA).repartition(F.when(F.col("tag") == RUN, F.col("gram")).otherwise(F.col("doc")))
    return written(dealt.mapInArrow(gather, ROWS_SCHEMA), "dedup-classes")


def _bitmap(grams: DataFrame) -> np.ndarray:
    """The low bits of the grams as a bitmap: at most 2 ** (BITMAP_BITS - 15) pieces of 4 KB."""
    at = F.expr(f"gram & {(1 << BITMAP_BITS) - 1}L")
    pieces = grams.select(at.alias("at")).groupBy(F.expr("shiftright(at, 15)").alias("piece")).agg(
        F.expr("bitmap_construct_agg(CAST(at & 32767 AS INT))").alias("bits"))
    out = np.zeros((1 << (BITMAP_BITS - 15), 4096), np.uint8)
    for r in pieces.toLocalIterator():
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    n = end - start
    edge = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(edge[-1]) - np.repeat(edge[:-1], n) + np.repeat(start, n)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(data[at])])


TUPLES = "shard bigint, doc bigint, tie bigint, sample bigint, low int, high int, before binary, after binary"


def _tuples(docs: DataFrame, bitmap) -> DataFrame:
    """Suffix tuples of the samples whose gram stands in several classes: the bytes after
    the sample, those before it, and the distances (low..high) of its windows. Windows
    with many bytes after the gram and those with many before it go to shards of their own."""
    def make(batches):
        bits = bitmap.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                r = Runs(part)
                at = (r.gram & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                h = r.heads[((bits[at[r.heads] >> 3] >> (at[r.heads] & 7)) & 1) == 1]
                a, low, high = r.sample[h], r.sample[h] - r.last[h], r.sample[h] - r.first[h]
                for side in (0, 1):
                    lo = low if side == 0 else np.maximum(low, SIDE + 1)
                    hi = np.minimum(high, SIDE) if side == 0 else high
                    use = np.flatnonzero(lo <= hi)
                    if not len(use):
                        continue
                    s, lo, hi = a[use], lo[use], hi[use]
                    # the key: the gram and SIDE bytes that all these windows have, after or before it
                    k0 = s if side == 0 else s - SIDE
                    key = np.zeros(len(s), np.uint64)
                    for i in range(GRAM + SIDE):
                        key = (key ^ _CODE[r.data[k0 + i]]) * np.uint64(0x9FB21C651E98DF25)
                        key ^= key >> np.uint64(29)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix64(key ^ np.uint64(side)).view(np.int64)), pa.array(r.doc[h][use]), pa.array(r.tie[h][use]),
                         pa.array(s - r.begin[h][use]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                         _cut(r.data, s - hi, s), _cut(r.data, s, s + LENGTH - lo)],
                        names=["shard", "doc", "tie", "sample", "low", "high", "before", "after"])
    return docs.mapInArrow(make, TUPLES)


class Filed:
    """Arrays kept in an unlinked file and mapped."""

    def __init__(self, *arrays: np.ndarray):
        self.shapes = [(x.dtype, x.shape) for x in arrays]
        with tempfile.TemporaryFile() as f:
            for x in arrays:
                f.write(np.ascontiguousarray(x).tobytes())
            f.write(b"\0")
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)

    def arrays(self):
        at = 0
        for kind, shape in self.shapes:
            n = int(np.prod(shape))
            yield np.frombuffer(self.map, kind, n, at).reshape(shape)
            at += n * np.dtype(kind).itemsize


class Held:
    def __init__(self, *arrays):
        self.kept = arrays

    def arrays(self):
        return iter(self.kept)


def least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a..b]) for each pair, a <= b, from a table of powers of two."""
    n = b - a + 1
    level = np.frexp(n.astype(np.float64))[1] - 1
    out = np.empty(len(a), values.dtype)
    row = values
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            row = np.minimum(row[:-(1 << (k - 1))], row[1 << (k - 1):])
        use = np.flatnonzero(level == k)
        out[use] = np.minimum(row[a[use]], row[b[use] + 1 - (1 << k)])
    return out


class Run:
    """One portion of a step, sorted into buckets; what a merge needs to know of it."""

    def __init__(self, store, tuples: np.ndarray, common: np.ndarray, key: np.ndarray, alive: np.ndarray):
        place = np.flatnonzero(alive)
        place = place[np.argsort(key[place], kind="stable")]
        self.key, at = np.unique(key[place], return_index=True)
        self.edge = np.append(at, len(place))
        out = np.full(len(place), APART, np.int16)
        if len(place):
            inner = np.ones(len(place), bool)
            inner[at] = False
            j = np.flatnonzero(inner)
            out[j] = np.minimum(least_between(common, place[j - 1] + 1, place[j]) + 1, LENGTH)
            # least common prefix up to a bucket's first tuple, and after its last
            self.lead = np.minimum.accumulate(common)[place[at]]
            after = np.append(np.minimum.accumulate(common[::-1])[::-1], LENGTH)[1:]
            self.rest = after[place[self.edge[1:] - 1]]
        self.least = common.min(initial=LENGTH)
        self.kept = store(tuples[place], out)


def induce(portions: list, before, high: np.ndarray, shard: np.ndarray, step: int, store) -> list:
    """The order of the suffixes one byte further left, from the order ``portions``."""
    found = []
    for p in portions:
        tuples, common = p.arrays()
        found.append(Run(store, tuples, common, shard[tuples] * 256 + before[tuples, step - 1], high[tuples] >= step))
    if len(found) == 1:
        return [found[0].kept]
    # buckets leave the queue in order, each bucket's tuples in the order they came
    out, hold, size = [], [], 0
    for key in np.unique(np.concatenate([r.key for r in found])):
        gap = None
        for r in found:
            i = int(np.searchsorted(r.key, key))
            if i == len(r.key) or r.key[i] != key:
                gap = None if gap is None else min(gap, r.least)
                continue
            tuples, common = (x[r.edge[i]:r.edge[i + 1]].copy() for x in r.kept.arrays())
            if gap is not None:
                common[0] = min(min(gap, r.lead[i]) + 1, LENGTH)
            gap = r.rest[i]
            hold.append((tuples, common))
            size += len(tuples)
            if size >= PORTION:
                out.append(store(*(np.concatenate(x) for x in zip(*hold))))
                hold, size = [], 0
    if hold:
        out.append(store(*(np.concatenate(x) for x in zip(*hold))))
    return out


def repeats(portions: list, rank: np.ndarray):
    """Tuples that have ``LENGTH`` bytes in common with one of smaller rank."""
    open_: list[np.ndarray] = []            # the group that the last portion ended in

    def close():
        group = np.concatenate(open_)
        return group[rank[group] > rank[group].min()]

    for p in portions:
        tuples, common = p.arrays()
        if not len(tuples):
            continue
        at = np.flatnonzero(common < LENGTH)
        cut = int(at[0]) if len(at) else len(tuples)
        if cut:
            open_.append(np.array(tuples[:cut]))
        if not len(at):
            continue
        if open_:
            yield close()
        last = int(at[-1])
        edge = at - cut
        body = tuples[cut:last]
        if len(body):
            mine = rank[body]
            lowest = np.repeat(np.minimum.reduceat(mine, edge[:-1]), np.diff(edge))
            yield body[mine > lowest]
        open_ = [np.array(tuples[last:])]
    if open_:
        yield close()


class Shards:
    """Complete shards of suffix tuples, in the order of the suffixes at their samples."""

    def __init__(self):
        self.columns = {c: [] for c in ("shard", "doc", "tie", "sample", "low", "high")}
        self.before, self.portions, self.n, self.tail = [], [], 0, None

    def add(self, batch: pa.RecordBatch, store):
        n = len(batch)
        for c, held in self.columns.items():
            held.append(batch.column(c).to_numpy().copy())
        before, after = _padded(batch.column("before"), REACH, True), _padded(batch.column("after"), LENGTH, False)
        size, shard = np.diff(flat_bytes(batch.column("after"))[1]), self.columns["shard"][-1]
        rows, sizes, shards = after, size, shard
        if self.tail is not None:
            rows = np.concatenate([self.tail[0], after])
            sizes, shards = np.concatenate([self.tail[1], size]), np.concatenate([self.tail[2], shard])
        differ = rows[1:] != rows[:-1]
        common = np.where(differ.any(1), differ.argmax(1), LENGTH)
        common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
        common = np.where(shards[1:] == shards[:-1], common, APART).astype(np.int16)
        if self.tail is None:
            common = np.concatenate([np.array([APART], np.int16), common])
        self.tail = after[-1:].copy(), size[-1:].copy(), shard[-1:].copy()
        self.before.append(Filed(before) if store is Filed else Held(before))
        self.portions.append(store(np.arange(self.n, self.n + n), common))
        self.n += n

    def spans(self, store):
        """(doc, tie, start, end) of all repeated windows."""
        c = {k: np.concatenate(v) for k, v in self.columns.items()}
        shard = np.cumsum(np.concatenate([[0], c["shard"][1:] != c["shard"][:-1]]))
        order = np.lexsort((c["sample"], c["tie"], c["doc"]))
        new = np.concatenate([[False], np.any([c[k][order][1:] != c[k][order][:-1] for k in ("doc", "tie", "sample")], axis=0)])
        rank = np.empty(self.n, np.int64)
        rank[order] = np.cumsum(new)
        before = Bytes(self.before)
        portions = self.portions
        out = []
        for step in range(int(c["high"].max()) + 1):
            if step:
                portions = induce(portions, before, c["high"], shard, step, store)
            for found in repeats(portions, rank):
                start = c["sample"][found] - step
                out.append(merged(c["doc"][found], c["tie"][found], start, start + LENGTH))
        return merged(*(np.concatenate(x) for x in zip(*out))) if out else None


class Bytes:
    """The bytes before all samples, in portions that may lie in files."""

    def __init__(self, parts):
        self.parts = [next(iter(p.arrays())) for p in parts]
        self.edge = np.concatenate([[0], np.cumsum([len(p) for p in self.parts])])

    def __getitem__(self, at):
        tuples, column = at
        if len(self.parts) == 1:
            return self.parts[0][tuples, column].astype(np.int64)
        out = np.empty(len(tuples), np.int64)
        part = np.searchsorted(self.edge, tuples, side="right") - 1
        for k in np.unique(part):
            use = part == k
            out[use] = self.parts[k][tuples[use] - self.edge[k], column]
        return out


def _padded(column: pa.Array, width: int, backwards: bool) -> np.ndarray:
    """Byte strings as rows of a matrix; ``backwards``: from their last byte on."""
    data, offsets = flat_bytes(column)
    n = np.diff(offsets)
    out = np.zeros((len(n), width), np.uint8)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(data)) - np.repeat(offsets[:-1], n)
    out[row, np.repeat(n, n) - 1 - at if backwards else at] = data
    return out


def _sorted_repeats(batches):
    """Spans of repeats from suffix tuples that arrive shard by shard, each in suffix order."""
    held: list[pa.RecordBatch] = []

    def take(rows: list[pa.RecordBatch], store):
        shards = Shards()
        for batch in rows:
            shards.add(batch, store)
        found = shards.spans(store)
        if found is not None and len(found[0]):
            yield _rows(SPAN, len(found[0]), doc=found[0], tie=found[1], start=found[2], end=found[3])

    large = None                           # a shard that is larger than a portion
    size = 0
    for batch in batches:
        for start in range(0, len(batch), PORTION):
            part = batch.slice(start, PORTION)
            shard = part.column("shard").to_numpy()
            if large is not None:
                stop = int(np.searchsorted(shard != large.id, True)) if (shard != large.id).any() else len(part)
                if stop:
                    large.add(part.slice(0, stop), Filed)
                if stop == len(part):
                    continue
                found = large.spans(Filed)
                if found is not None and len(found[0]):
                    yield _rows(SPAN, len(found[0]), doc=found[0], tie=found[1], start=found[2], end=found[3])
                large, part = None, part.slice(stop)
                shard = shard[stop:]
            held.append(part)
            size += len(part)
            if size < PORTION:
                continue
            # complete shards go; the last one may go on in the next rows
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            shard = whole.column("shard").to_numpy()
            cut = int(np.flatnonzero(shard != shard[-1])[-1]) + 1 if (shard != shard[-1]).any() else 0
            if cut:
                yield from take([whole.slice(0, cut)], Held)
            rest = whole.slice(cut)
            held, size = [rest], len(rest)
            if size >= PORTION:
                large = Shards()
                large.id = shard[-1]
                large.add(rest, Filed)
                held, size = [], 0
    if large is not None:
        found = large.spans(Filed)
        if found is not None and len(found[0]):
            yield _rows(SPAN, len(found[0]), doc=found[0], tie=found[1], start=found[2], end=found[3])
    if held:
        yield from take([pa.Table.from_batches(held).combine_chunks().to_batches()[0]], Held)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tie, text, doc_id. ``tie`` is zero unless ids repeat or are missing."""
    doc_id = F.col(id_col).cast("bigint")
    ties = docs.groupBy(doc_id.alias("k")).agg(F.count("*").alias("n")).where("n > 1 OR k IS NULL")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tie = F.lit(0).cast("bigint") if ties.isEmpty() else F.xxhash64(text, F.lit("tie"))
    return docs.select(F.coalesce(doc_id, F.lit((1 << 63) - 1)).alias("doc"), tie.alias("tie"),
                       text.alias("text"), doc_id.alias("doc_id"))


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """doc, tie, start, end (bytes) of everything to remove; spans may overlap."""
    spark = keyed.sparkSession
    ship_package(spark)
    rows = keyed.select("doc", "tie", "text")
    classes = _classes(rows)
    bitmap = spark.sparkContext.broadcast(_bitmap(classes.where(F.col("tag") == GRAMS)))
    tuples = _tuples(rows, bitmap).repartition("shard").sortWithinPartitions("shard", "after")
    induced = tuples.mapInArrow(_sorted_repeats, ROWS_SCHEMA)
    return classes.where(F.col("tag") == SPAN).unionByName(induced).select("doc", "tie", "start", "end")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (bytes kept), n_bytes, n_removed, n_spans."""
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_spans(keyed).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(spans, ["doc", "tie"], "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                data, offsets = flat_bytes(part.column("text"))
                spans = part.column("spans")
                if spans.null_count:
                    spans = spans.fill_null([])
                edge = spans.offsets.to_numpy()
                inner = spans.values
                start, end = inner.field("start").to_numpy(), inner.field("end").to_numpy()
                owner = np.repeat(np.arange(len(part)), np.diff(edge))
                start, end = start[edge[0]:edge[-1]] + offsets[owner], end[edge[0]:edge[-1]] + offsets[owner]
                # bytes covered: spans opened and not yet closed
                depth = np.bincount(start, minlength=len(data) + 1) - np.bincount(end, minlength=len(data) + 1)
                gone = np.cumsum(depth)[:-1] > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                first = offsets[:-1][np.diff(offsets) > 0]
                opens[first] = gone[first]
                count = lambda m: np.diff(np.concatenate([[0], np.cumsum(m)])[offsets])
                kept = data[~gone]
                left = count(~gone)
                edges = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(edges), pa.py_buffer(kept)]),
                     pa.array(np.diff(offsets)), pa.array(count(gone)), pa.array(count(opens))],
                    names=["doc_id", "text", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(cut, "doc_id bigint, text binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))
