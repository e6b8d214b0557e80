"""Operator 7: n-gram Jaccard join with parity sketches.

A document's set are its distinct word shingles, as 53-bit hashes. Two sets of
sizes a and b reach the similarity p only if their symmetric difference is at most
``D = (a + b)(100 - p) / (100 + p)``.

* Sets are put in size bands; a pair that can link lies in one band or in two
  neighbouring ones. For each such group the hash range is cut in ``B = D + 1 + e``
  blocks and every token is XORed into its block's word. Differing tokens spoil at
  most D words, so at least e + 1 words agree: the pigeonhole join is on (group,
  block, word). Blocks with fewer than two tokens say little and are left out of a
  set that has at most e of them; one of the agreeing words is then still shared.
* Within a bucket each set is compared with the smallest id only (a star). Pairs go
  through a second sketch, where each token flips one of 1024 bits: its Hamming
  distance never exceeds the symmetric difference, so a pair beyond D is dropped
  safely. The rest is verified on whole texts.
* A bucket whose members then lie in one component is done: nothing it holds could
  merge anything. In the others all pairs across components are compared by their
  sketches, within tiles of bounded size and without listing them (``_across_by_tiles``),
  or found by rare sketch differences (``_across_by_bits``): pairs within the Hamming bound
  come out, and are verified. No link between different texts is lost.

Equal sets form classes first and are never compared. Each slice of texts hands on
a bucket once, with its smallest id, and lists its other members aside, so a
bucket that a third of all sets share stays small in any task; a text that many
pairs need is sent once per salted group of pairs. What decides which texts are
needed is a bitmap of fixed size; it only saves work.

Null and blank texts have no shingles and link with nothing; texts with fewer
words than a shingle have one, their whole sequence. Repeated rows each get a row;
rows with one id are one node, for which the greatest text stands. Rows without an id get no component. An empty table
gives an empty result; other columns are not read by ``similar_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaysql.llm.common import LOWER, flat_bytes, mix64, release, slices, table, word_hashes, words, written
from relaysql.llm.components import components
from relaysql.session import ship_package

SLICE_BYTES = 8 << 20
SLICE_ROWS = 2048                  # 11 bits beside 53 bits of hash
SPARE = 0.15                       # spare blocks, as a share of D + 1
SKETCH_WORDS = 16                  # 1024 bits
LONG_SET = 512                     # larger sets also get a sketch as wide as they need
MID_BITS = 1 << 16                 # widest sketch that goes into tiles
BITMAP_BITS = 26
TILE = 2048                        # members that meet in one task
EARLIER = 32                       # of a set's buckets that tell where a pair met before
SALTS = 64                         # groups of pairs with one centre

# Words are [^\x20\x09-\x0D]+ of lower-cased text.
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All distinct shingles (53-bit hashes, ascending per text) and the offsets of the
    texts. At most ``SLICE_ROWS`` texts at once."""
    data, offsets = flat_bytes(column)
    found, first = words(LOWER[data], offsets, _INSIDE)
    h = word_hashes(found)
    n = np.diff(first)
    width = np.minimum(n, k)
    count = np.where(n > 0, n - width + 1, 0)                     # shingles before removing repeats
    text = np.repeat(np.arange(len(n)), count)
    upto = np.cumsum(count)
    at = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - count, count) + first[:-1][text]
    total = mix64(width[text].astype(np.uint64))                  # whole short texts never equal a full shingle
    for i in range(k):
        use = i < width[text]
        step = h[np.minimum(at + i, max(len(h) - 1, 0))] * np.uint64(0xD6E8FEB86659FD93 + 2 * i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        total = mix64(np.where(use, total ^ step, total))
    key = np.sort((text.astype(np.uint64) << np.uint64(53)) | (total >> np.uint64(11)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    bounds = np.searchsorted(key, np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(53)) if len(n) < SLICE_ROWS else \
        np.concatenate([np.searchsorted(key, np.arange(len(n), dtype=np.uint64) << np.uint64(53)), [len(key)]])
    return key & np.uint64((1 << 53) - 1), bounds


def _parts(batch: pa.RecordBatch, column: str):
    for start in range(0, len(batch), SLICE_ROWS):
        yield from slices(batch.slice(start, SLICE_ROWS), column, SLICE_BYTES)


def reduce_by(op, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``op`` over each run between bounds; runs may be empty (then 0)."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = op.reduceat(values, bounds[:-1][full])
    return out


class Bands:
    """Size bands and, per group of two neighbouring bands, D and the number of blocks."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        starts = [1]
        while starts[-1] <= largest:
            starts.append(starts[-1] * 100 // percent + 1)
        self.starts = np.array(starts, np.int64)
        low = self.starts[1:] - 1                                  # largest size of each band
        high = np.minimum(np.append(low[1:], low[-1]), low * 100 // percent)
        self.d = (low + high) * (100 - percent) // (100 + percent)
        self.spare = np.ceil(SPARE * (self.d + 1)).astype(np.int64)
        self.blocks = self.d + 1 + self.spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, side="right") - 1


def block_words(sets: np.ndarray, bounds: np.ndarray, group: np.ndarray, bands: Bands):
    """(key, set) for every block word that a set hands to the join in its group."""
    n = np.diff(bounds)
    blocks = bands.blocks[group]
    owner = np.repeat(np.arange(len(n)), n)
    # monotone in the hash, so that a block's tokens stand together; 27 + 26 bits keep the product exact
    high, low = sets >> np.uint64(26), sets & np.uint64((1 << 26) - 1)
    b = blocks[owner].astype(np.uint64)
    block = ((high * b + ((low * b) >> np.uint64(26))) >> np.uint64(27)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(blocks)])               # of each set's blocks among all
    slot = first[owner] + block
    size = np.bincount(slot, minlength=first[-1])
    edge = np.concatenate([[0], np.cumsum(size)])
    word = reduce_by(np.bitwise_xor, mix64(sets), edge)
    of = np.repeat(np.arange(len(n)), blocks)
    weak = size < 2
    many = reduce_by(np.add, weak.astype(np.int64), first) > bands.spare[group]
    use = (~weak | many[of]) & (n[of] > 0)
    index = np.arange(first[-1]) - first[of]
    key = mix64(word ^ mix64((group[of].astype(np.uint64) << np.uint64(40)) | index.astype(np.uint64)))
    return key[use], of[use]


def set_keys(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set."""
    return (reduce_by(np.add, mix64(sets), bounds),
            reduce_by(np.bitwise_xor, mix64(sets ^ np.uint64(0xA5A5A5A5A5A5A5)), bounds))


def bit_sketches(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``SKETCH_WORDS`` 64-bit words per set; each token flips one bit."""
    n = len(bounds) - 1
    bits = 64 * SKETCH_WORDS
    owner = np.repeat(np.arange(n), np.diff(bounds))
    at = (mix64(sets ^ np.uint64(0x5BD1E995)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(owner * bits + at, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1).view(np.int64)


SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


def wide_sketches(sets: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Sketches of sets beyond ``LONG_SET``, two to four bits per token; null for others.
    The number of words is a power of two, and a wider one folds to a narrower one by
    XOR of its halves, so sets of any two sizes can be compared."""
    return _sketches(sets, bounds, lambda n: 64 << (n // 32).bit_length() if n > LONG_SET else 0)


def mid_sketches(sets: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Sketches for tiles, of sets for which the first one is too narrow to tell unlike sets
    apart: two to four bits for three tokens, ``MID_BITS`` at most; null for others."""
    first = 64 * SKETCH_WORDS
    return _sketches(sets, bounds, lambda n: min(1 << (2 * n // 3 - 1).bit_length(), MID_BITS) if 2 * n // 3 > first else 0)


def _sketches(sets: np.ndarray, bounds: np.ndarray, bits_of) -> pa.Array:
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        bits = bits_of(b - a)
        if not bits:
            out.append(None)
            continue
        at = (mix64(sets[a:b] ^ np.uint64(0x5BD1E995)) % np.uint64(bits)).astype(np.int64)
        out.append(np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.int64))
    return pa.array(out, pa.list_(pa.int64()))


# the wider of two sketches folded to the narrower one's width, then their distance
FOLD = ("CASE WHEN size({a}) > size({b}) THEN transform(sequence(0, size({b}) - 1), i -> aggregate("
        "sequence(0, size({a}) div size({b}) - 1), 0L, (x, j) -> x ^ {a}[i + j * size({b})])) ELSE {a} END")
WIDE = (f"coalesce(aggregate(zip_with({FOLD.format(a='wide_a', b='wide_b')}, {FOLD.format(a='wide_b', b='wide_a')}, (x, y) -> bit_count(x ^ y)), "
        "0, (s, x) -> s + x), 0)")


def _sets_table(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, the two keys of the set and its sketch, for every row."""
    def make(batches):
        for batch in batches:
            for part in _parts(batch, "text"):
                sets, bounds = shingle_sets(part.column("text"), k)
                a, b = set_keys(sets, bounds)
                sketch = bit_sketches(sets, bounds)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                     *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_WORDS)), wide_sketches(sets, bounds), mid_sketches(sets, bounds)],
                    names=["doc_id", "n_shingles", "key_a", "key_b", *SKETCH, "wide", "mid"])
    schema = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, " + ", ".join(f"{s} bigint" for s in SKETCH) + ", wide array<bigint>, mid array<bigint>"
    return docs.mapInArrow(make, schema)


SINGLE, SEVERAL, MEMBER = 0, 1, 2


def _buckets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """key, doc, centre of every bucket that holds two documents or more; the stars of
    a bucket lead over the slices' smallest ids to the bucket's smallest id."""
    def make(batches):
        bands = Bands(percent)
        for batch in batches:
            for part in _parts(batch, "text"):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                sets, bounds = shingle_sets(part.column("text"), k)
                a, b = set_keys(sets, bounds)
                # equal sets are one class: only the smallest id of a slice goes on
                order = np.lexsort((ids, b, a))
                same = np.zeros(len(order), bool)
                same[1:] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
                go = np.ones(len(order), bool)
                go[order[same]] = False
                size = np.diff(bounds)
                band = bands.of(np.maximum(size, 1))
                found = []
                for shift in (0, -1):
                    group = band + shift
                    chosen = np.flatnonzero(go & (size > 0) & (group >= 0))
                    chosen = chosen[bands.d[group[chosen]] > 0]    # D = 0: only equal sets link
                    if not len(chosen):
                        continue
                    n = size[chosen]
                    edge = np.concatenate([[0], np.cumsum(n)])
                    at = np.arange(edge[-1]) - np.repeat(edge[:-1], n) + np.repeat(bounds[:-1][chosen], n)
                    key, of = block_words(sets[at], edge, group[chosen], bands)
                    found.append((key, ids[chosen[of]]))
                if not found:
                    continue
                key, doc = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                head = np.concatenate([[True], key[1:] != key[:-1]])
                again = np.zeros(len(key), bool)
                again[:-1] = ~head[1:]
                centre = doc[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
                tag = np.where(~head, MEMBER, np.where(again, SEVERAL, SINGLE)).astype(np.int8)
                keep = head | (doc != centre)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[keep].view(np.int64)), pa.array(doc[keep]), pa.array(centre[keep], mask=head[keep]),
                     pa.array(tag[keep])], names=["key", "doc", "centre", "tag"])

    def gather(batches):
        keys, docs_, several = [], [], []
        for batch in batches:
            tag = batch.column("tag").to_numpy()
            member = tag == MEMBER
            if member.any():
                yield batch.filter(pa.array(member)).select(["key", "doc", "centre"])
            keys.append(batch.column("key").to_numpy()[~member])
            docs_.append(batch.column("doc").to_numpy()[~member])
            several.append(tag[~member] == SEVERAL)
        if not keys:
            return
        key, doc, more = np.concatenate(keys), np.concatenate(docs_), np.concatenate(several)
        order = np.lexsort((doc, key))
        key, doc, more = key[order], doc[order], more[order]
        head = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        centre = doc[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
        shared = ~head
        shared[:-1] |= ~head[1:]
        shared |= more
        yield pa.RecordBatch.from_arrays([pa.array(key[shared]), pa.array(doc[shared]), pa.array(centre[shared])],
                                         names=["key", "doc", "centre"])

    rows = docs.mapInArrow(make, "key bigint, doc bigint, centre bigint, tag tinyint")
    dealt = rows.repartition(F.when(F.col("tag") == MEMBER, F.col("doc")).otherwise(F.col("key")))
    return dealt.mapInArrow(gather, "key bigint, doc bigint, centre bigint")


def _bitmap(spark: SparkSession, ids: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** BITMAP_BITS bits of hashed ids: at most 2048 pieces of 4 KB."""
    at = F.pmod(F.xxhash64("node"), F.lit(1 << BITMAP_BITS))
    pieces = ids.select(at.alias("at")).groupBy(F.expr("at >> 15").alias("piece")).agg(
        F.expr("bitmap_construct_agg(CAST(at & 32767 AS INT))").alias("bits"))
    out = np.zeros((1 << (BITMAP_BITS - 15), 4096), np.uint8)
    for r in pieces.toLocalIterator():
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """node, text of the documents that a pair names, written."""
    spark = docs.sparkSession
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    shared = spark.sparkContext.broadcast(_bitmap(spark, nodes))
    hashed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)).alias("at"))

    def sift(batches):
        bits = shared.value
        for batch in batches:
            at = batch.column("at").to_numpy()
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1)).select(["doc_id", "text"])

    some = hashed.mapInArrow(sift, "doc_id bigint, text string")
    found = some.join(nodes, some.doc_id == nodes.node).select("node", "text")
    found = written(found.groupBy("node").agg(F.max("text").alias("text")), "join-texts")
    shared.destroy()                                               # the driver's copy too
    return found


def _verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a: centre, b) whose similarity on whole texts reaches the percentage."""
    texts = _texts(docs, pairs)
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt"))
    centres = dealt.select("a", "salt").distinct().join(texts, F.col("a") == F.col("node")).select(
        "a", "salt", F.lit(None).cast("bigint").alias("b"), "text")
    others = dealt.join(texts, F.col("b") == F.col("node")).select("a", "salt", "b", "text")
    rows = centres.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def compare(batches):
        centre = np.zeros(0, np.uint64)
        for batch in batches:
            for part in _parts(batch, "text"):
                sets, bounds = shingle_sets(part.column("text"), k)
                b = part.column("b")
                lead = b.is_null().to_numpy(zero_copy_only=False)
                good = []
                for i in range(len(part)):
                    own = sets[bounds[i]:bounds[i + 1]]
                    if lead[i]:
                        centre = own.copy()
                        continue
                    at = np.searchsorted(centre, own)
                    common = int(np.count_nonzero(centre[np.minimum(at, len(centre) - 1)] == own)) if len(centre) and len(own) else 0
                    if common and 100 * common >= percent * (len(own) + len(centre) - common):
                        good.append(i)
                if good:
                    yield part.select(["a", "b"]).take(pa.array(good))

    found = written(rows.mapInArrow(compare, "a bigint, b bigint"), "join-links")
    release(texts)
    return found


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and Hamming distance of the sketches leave open."""
    def side(node: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(node), F.col("n_shingles").alias(f"n_{node}"),
                           *(F.col(s).alias(f"{s}_{node}") for s in SKETCH), F.col("wide").alias(f"wide_{node}"))
    far = " + ".join(f"bit_count({s}_a ^ {s}_b)" for s in SKETCH)
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
        f" AND {100 + percent} * ({far}) <= {100 - percent} * (n_a + n_b)")
    return near.where(f"{100 + percent} * {WIDE} <= {100 - percent} * (n_a + n_b)").select("a", "b")


def _labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``df`` with the component of ``node``; a node without links is its own."""
    return df.join(labels.select(F.col("node").alias(node), F.col("component").alias("_c")), node, "left").select(
        *df.columns, F.coalesce("_c", node).alias(name))


def _different_buckets(members: DataFrame) -> DataFrame:
    """The ``members`` (key, doc, component) of buckets with several components; of
    buckets with equal members the one with the smallest key."""
    alike = members.groupBy("key").agg(F.count("*").alias("m"), F.expr("bit_xor(xxhash64(doc))").alias("x"), F.expr("bit_xor(xxhash64(doc, 7))").alias("y"),
                                       F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d")
    return members.join(alike.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key"), "key")


def _met_before(rank: np.ndarray, first: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the ascending lists of ranks of rows x[i] and y[i] have one in common."""
    base = int(rank.max(initial=0)) + 1

    def laid(rows):
        n = first[rows + 1] - first[rows]
        pair = np.repeat(np.arange(len(rows)), n)
        return pair, pair * base + rank[np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[rows], n)]

    pair, mine = laid(x)
    _, other = laid(y)
    out = np.zeros(len(x), bool)
    if len(mine) and len(other):
        at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
        out[pair[other[at] == mine]] = True
    return out


class Mids:
    """Rows of ``mid_sketches``, compared at the narrower one's width."""

    def __init__(self, column: pa.Array):
        self.words = np.ascontiguousarray(column.flatten().to_numpy()).view(np.uint64)
        self.width = column.value_lengths().fill_null(0).to_numpy()
        self.first = np.cumsum(self.width) - self.width
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """All rows of ``width`` words or more, folded to that, and where each row stands there."""
        if width not in self.folded:
            use = self.width >= width
            out = np.empty((int(use.sum()), width), np.uint64)
            place = np.cumsum(use) - 1
            for own in np.unique(self.width[use]).tolist():
                rows = np.flatnonzero(self.width == own)
                for k in range(0, len(rows), max(1, (1 << 20) // own)):
                    some = rows[k:k + max(1, (1 << 20) // own)]
                    words_ = self.words[self.first[some][:, None] + np.arange(own)]
                    out[place[some]] = np.bitwise_xor.reduce(words_.reshape(len(some), own // width, width), axis=1)
            self.folded[width] = out, place
        return self.folded[width]

    def near(self, x: np.ndarray, y: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
        """Whether rows x[i] and y[i] are within the Hamming bound, or one has no such sketch."""
        width = np.minimum(self.width[x], self.width[y])
        out = width == 0
        for w in np.unique(width[~out]).tolist():
            words_, place = self.at(w)
            pairs = np.flatnonzero(width == w)
            for k in range(0, len(pairs), max(1, (1 << 20) // w)):
                some = pairs[k:k + max(1, (1 << 20) // w)]
                a, b = x[some], y[some]
                apart = np.bitwise_count(words_[place[a]] ^ words_[place[b]]).sum(axis=1, dtype=np.int64)
                out[some] = (100 + percent) * apart <= (100 - percent) * (n[a] + n[b])
        return out


def _across_by_tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that sizes and sketches leave open, among
    the ``members`` (key, doc, component) of the buckets.

    A bucket is cut in tiles: a component with ``TILE`` members
    or more has tiles of its own, the others share tiles; pairs of tiles are units, but
    not those of one component. A unit's members lie in one task as rows of sketches,
    which are compared there (those of large sets by ``mid_sketches`` too, if ``sets`` has
    them as ``mid``); only pairs within the Hamming bound come out, and only of
    the first bucket that both lie in. Rows carry the ``EARLIER`` smallest keys of their
    document's buckets for that: a pair that shares none of these may come out again."""
    mid = F.col("mid") if "mid" in sets.columns else F.lit(None).cast("array<bigint>").alias("mid")
    sketch = sets.groupBy("doc_id").agg(F.max(F.struct("n_shingles", *SKETCH, mid)).alias("s")).select("doc_id", "s.*")
    # as many keys as a document has blocks at most
    earlier = members.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list("key")), 1, EARLIER).alias("keys"))
    heaps = members.groupBy("key", "component").agg(F.count("*").alias("m"))
    heaps = heaps.withColumn("own", F.when(F.col("m") >= TILE, F.col("component")))
    # a tile: its component (null: shared) and number; a row per bucket, not per member
    tiles = heaps.groupBy("key", "own").agg(F.ceil(F.sum("m") / TILE).cast("int").alias("n"))
    listed = tiles.groupBy("key").agg(F.flatten(F.collect_list(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(
        F.coalesce("own", F.lit(-1)).alias("c"), F.col("own").isNull().alias("shared"), i.alias("i"))))).alias("tiles"))
    dealt = heaps.alias("h").join(tiles.alias("t"), F.expr("h.key = t.key AND h.own <=> t.own")).select(
        "h.key", "h.component", "h.own", F.col("t.n").alias("dealt"))
    placed = members.join(dealt, ["key", "component"])
    placed = placed.join(listed, "key").join(sketch.withColumnRenamed("doc_id", "doc").join(earlier, "doc"), "doc").withColumn(
        "before", F.filter("keys", lambda k: k < F.col("key")))
    # members of a shared tile are dealt by component, so that equal ones meet in one tile
    at = F.struct(F.coalesce("own", F.lit(-1)).alias("c"), F.col("own").isNull().alias("shared"),
                  F.expr("cast(pmod(CASE WHEN own IS NULL THEN xxhash64(component) ELSE xxhash64(doc) END, dealt) as int)").alias("i"))
    placed = placed.withColumn("at", at)
    partners = F.filter("tiles", lambda t: F.col("at.shared") | t["shared"] | (t["c"] != F.col("at.c")))
    units = F.transform(partners, lambda t: F.struct(F.least(t, F.col("at")).alias("ta"), F.greatest(t, F.col("at")).alias("tb"), (t < F.col("at")).alias("second")))
    unit = ["key", "ta", "tb"]
    rows = placed.select("key", "doc", "component", F.col("n_shingles").alias("n"), "before", *SKETCH, "mid", F.inline(units)).withColumn("split", F.expr("ta <> tb"))
    rows = rows.repartition(*unit).sortWithinPartitions(*unit).select(
        F.xxhash64(*unit).alias("unit"), "doc", "component", "n", "second", "split", "before", *SKETCH, "mid")

    def pairs(rows_: pa.Table):
        unit_, doc, component, n, second, split = (rows_.column(c).to_numpy() for c in ("unit", "doc", "component", "n", "second", "split"))
        words_ = np.stack([rows_.column(c).to_numpy() for c in SKETCH], axis=1).view(np.uint64)
        before = rows_.column("before").combine_chunks()
        rank = np.unique(before.flatten().to_numpy(), return_inverse=True)[1]
        first = np.concatenate([[0], np.cumsum(before.value_lengths().to_numpy())])
        mids = Mids(rows_.column("mid").combine_chunks())
        last = np.append(unit_[1:] != unit_[:-1], True)
        ends = np.flatnonzero(last) + 1
        end = np.repeat(ends, np.diff(np.append(0, ends)))       # where each row's unit ends
        live, d = np.arange(len(unit_)), 0
        while True:
            d += 1
            live = live[live + d < end[live]]
            if not len(live):
                return
            j = live + d
            ok = (component[live] != component[j]) & (~split[live] | (second[live] != second[j]))
            ok &= 100 * np.minimum(n[live], n[j]) >= percent * np.maximum(n[live], n[j])
            for x, y in ((live[ok][k:k + SLICE_ROWS * 16], j[ok][k:k + SLICE_ROWS * 16]) for k in range(0, int(ok.sum()), SLICE_ROWS * 16)):
                apart = np.bitwise_count(words_[x] ^ words_[y]).sum(axis=1, dtype=np.int64)
                near = (100 + percent) * apart <= (100 - percent) * (n[x] + n[y])
                x, y = x[near], y[near]
                near = mids.near(x, y, n, percent)
                x, y = x[near], y[near]
                new = ~_met_before(rank, first, x, y)
                if new.any():
                    a, b = doc[x[new]], doc[y[new]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def compare(batches):
        held = pa.table({})
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if len(held) else pa.Table.from_batches([batch])
            if len(held) < 4 * TILE:
                continue
            unit_ = held.column("unit").to_numpy()
            whole = np.flatnonzero(unit_ != unit_[-1])          # the last unit may go on
            if len(whole):
                yield from pairs(held.slice(0, whole[-1] + 1))
                held = held.slice(whole[-1] + 1).combine_chunks()
        if len(held):
            yield from pairs(held)

    return rows.mapInArrow(compare, "a bigint, b bigint")


def _across_by_bits(members: DataFrame, keyed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that can link, among the members (root, doc,
    component, near: in the root's component) of buckets with one smallest id.

    Sets of one bucket are much alike, so what tells them apart is how their sketches
    differ from the root's: the bits where they do are a small set with ``h`` elements.
    Two sets within the distance D share at least t = (h_a + h_b - D) / 2 of these, so
    with bits in order of rarity they share one of the first h_a - t + 1 and h_b - t + 1.
    Where t is not positive, both stand so near the root that h tells them. Members beyond
    twice the largest D of theirs have little to do with the root: they are compared
    within their buckets (``keyed``: key, root, doc). Their partners are as far, less D."""
    sketch = sets.groupBy("doc_id").agg(F.max(F.struct("n_shingles", *SKETCH)).alias("s"))
    sketch = written(sketch.select("doc_id", "s.*").join(
        members.select(F.col("doc").alias("doc_id")).unionByName(members.select(F.col("root").alias("doc_id"))).distinct(), "doc_id", "left_semi"),
        "join-sketches")
    own = sketch.withColumnRenamed("doc_id", "doc").withColumnRenamed("n_shingles", "n")
    root = sketch.select(F.col("doc_id").alias("root"), *(F.col(s).alias(f"{s}_r") for s in SKETCH))
    rows = members.join(own, "doc").join(root, "root").select(
        "root", "doc", "component", "near", "n", *((F.col(s).bitwiseXOR(F.col(f"{s}_r"))).alias(s) for s in SKETCH))
    most = f"((n + (n * 100) div {percent}) * {100 - percent}) div {100 + percent}"      # D with the largest partner
    # folded differences: a quarter as wide, and their distance is still a lower bound
    folds = [f"f{i}" for i in range(SKETCH_WORDS // 4)]
    rows = written(rows.withColumn("h", F.expr(" + ".join(f"bit_count({s})" for s in SKETCH)).cast("bigint")).withColumn(
        "most", F.expr(most)).withColumns({f: F.expr(" ^ ".join(SKETCH[i::len(folds)])) for i, f in enumerate(folds)}), "join-differences")

    def bits(batches):
        for batch in batches:
            words_ = np.stack([batch.column(s).to_numpy() for s in SKETCH], axis=1).astype("<i8") if len(batch) else np.zeros((0, SKETCH_WORDS), "<i8")
            at, pos = np.nonzero(np.unpackbits(np.ascontiguousarray(words_).view(np.uint8), axis=1))
            part = batch.select(["root", "doc"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pos)], names=[*part.schema.names, "pos"])

    least = rows.where("not near").groupBy("root").agg(F.min("h").alias("h_least"))
    # narrow until the prefixes are cut: root, member, bit
    rare = written(rows.where("h <= 2 * most").mapInArrow(bits, "root bigint, doc bigint, pos bigint"), "join-bits")
    order = Window.partitionBy("root", "doc").orderBy("often", "pos")                    # at most 1024 rows
    ranked = rare.join(rare.groupBy("root", "pos").agg(F.count("*").alias("often")), ["root", "pos"]).withColumn(
        "rank", F.row_number().over(order)).drop("often")
    ranked = ranked.join(rows.drop(*SKETCH).join(least, "root"), ["root", "doc"])
    # a member of the root's component only needs to meet those that are not
    t_least = F.expr("greatest(1, CASE WHEN near THEN (h_least + h - most + 1) div 2 ELSE h - most END)")
    prefix = written(ranked.where(F.col("rank") <= F.col("h") - t_least + 1).drop("h_least"), "join-prefixes")
    side = lambda x, keys: prefix.select(*keys, *(F.col(c).alias(f"{c}_{x}") for c in ("doc", "component", "near", "n", "h", "rank", *folds)))
    d = f"((n_a + n_b) * {100 - percent}) div {100 + percent}"
    t = f"greatest(1, (h_a + h_b - {d} + 1) div 2)"
    apart = " + ".join(f"bit_count({f}_a ^ {f}_b)" for f in folds)
    far = side("a", ["root", "pos"]).join(side("b", ["root", "pos"]), ["root", "pos"]).where(
        f"doc_a < doc_b AND component_a <> component_b AND NOT (near_a AND near_b) AND rank_a <= h_a - {t} + 1 AND rank_b <= h_b - {t} + 1 AND {apart} <= {d}")
    placed = written(keyed.join(rows.where("2 * h > most").drop(*SKETCH), ["root", "doc"]), "join-placed")
    one = lambda x: placed.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("doc", "component", "n", "h", "most", *folds)))
    beyond = one("a").where("h_a > 2 * most_a").join(one("b"), "key").where(
        f"doc_a <> doc_b AND component_a <> component_b AND abs(h_a - h_b) <= {d} AND {apart} <= {d}")
    beyond = beyond.select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b")).distinct()
    probes = rows.where("not near and h <= most").select(
        "root", F.col("doc").alias("doc_a"), F.col("component").alias("component_a"), F.explode(F.expr("sequence(0L, most - h)")).alias("h"))
    close = probes.join(rows.where("h <= most").select("root", "h", F.col("doc").alias("doc_b"), F.col("component").alias("component_b")),
                        ["root", "h"]).where("component_a <> component_b")
    return far.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).unionByName(
        close.select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"))).unionByName(beyond).distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle_words: int = 5, percent: int = 80, across: str = "tiles") -> DataFrame:
    """doc_id, n_shingles, component_id: documents linked at ``percent`` or more.

    ``across``: how pairs across the components of open buckets are found, with equal
    results. ``"tiles"`` compares sketches in tiles (time grows with the square of an open
    bucket, disk with its size); ``"bits"`` joins on rare sketch differences (rows grow
    with the members' distance from the bucket's smallest id)."""
    if across not in ("tiles", "bits"):
        raise ValueError("across must be 'tiles' or 'bits'")
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    every = written(_sets_table(texts, shingle_words), "join-sets")
    texts = texts.where("doc_id is not null")
    sets = every.where("doc_id is not null and n_shingles > 0")
    # equal sets: linked through the smallest id
    classes = sets.groupBy("key_a", "key_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows_"))
    classes = written(classes.where("rows_ > 1").drop("rows_"), "join-classes")
    twins = written(sets.select("doc_id", "key_a", "key_b", "n_shingles").join(
        classes, ["key_a", "key_b", "n_shingles"]).where("doc_id <> rep").select("doc_id", "rep").distinct(), "join-twins")
    first = sets.join(twins, "doc_id", "left_anti")                # one row of each class, more if an id repeats

    def reps(pairs: DataFrame, within: bool = False) -> DataFrame:
        """Both ends replaced by their class; pairs within a class fall away."""
        a = twins.select(F.col("doc_id").alias("a"), F.col("rep").alias("rep_a"))
        b = twins.select(F.col("doc_id").alias("b"), F.col("rep").alias("rep_b"))
        return pairs.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("rep_a", "a").alias("a"), F.coalesce("rep_b", "b").alias("b")).where(F.lit(within) | (F.col("a") != F.col("b"))).distinct()

    buckets = written(_buckets(texts, shingle_words, percent), "join-buckets")
    stars = written(reps(buckets.where("doc <> centre").select(F.col("centre").alias("a"), F.col("doc").alias("b")).distinct()), "join-stars")
    possible = written(_possible(stars, first, percent), "join-pairs")
    links = _verified(texts, possible, shingle_words, percent)
    release(possible)
    twin_links = twins.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    labels = written(components(links.unionByName(twin_links)), "join-labels")

    # buckets that are not one component yet: pairs across components
    apart = buckets.where("doc <> centre").select("doc", "centre").distinct()
    apart = _labelled(_labelled(apart, labels, "doc", "c_doc"), labels, "centre", "c_centre").where("c_doc <> c_centre").select("doc", "centre")
    open_keys = written(buckets.join(apart, ["doc", "centre"], "left_semi").select("key").distinct(), "join-open-keys")
    open_rows = written(buckets.join(open_keys, "key", "left_semi").select("key", "doc"), "join-open")
    class_ = twins.select(F.col("doc_id").alias("doc"), F.col("rep").alias("_doc"))
    if across == "tiles":
        members = open_rows.join(class_, "doc", "left").select("key", F.coalesce("_doc", "doc").alias("doc")).distinct()
        members = written(_different_buckets(_labelled(members, labels, "doc", "component")), "join-members")
        found = _across_by_tiles(members, first, percent).distinct()
    else:
        roots = written(open_rows.groupBy("key").agg(F.min("doc").alias("a")), "join-roots")
        members = reps(open_rows.join(roots, "key").select("a", F.col("doc").alias("b")).distinct(), within=True)
        members = _labelled(_labelled(members, labels, "a", "c_a"), labels, "b", "c_b")
        top = twins.select(F.col("doc_id").alias("root"), F.col("rep").alias("_root"))
        keyed = open_rows.join(roots.withColumnRenamed("a", "root"), "key").join(class_, "doc", "left").join(top, "root", "left").select(
            "key", F.coalesce("_root", "root").alias("root"), F.coalesce("_doc", "doc").alias("doc")).distinct()
        members = written(members.select(F.col("a").alias("root"), F.col("b").alias("doc"), F.col("c_b").alias("component"),
                                         (F.col("c_a") == F.col("c_b")).alias("near")), "join-members")
        found = _across_by_bits(members, keyed, first, percent)
    found = written(found, "join-across")
    release(members, open_rows, buckets, open_keys)
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(_possible(found.join(tried, ["a", "b"], "left_anti"), first, percent), "join-rest")
    # ids whose only row has no shingles, and ids without links, are their own component
    result = _labelled(every.select("doc_id", "n_shingles"), labels, "doc_id", "component_id")
    if not rest.isEmpty():
        more = _verified(texts, rest, shingle_words, percent)
        # links between components, which are few: only these are joined, not all links again
        more = _labelled(_labelled(more, labels, "a", "c_a"), labels, "b", "c_b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
        merged = written(components(more), "join-merged")
        result = _labelled(result, merged, "component_id", "root").select("doc_id", "n_shingles", F.col("root").alias("component_id"))
    release(found, stars, rest, twins, classes)
    return result


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), shingle_words=4, percent=85, across="bits")
