"""Operator 2: token ids in ORC files.

``write_token_files`` sorts documents by a key (range partitions, so the order is
global), encodes whole texts with a ``tokenizers`` vocabulary file and writes one
row per document: integer run-length encoding of the ids, row indexes every
``INDEX_STRIDE`` rows and Bloom filters on the document id. Readers split files at
stripes, and a filter on ``doc_id`` skips stripes and row groups by their
statistics and Bloom filters without decoding ids (``read_documents``).

Encoding works on distinct chunks: texts are cut where the vocabulary's own
splitting rule is certain to cut (ASCII white space; between an ASCII letter and
another ASCII character, apostrophes aside), distinct chunks are encoded once and
ids are put together with array operations. Cutting there never changes ids under the
normaliser and splitting rule of the default vocabulary (``CUT_RULES``); a vocabulary
file with any other rule, or with added tokens that are not special, gets its texts
encoded whole.

Strings of special tokens in a text are ordinary text (``encode_special_tokens``, as
the vocabularies' own README has it): no document can write an end id into its row.

``read_token_files`` reads everything back and adds each document's ``start``, the
number of ids before it: a running count within each file is stored with the
rows, and file totals (one row per file) are added up before.

A null text is empty: its only id is the end id. Rows with a null id come first.
Rows with equal ids are ordered by their text; repeated rows are all written. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaysql.llm.common import LOWER, flat_bytes, slices, table
from relaysql.session import shared_path, ship_package

END_ID = 2
INDEX_STRIDE = 1000
STRIPE_BYTES = 32 << 20
ROWS_BETWEEN_CHECKS = 200    # the writer looks this often whether a stripe is full
SLICE_BYTES = 4 << 20
CACHE_CHUNKS = 400_000       # distinct chunks a Python worker remembers
ENCODE_AT_ONCE = 20_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[ord("A"):ord("Z") + 1] = True
_OTHER = ~_LETTER & ~_SPACE          # ASCII that is neither letter nor white space
_OTHER[128:] = False
_OPENS = _OTHER.copy()               # may end a chunk before a letter
_OPENS[ord("'")] = False


# The rules under which ``chunks`` and lower-casing ahead are exact.
CUT_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def can_cut(path: str) -> bool:
    """The vocabulary file's rules are those that the cuts were made for."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    return (all(found[k] == v for k, v in CUT_RULES.items()) and found["model"]["type"] == "BPE"
            and not found["model"].get("dropout") and not found.get("truncation") and not found.get("padding")
            and all(x["special"] for x in found["added_tokens"]))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts in order, and how many each text has."""
    space = _SPACE[data]
    begins = np.zeros(len(data), bool)
    if len(data):
        a, b = data[:-1], data[1:]
        begins[1:] = space[:-1] | (_LETTER[a] & _OTHER[b]) | (_OPENS[a] & _LETTER[b])
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins &= ~space
    solid = ~space
    starts = np.flatnonzero(begins)
    before = np.concatenate([[0], np.cumsum(solid)])          # kept bytes before each byte
    ends = np.concatenate([before[starts], before[-1:]]).astype(np.int32)
    kept = LOWER[data[solid]]                                  # as the vocabulary does; fewer chunks are distinct
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return found, np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])


def _portions(chunks_: list[bytes]):
    for k in range(0, len(chunks_), ENCODE_AT_ONCE):
        yield chunks_[k:k + ENCODE_AT_ONCE]


class ChunkEncoder:
    """ids of distinct chunks, remembered up to a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
        self.cuts = can_cut(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = None                               # by id: it ends a word
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closes[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.reset()

    def reset(self):
        self.index: dict[bytes, int] = {}
        self.flat, self.lengths = [], []                 # arrays, one per call of the tokenizer
        self.joined = None

    def learn(self, new: list[bytes]):
        # a chunk of letters is one unit of the vocabulary's splitting rule, and its last id
        # ends a word: many are encoded as one text, which costs half as much
        letters, rest = [], []
        for x in new:
            (letters if x.decode("utf-8", "replace").isalpha() else rest).append(x)
        for part in _portions(letters):
            if self.closes is None:
                rest += part
                continue
            text = " ".join(x.decode("utf-8", "replace") for x in part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.closes[ids])
            if len(ends) == len(part):
                self.keep(part, ids, np.diff(np.concatenate([[-1], ends])))
            else:                    # some letter's lower case is no letter: one by one
                rest += part
        for part in _portions(rest):
            e = self.tokenizer.encode([x.decode("utf-8", "replace") for x in part], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, np.int32)
            owner = np.array(e.word_ids, np.int64) if len(ids) else np.zeros(0, np.int64)
            self.keep(part, ids, np.bincount(owner, minlength=len(part)))

    def keep(self, part: list[bytes], ids: np.ndarray, lengths: np.ndarray):
        for x in part:
            self.index[x] = len(self.index)
        self.flat.append(ids)
        self.lengths.append(lengths)
        self.joined = None

    def table(self):
        if self.joined is None:
            flat = np.concatenate([np.zeros(0, np.int32), *self.flat])
            lengths = np.concatenate([np.zeros(0, np.int64), *self.lengths])
            self.flat, self.lengths = [flat], [lengths]
            self.joined = flat, lengths, np.concatenate([[0], np.cumsum(lengths)])
        return self.joined

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and how many each text has."""
        if not self.cuts:
            each = self.tokenizer.encode_batch_fast(column.fill_null("").to_pylist(), add_special_tokens=False)
            ids = [np.array(e.ids, np.int32) for e in each]
            return np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64)
        found, per_text = chunks(*flat_bytes(column))
        coded = found.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.index) + len(words) > CACHE_CHUNKS:
            self.reset()
        self.learn([w for w in words if w not in self.index])
        flat, lengths, starts = self.table()
        index = self.index
        which = np.fromiter((index[w] for w in words), np.int64, len(words))[coded.indices.to_numpy(zero_copy_only=False)]
        n = lengths[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(upto)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encode_column(column: pa.Array, path: str, end_id: int) -> pa.Array:
    """list<int32>: each text's ids and the end id."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    ids, counts = _ENCODERS[path](column)
    ends = np.cumsum(counts + 1)
    out = np.empty(len(ids) + len(counts), np.int32)
    last = np.zeros(len(out), bool)
    last[ends - 1] = True
    out[last] = end_id
    out[~last] = ids
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(out))


SCHEMA = "part int, row bigint, doc_id bigint, before bigint, n_tokens bigint, tokens array<int>"


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      order: tuple[str, ...] = (), vocabulary: str | None = None, end_id: int = END_ID) -> str:
    """Write ``docs`` under ``path`` in ascending order of ``order`` (default: the id)."""
    ship_package(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    keys = [f"_k{i}" for i in range(len(order))] or ["doc_id"]
    ranged = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        *(F.col(c).alias(k) for c, k in zip(order, keys))
    ).repartitionByRange(*keys).sortWithinPartitions(*keys, "doc_id", "text").select("doc_id", "text")

    def encode(batches):
        part, row, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for cut in slices(batch, "text", SLICE_BYTES):
                tokens = encode_column(cut.column("text"), vocabulary, end_id)
                n = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
                upto = before + np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(cut), part, np.int32)), pa.array(np.arange(row, row + len(cut))),
                    cut.column("doc_id"), pa.array(upto[:-1]), pa.array(n), tokens],
                    names=["part", "row", "doc_id", "before", "n_tokens", "tokens"])
                row, before = row + len(cut), int(upto[-1])

    (ranged.mapInArrow(encode, SCHEMA).write.format("orc")
     .option("compression", "zstd").option("orc.create.index", "true").option("orc.row.index.stride", INDEX_STRIDE)
     .option("orc.stripe.size", STRIPE_BYTES).option("orc.rows.between.memory.checks", ROWS_BETWEEN_CHECKS)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").save(path))
    return path


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """doc_id and tokens of some documents; the filter reaches the ORC reader."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(ids)).select("doc_id", "tokens")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: lengths and checksums from the ids as read."""
    ship_package(spark)
    files = spark.read.schema(SCHEMA).orc(path)

    def digest(batches):
        for batch in batches:
            tokens = batch.column("tokens")
            ends = tokens.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            yield pa.RecordBatch.from_arrays([
                batch.column("part"), batch.column("doc_id"), batch.column("before"), pa.array(np.diff(ends)),
                pa.array(np.fromiter((zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1], ends[1:])), np.int64, len(tokens)))],
                names=["part", "doc_id", "before", "n_tokens", "ids_crc32"])

    rows = files.select("part", "doc_id", "before", "tokens").mapInArrow(
        digest, "part int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint")
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("offset"))
    return rows.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_token_files(table(spark, sf_dir, "documents"), shared_path(spark, "llm", "tokens"))
    return read_token_files(spark, path)
