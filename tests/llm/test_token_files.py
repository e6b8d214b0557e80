"""Operator 2: ids against the tokenizers library text by text; layout and pruning of the files."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from relaysql.llm import token_files as t
from relaysql.session import shared_path

PARTS = ["the", "The", "DON'T", "don't", "x'tea", "!'tea", "'s", "it's,", "12345", "a1b2", "éa", "aé", "é", "≠",
         "a̸", "İ", "ΣΑΣ", "—", ",—", "…", "<|endoftext|>", "<|start", "oftext|>", "#$%", "日本語", " ", " ", "\x1f", "_",
         "-", "'", "''", "\"", "ﬁ", "K", "ſ", "‍", "👍🏽"]
SEPARATORS = ["", "", " ", "\n", "\t", "  ", "\x0b", "\r\n"]


def made(seed):
    r = random.Random(seed)
    return "".join(r.choice(PARTS) + r.choice(SEPARATORS) for _ in range(r.randint(0, 40)))


TEXTS = [None, "", " \n ", "word", "word " * 40000, "unbroken" * 5000] + [made(i) for i in range(400)]


@pytest.fixture(scope="module")
def expected():
    k = Tokenizer.from_file(t.default_vocabulary())
    k.encode_special_tokens = True
    return [k.encode(x or "", add_special_tokens=False).ids + [2] for x in TEXTS]


def test_chunked_ids_equal_whole_text_ids(expected):
    got = t.encode_column(pa.array(TEXTS, pa.string()), t.default_vocabulary(), 2).to_pylist()
    assert got == expected
    again = t.encode_column(pa.array(TEXTS[::-1], pa.string()).slice(3), t.default_vocabulary(), 2).to_pylist()
    assert again == expected[::-1][3:]


def test_other_vocabularies_are_not_cut_by_this_ones_rule(tmp_path):
    import json
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    k = Tokenizer.from_file(path)
    k.encode_special_tokens = True
    texts = [None, "Two  Words", "end of file <|endoftext|> next", *TEXTS[-50:]]
    assert t.encode_column(pa.array(texts, pa.string()), path, 2).to_pylist() == [k.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    changed = json.load(open(t.default_vocabulary()))
    changed["normalizer"]["normalizers"].pop()                     # keeps upper case
    (tmp_path / "v.json").write_text(json.dumps(changed))
    k = Tokenizer.from_file(str(tmp_path / "v.json"))
    assert t.encode_column(pa.array(["The END", "a"]), str(tmp_path / "v.json"), 2).to_pylist() == [
        k.encode(x).ids + [2] for x in ("The END", "a")]
    assert t.can_cut(t.default_vocabulary())


def test_special_token_strings_never_become_control_ids():
    ids = t.encode_column(pa.array(["end of file <|endoftext|> next <|startoftext|>"]), t.default_vocabulary(), 2).to_pylist()[0]
    assert ids[:10] == [806, 539, 4512, 27, 347, 40786, 4160, 91, 285, 1131] and not {49406, 49407} & set(ids)


def test_cache_is_bounded(expected, monkeypatch):
    monkeypatch.setattr(t, "CACHE_CHUNKS", 10)
    encoder = t.ChunkEncoder(t.default_vocabulary())
    for x, ids in zip(TEXTS[:60], expected):
        assert list(encoder(pa.array([x], pa.string()))[0]) == ids[:-1]


def test_files_read_back(spark, expected):
    rows = [(7 * i % 1000 - 3, x, "clash", 5) for i, x in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens string, part int").repartition(5)
    path = t.write_token_files(docs, shared_path(spark, "test-tokens"))
    got = sorted(t.read_token_files(spark, path).collect(), key=lambda r: r.doc_id)
    start = 0
    wanted = sorted(zip(rows, expected), key=lambda x: x[0][0])
    for ((doc_id, *_), ids), r in zip(wanted, got, strict=True):
        raw = np.array(ids, "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(raw))
        start += len(ids)


def test_ties_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a a"), (None, "x"), (1, "b")], "doc_id bigint, text string")
    got = t.read_token_files(spark, t.write_token_files(docs, shared_path(spark, "test-tokens"))).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in got) == [(0, None, 2), (2, 1, 3), (5, 1, 2), (7, 1, 2)]
    empty = t.write_token_files(docs.limit(0), shared_path(spark, "test-tokens"))
    assert t.read_token_files(spark, empty).count() == 0


def test_other_order(spark):
    docs = spark.createDataFrame([(i, "w", 100 - i) for i in range(50)], "doc_id bigint, text string, k int")
    path = t.write_token_files(docs, shared_path(spark, "test-tokens"), order=("k",))
    got = sorted(t.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == list(range(49, -1, -1))


def test_stripes_and_pruning(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(t, "STRIPE_BYTES", 64 << 10)
    r = random.Random(3)
    docs = spark.createDataFrame([(2 * i, " ".join(str(r.random()) for _ in range(30))) for i in range(6000)],
                                 "doc_id bigint, text string").coalesce(1)
    path = t.write_token_files(docs, str(tmp_path / "tokens"))
    import pyarrow.orc as orc
    files = sorted((tmp_path / "tokens").glob("*.orc"))
    assert max(orc.ORCFile(f).nstripes for f in files) > 1
    assert b"orc" in files[0].read_bytes()[:3].lower()
    some = t.read_documents(spark, path, [10, 11, 4000])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    assert sorted(x.doc_id for x in some.collect()) == [10, 4000]
