"""The pipeline against what its stages must do to a small corpus."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline as c
from relaysql.llm import token_files
from relaysql.llm.ngram_join import similar_documents

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    path = tmp_path_factory.mktemp("corpus")
    text = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))
    rows = [(i, text(r.randint(60, 120)), "en", "big" if i % 3 else "small") for i in range(60)]
    item = text(25)
    rows += [(100, rows[5][1], "en", "big"), (101, rows[7][1] + " x", "en", "small"), (102, rows[7][1] + " y", "en", "small")]
    rows += [(200, text(60) + " " + item + " " + text(20), "en", "big"), (201, "too short", "en", "big"), (202, None, None, None),
             (203, "again and again " * 40, "en", "small")]
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], SCHEMA).repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, text(30))], "item_id bigint, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), {i: t for i, t, *_ in rows}


def stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in c.STAGES:
        out = stage(spark, docs, folder)
        yield name, docs, out
        docs = c.written(out, f"test-{name}")


def test_stages(spark, folder):
    path, texts = folder
    kept, columns = set(texts), spark.read.parquet(f"{path}/documents.parquet").columns
    for name, docs, out in stage_by_stage(spark, path):
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        if name != "token_files":
            assert out.columns == columns
        if name == "quality_rules":
            assert set(ids) == kept - {201, 202, 203} and len(ids) == len(set(ids))
        if name == "ngram_join":
            assert kept - set(ids) == {100, 101, 102} and len(ids) == len(set(ids))
        if name == "decontaminate":
            assert kept - set(ids) == {200}
        if name == "mixing":
            assert set(ids) == kept                              # all that is left is used, some of it again
            order = [r.doc_id for r in c.written(out, "test-order").collect()]
        if name == "token_files":
            rows = sorted(out.collect(), key=lambda r: r.start)
            assert [r.doc_id for r in rows] == order             # token files follow the mixture
            assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
            encoder = token_files.ChunkEncoder(token_files.default_vocabulary())
            for r in rows[:20]:
                assert r.n_tokens == 1 + len(encoder.tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        kept = set(ids)


def test_run_is_registered(spark, folder):
    path, _ = folder
    out = entry.queries()["pipeline"](spark, path)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() >= 60
    assert c.ORACLE_SQL is None and [n for n, _ in c.STAGES] == ["quality_rules", "ngram_join", "decontaminate", "mixing", "token_files"]


def test_empty_corpus_and_rows_with_one_id(spark, folder, tmp_path):
    path, texts = folder
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in c.STAGES:
        assert stage(spark, empty, path).count() == 0, name
    text = texts[3]
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, text, "en", "s", 1), (2, text, "en", "s", 1),
                                  (None, None, None, None, None)], SCHEMA)
    out = c.ngram_join(spark, docs, path)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (True, 0), (True, 0)]
    found = similar_documents(docs)
    assert found.where("component_id = 1").count() == 3


def test_unlike_texts_with_one_id_all_stay(spark, folder):
    path, texts = folder
    rows = [(1, texts[3]), (1, texts[4]), (2, texts[6]), (3, texts[4]), (3, texts[4]), (4, None), (4, None), (5, texts[8]), (6, texts[8])]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    out = sorted((r.doc_id, r.text or "") for r in c.ngram_join(spark, docs, path).collect())
    assert out == sorted([(1, texts[3]), (1, texts[4]), (2, texts[6]), (4, ""), (4, ""), (5, texts[8])])


def test_every_query_of_the_subpackage(spark):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
