"""Work that is done once: the decode of a batch, a lookup table's reduction, a service's answers."""

import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from relaysql import JobSpec, SqlJob
from relaysql.functions.lookup import lookup_join, lookup_snapshot, service_answers, service_join

SQL = "select a.name, b.n from source a join (select age, count(*) as n from source group by age) b on a.age = b.age"


def _job(sql=SQL, **kw):
    return SqlJob(JobSpec(input_schema='{"name":"string","age":"int"}', output_schema='{"name":"string"}', sql=sql), **kw)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(spark):
    from relaysql.session import checkpoint_root

    found = set()
    for root, _, files in os.walk(os.path.join(checkpoint_root(spark), "relaysql")):
        found |= {root} if files else set()
    return found


@pytest.mark.parametrize("share", ["cache", "store", "no"])
def test_a_batch_is_decoded_once(spark, messages, share):
    job = _job(share=share)
    s = job.open(spark)
    texts = [f'{{"name":"n{i}","age":{i % 3}}}' for i in range(20)] + ['{"name":"x","age":"1,0"}']
    out = job.run_batch(messages(s, texts))
    plan = _plan(out.values)
    assert out.mentions == 2 and ("InMemoryTableScan" in plan) == (share == "cache")
    # below a cached relation the plan shows what made it, at each of its two scans
    always = [line for line in plan.split("\n") if "from_json(" in line and "CASE WHEN" not in line]
    assert len(always) == (0 if share == "store" else 2) and plan.count("InMemoryRelation") == (2 if share == "cache" else 0)
    assert sorted((r.name, r.n) for r in out.result.collect())[-1] == ("x", 1) and out.values.count() == 21
    assert (out.stored_at is not None and os.path.isdir(out.stored_at)) == (share == "store")
    out.release()
    assert out.stored_at is None or not os.path.exists(out.stored_at)
    assert not out.checked.is_cached


def test_one_mention_shares_nothing_and_bad_records_still_fail(spark, messages):
    job = _job("select name from source")
    out = job.run_batch(messages(job.open(spark), ['{"name":"a","age":1}']))
    assert not out.cached and out.stored_at is None
    job = _job()
    out = job.run_batch(messages(job.open(spark), ['{"name":"a","age":1}', '{"age":2}']))
    with pytest.raises(Exception, match="missing:name"):
        out.values.collect()
    out.release()
    with pytest.raises(ValueError, match="share"):
        _job(share="sometimes")


def test_small_lookup_writes_nothing_and_a_snapshot_is_reused(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    table = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), (None, "q")], "k string, v string")
    want = [(1, "a", "y"), (2, "b", "z"), (3, None, None)]
    before = _stored(spark)
    snapshot = lookup_snapshot(table, "k", ["v"])
    made = _stored(spark)
    assert len(made - before) == 1
    for _ in range(2):
        assert sorted(tuple(r) for r in lookup_join(df, "k", snapshot).collect()) == want
    assert _stored(spark) == made
    snapshot.release()
    assert _stored(spark) == before
    # read from files, its size is known: broadcast when the join runs, nothing stored
    path = snapshot.path + "-small"
    table.write.parquet(path)
    before = _stored(spark)
    small = lookup_join(df, "k", spark.read.parquet(path), "k", ["v"])
    assert "BroadcastHashJoin" in _plan(small) and sorted(tuple(r) for r in small.collect()) == want and _stored(spark) == before


class CountingClient:
    """Writes down each key it is asked for."""

    def __init__(self, folder):
        self.folder = folder

    def get(self, key):
        import uuid

        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            f.write(repr(key))
        return None if key == "unknown" else f"v-{key}"


def test_every_key_is_asked_once_whatever_the_rows(spark, tmp_path):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).when(
        F.col("id") % 100 == 2, "unknown").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k")).repartition(16)
    out = service_join(df, "k", partial(CountingClient, str(tmp_path)), "v", max_in_flight=4)
    rows = out.collect()
    rows = out.collect()                                  # a second action asks nobody
    assert len(rows) == 2000
    for r in rows:
        assert r.v == (None if r.k in (None, "unknown") else f"v-{r.k}")
    asked = sorted(open(os.path.join(tmp_path, f)).read() for f in os.listdir(tmp_path))
    assert asked == sorted(repr(k) for k in {r.k for r in rows} - {None})


def test_service_with_other_key_types_and_no_rows(spark, tmp_path):
    df = spark.range(5)
    got = {r.id: r.value for r in service_join(df, "id", partial(CountingClient, str(tmp_path)), max_in_flight=2).collect()}
    assert got == {i: f"v-{i}" for i in range(5)}
    assert service_join(df.where("id > 9"), "id", partial(CountingClient, str(tmp_path))).collect() == []
    answers = service_answers(df, "id", partial(CountingClient, str(tmp_path)), max_in_flight=3)
    assert answers.table.count() == 5
    with pytest.raises(ValueError):
        service_answers(df, "id", partial(CountingClient, str(tmp_path)), max_in_flight=0)
