import json
import os

import pytest

from relaysql import JobSpec, SqlJob
from relaysql.plans.job import versioned_view
from relaysql.session import shared_path
from relaysql.sources.topic import kafka_sink, kafka_source, text_sink, text_source
from relaysql.streaming.runner import start_stream

IN = '{"k":"int","t":"string"}'


def _publish(spark, folder, texts):
    text_sink(folder).write(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1))


def _read(spark, folder):
    return [json.loads(r.value) for r in text_source(folder).read(spark).collect()]


def test_stream_is_batch_local_and_resumes_from_checkpoint(spark):
    topic, out, ckpt = (shared_path(spark, "t", n) for n in ("in", "out", "ckpt"))
    job = SqlJob(JobSpec(input_schema=IN, output_schema='{"n":"long","total":"long"}',
                         sql="select count(*) as n, sum(k) as total from source"))
    for batch in (['{"k":1,"t":"a"}', '{"k":2,"t":"b"}'], ['{"k":10,"t":"c"}']):
        _publish(spark, topic, batch)
        q = start_stream(job, spark, text_source(topic), text_sink(out), checkpoint=ckpt, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(_read(spark, out), key=lambda d: d["n"]) == [{"n": 1, "total": 10}, {"n": 2, "total": 3}]
    (run,) = [d for d in os.listdir(out) if d.startswith("run=")]       # one checkpoint, one identity
    assert sorted(d for d in os.listdir(f"{out}/{run}") if d.startswith("batch_id=")) == ["batch_id=0", "batch_id=1"]


def test_stream_quarantine_sink(spark):
    topic, out, bad, ckpt = (shared_path(spark, "q", n) for n in ("in", "out", "bad", "ckpt"))
    job = SqlJob(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql="select k from source",
                         on_bad_record="quarantine"))
    _publish(spark, topic, ['{"k":1,"t":"a"}', 'oops', '{"k":"x","t":"b"}'])
    q = start_stream(job, spark, text_source(topic), text_sink(out), quarantine=text_sink(bad), checkpoint=ckpt,
                     available_now=True)
    q.awaitTermination()
    assert _read(spark, out) == [{"k": 1}]
    assert sorted(d["reason"] for d in _read(spark, bad)) == ["coercion:k", "malformed"]


def test_text_sink_batch_rerun_overwrites(spark):
    out = shared_path(spark, "rerun")
    sink = text_sink(out)
    sink.write(spark.createDataFrame([("a",), ("b",)], "value string"), batch_id=3, run="r1")
    sink.write(spark.createDataFrame([("a",), ("b",)], "value string"), batch_id=3, run="r1")
    assert sorted(r.value for r in text_source(out).read(spark).collect()) == ["a", "b"]
    # another run's batch of the same number stands beside it
    sink.write(spark.createDataFrame([("c",)], "value string"), batch_id=3, run="r2")
    assert sorted(r.value for r in text_source(out).read(spark).collect()) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="identity"):
        sink.write(spark.createDataFrame([("a",)], "value string"), batch_id=3)


def test_second_job_on_one_folder_keeps_the_first_ones_output(spark):
    topic, out = shared_path(spark, "two", "in"), shared_path(spark, "two", "out")
    job = SqlJob(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql="select k from source"))
    _publish(spark, topic, ['{"k":1,"t":"a"}'])
    for _ in range(2):
        q = start_stream(job, spark, text_source(topic), text_sink(out), checkpoint=shared_path(spark, "two", "ckpt"), available_now=True)
        q.awaitTermination()
    assert _read(spark, out) == [{"k": 1}, {"k": 1}]


def test_start_refuses_to_lose_rejects_or_share_a_checkpoint(spark):
    topic, out = shared_path(spark, "no", "in"), shared_path(spark, "no", "out")
    _publish(spark, topic, ["oops"])
    job = SqlJob(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql="select k from source", on_bad_record="quarantine"))
    with pytest.raises(ValueError, match="quarantine sink"):
        start_stream(job, spark, text_source(topic), text_sink(out), checkpoint=shared_path(spark, "no", "ckpt"))
    plain = SqlJob(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql="select k from source"))
    with pytest.raises(ValueError, match="checkpoint"):
        start_stream(plain, spark, text_source(topic), text_sink(out))


def test_source_named_twice_is_decoded_once_per_batch(spark):
    topic, out = shared_path(spark, "once", "in"), shared_path(spark, "once", "out")
    sql = "select k from source where k >= (select avg(k) from source) union all select k from source where k = 1"
    job = SqlJob(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql=sql))
    _publish(spark, topic, ['{"k":1,"t":"a"}', '{"k":3,"t":"b"}'])
    seen = []
    run_batch = job.run_batch

    def watched(messages, *a):
        seen.append(run_batch(messages, *a))
        return seen[-1]

    job.run_batch = watched
    sink = text_sink(out)
    plans = []

    class Watching(type(sink)):
        def write(self, values, *a, **k):
            plans.append(values._jdf.queryExecution().executedPlan().toString())
            super().write(values, *a, **k)

    q = start_stream(job, spark, text_source(topic), Watching("text", out), checkpoint=shared_path(spark, "once", "ckpt"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None and sorted(d["k"] for d in _read(spark, out)) == [1, 3]
    assert seen[0].mentions == 3 and "InMemoryTableScan" in plans[0]
    assert not seen[0].checked.is_cached                 # released after the batch
    one = SqlJob(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql="select k from source"))
    session = one.open(spark)
    assert one.run_batch(session.read.text(topic)).mentions == 1


def test_kafka_options():
    src = kafka_source("h1:9092,h2:9092", "stu", "g1", maxOffsetsPerTrigger=1000)
    opts = src.reader_options(streaming=True)
    assert opts["kafka.bootstrap.servers"] == "h1:9092,h2:9092" and opts["subscribe"] == "stu"
    assert opts["startingOffsets"] == "latest" and opts["kafka.group.id"] == "g1"
    assert opts["maxOffsetsPerTrigger"] == "1000" and "endingOffsets" not in opts
    dump = kafka_source("h:9092", "stu_clean", starting_offsets="earliest").reader_options(streaming=False)
    assert src.reader_options(streaming=False)["startingOffsets"] == "earliest"      # a batch cannot start at the end
    assert dump["startingOffsets"] == "earliest" and dump["endingOffsets"] == "latest"
    assert kafka_sink("h:9092", "stu_clean").writer_options() == {"kafka.bootstrap.servers": "h:9092",
                                                                  "topic": "stu_clean"}


def test_quarantine_batch_parses_once(spark):
    from relaysql.plans.job import SqlJob as Job

    job = Job(JobSpec(input_schema=IN, output_schema='{"k":"int"}', sql="select k from source",
                      on_bad_record="quarantine"))
    s = job.open(spark)
    out = job.run_batch(s.createDataFrame([('{"k":1,"t":"a"}',), ("oops",), ('{"k":2}',)], "value string"))
    out.checked.persist()
    try:
        for df in (out.values, out.rejected):
            assert "InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()
        assert [r.value for r in out.values.collect()] == ['{"k":1}']
        assert sorted(r.reason for r in out.rejected.collect()) == ["malformed", "missing:t"]
    finally:
        out.checked.unpersist()


def test_cli_runs_text_job(spark, tmp_path):
    from relaysql.__main__ import main

    topic, out = shared_path(spark, "cli", "in"), shared_path(spark, "cli", "out")
    _publish(spark, topic, ['{"name":"jack","age":21}'])
    funcs = ('[{"name":"m1","mainClass":"relaysql.functions.library:suffix_new",'
             '"param":"(String)","returnType":"string"}]')
    args = ["local[2]", "5", "cli-test", topic, out, "stu", "stu_clean", "g1", '{"name":"string","age":"int"}',
            '{"newname":"string","age":"int"}', funcs, "select m1(name) as newname,age from source",
            "--transport", "text", "--available-now", "--checkpoint", str(tmp_path / "ckpt")]
    assert main(args) == 0
    assert _read(spark, out) == [{"newname": "jack_new", "age": 21}]


def test_missing_kafka_connector_is_explained(spark):
    import pytest

    from relaysql.sources.topic import ConnectorMissing

    with pytest.raises(ConnectorMissing, match="spark-sql-kafka"):
        kafka_source("localhost:1", "stu").read(spark)


def test_missing_kafka_connector_on_write(spark):
    import pytest

    from relaysql.sources.topic import ConnectorMissing

    with pytest.raises(ConnectorMissing):
        kafka_sink("localhost:1", "out").write(spark.createDataFrame([("x",)], "value string"))


def test_cli_quarantine_and_wrong_arity(spark, tmp_path):
    import pytest

    from relaysql.__main__ import main
    from relaysql.spec import JobSpecError

    topic, out, bad = (shared_path(spark, "cliq", n) for n in ("in", "out", "bad"))
    _publish(spark, topic, ['{"name":"a","age":1}', '{"age":2}'])
    args = ["local[2]", "5", "cli-q", topic, out, "in", "out", "g1", '{"name":"string","age":"int"}',
            '{"name":"string"}', "", "select name from source"]
    assert main(args + ["--transport", "text", "--available-now", "--quarantine", bad,
                        "--checkpoint", str(tmp_path / "ckpt")]) == 0
    assert _read(spark, out) == [{"name": "a"}]
    assert [d["reason"] for d in _read(spark, bad)] == ["missing:name"]
    with pytest.raises(JobSpecError):
        main(args[:-1] + ["--transport", "text"])


@pytest.mark.parametrize("kind", ["path", "versions"])
def test_reference_data_follows_its_table_between_batches(spark, kind):
    topic, out, ckpt, ref = (shared_path(spark, "live", n) for n in ("in", "out", "ckpt", "ref"))

    def publish(version, rows):
        df = spark.createDataFrame(rows, "k int, name string").coalesce(1)
        df.write.mode("overwrite").parquet(ref if kind == "path" else f"{ref}/version={version}")

    publish(9, [(1, "one"), (2, "two")])
    job = SqlJob(JobSpec(input_schema=IN, output_schema='{"t":"string","name":"string","n":"long"}', interval_seconds=1,
                         sql="select t, name, (select count(*) from names) as n from source left join names using (k)"),
                 reference_views={"names": ref if kind == "path" else versioned_view(ref)})
    _publish(spark, topic, ['{"k":1,"t":"a"}', '{"k":3,"t":"b"}'])
    q = start_stream(job, spark, text_source(topic), text_sink(out), checkpoint=ckpt)
    try:
        q.processAllAvailable()
        publish(10, [(1, "uno"), (2, "two"), (3, "tres")])
        if kind == "versions":                                  # one that is not whole yet
            spark.createDataFrame([(1, "half")], "k int, name string").write.parquet(f"{ref}/version=11")
            os.remove(f"{ref}/version=11/_SUCCESS")
        _publish(spark, topic, ['{"k":1,"t":"c"}', '{"k":3,"t":"d"}'])
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((d["t"], d.get("name"), d["n"]) for d in _read(spark, out))
    assert got == [("a", "one", 2), ("b", None, 2), ("c", "uno", 3), ("d", "tres", 3)]


def test_reader_sees_whole_batches_only(spark):
    out = shared_path(spark, "whole")
    sink, rows = text_sink(out), lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    seen = lambda: sorted(r.value for r in text_source(out).read(spark).collect())
    # a driver lost while batch 0 was written: files are there, the marker is not
    rows("half").write.text(f"{out}/run=r1/batch_id=0/attempt=dead")
    assert seen() == []
    sink.write(rows("a", "b"), batch_id=0, run="r1")
    assert seen() == ["a", "b"]
    assert len([d for d in os.listdir(f"{out}/run=r1/batch_id=0") if d.startswith("attempt=")]) == 1
    before = text_source(out).read(spark)
    # a re-run of a batch that was committed changes nothing under a reader
    sink.write(rows("a", "b"), batch_id=0, run="r1")
    rows("half").write.text(f"{out}/run=r1/batch_id=1/attempt=dead")
    assert sorted(r.value for r in before.collect()) == seen() == ["a", "b"]
    sink.write(rows(), batch_id=1, run="r1")                    # an empty batch
    sink.write(rows("c"), batch_id=10, run="r1")
    sink.write(rows("d"))                                       # appended beside the stream's batches
    assert seen() == ["a", "b", "c", "d"]
    # two drivers made markers for one batch: one of them counts
    rows("x").write.text(f"{out}/run=r2/batch_id=1/attempt=aa")
    rows("y").write.text(f"{out}/run=r2/batch_id=1/attempt=bb")
    os.makedirs(f"{out}/run=r2/_commits")
    for name in ("1-bb", "1-aa"):
        open(f"{out}/run=r2/_commits/{name}", "w").close()
    assert seen() == ["a", "b", "c", "d", "x"]
    rows("old").write.text(f"{out}/run=r0/batch_id=0")          # written before batches had attempts
    assert seen() == ["a", "b", "c", "d", "old", "x"]
