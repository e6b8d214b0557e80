"""Edges of decode, encode, functions and commands that once lost or changed data."""

import json
import os
import subprocess
import sys
import time
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaysql import JobSpec, SqlJob
from relaysql.__main__ import main
from relaysql.functions.lookup import lookup_join, service_lookup
from relaysql.functions.registry import FunctionConfigError, parse_function_config, register_function, register_functions
from relaysql.operators.decode import decode
from relaysql.operators.schema import parse_schema_spec
from relaysql.session import job_session, shared_path

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NUMBERS = parse_schema_spec('{"i":"int","l":"long","a":"array<int>"}')


def decoded(spark, fields, texts):
    out = decode(spark.createDataFrame([(t,) for t in texts], "value string"), fields, "quarantine")
    return [tuple(r) for r in out.rows.collect()], sorted((r.value, r.reason) for r in out.rejected.collect())


def test_integers_truncate_toward_zero(spark):
    texts = {'{"i":21.9999999,"a":[]}': (21, 0, []), '{"i":-0.9999999,"a":[1.9999999,-1.9999999]}': (0, 0, [1, -1]),
             '{"i":2147483647.9999999,"a":[]}': (2147483647, 0, []), '{"l":"9223372036854775807.9","a":["2,000.99"]}': (0, 9223372036854775807, [2000]),
             '{"l":9007199254740993.5,"a":[]}': (0, 9007199254740993, []), '{"l":"0.000001e7","i":"125E-1","a":["1e2",".5"]}': (12, 10, [100, 0])}
    for text, want in texts.items():
        assert decoded(spark, NUMBERS, [text]) == ([want], [])


def test_any_exponent_is_decided_in_ordinary_time(spark):
    bad = ['{"i":1e1000000000,"a":[]}', '{"l":1e1000000000,"a":[]}', '{"i":"1e1000000000","a":[]}', '{"a":[1e1000000000]}', '{"a":["-1e99999999999999999999"]}']
    good = ['{"i":1e-1000000000,"l":"0e1000000000","a":["1e-99999999999"]}']
    t0 = time.time()
    rows, rejected = decoded(spark, NUMBERS, bad + good)
    assert rows == [(0, 0, [0])] and len(rejected) == len(bad) and {r.split(":")[0] for _, r in rejected} == {"coercion"}
    for text in bad:
        with pytest.raises(Exception, match="bad record"):
            decode(spark.createDataFrame([(text,)], "value string"), NUMBERS, "fail").rows.collect()
    assert time.time() - t0 < 60


def test_white_space_is_empty_and_absent(spark):
    plain = parse_schema_spec('{"i":"int","d":"double"}')
    rows, rejected = decoded(spark, plain, ["\t", "\n", " \r\n", " ", "", '{"i":"\\t","d":" \\n"}', '{"i":"\\t5","d":"1,000.5\\n"}'])
    assert sorted(rows) == [(0, 0.0), (5, 1000.5)] and {r for _, r in rejected} == {"empty"} and len(rejected) == 5


def test_only_finite_numbers(spark):
    fields = parse_schema_spec('{"d":"double","f":"float"}')
    bad = ['{"d":1e400}', '{"d":"5f"}', '{"d":"5d"}', '{"d":"NaN"}', '{"d":NaN}', '{"d":"Infinity"}', '{"f":1e39}', '{"f":"1e39"}']
    rows, rejected = decoded(spark, fields, bad + ['{"d":"1e3","f":"2.5"}'])
    assert rows == [(1000.0, 2.5)] and len(rejected) == len(bad)


def test_encode_null_elements_and_non_finite(spark):
    job = SqlJob(JobSpec(input_schema='{"k":"int"}', output_schema='{"a":"array<int>","d":"double","f":"float"}',
                         sql="select array(1, null, 2) as a, double('NaN') as d, float('-Infinity') as f from source"))
    session = job.open(spark)
    (row,) = job.run_batch(session.createDataFrame([('{"k":1}',)], "value string")).values.collect()
    assert json.loads(row.value) == {"a": [1, 0, 2], "d": 0.0, "f": 0.0}


def two(a, b):
    return f"{a}{b}"


def test_arity_and_return_type(spark):
    s = job_session(spark)
    with pytest.raises(FunctionConfigError, match="1 arguments"):
        register_function(s, "f", two, arity=1)
    register_function(s, "f", two, arity=2)
    assert s.sql("select f('a', 'b') as x").first().x == "ab"
    register_functions(s, parse_function_config(
        '[{"name":"n","mainClass":"relaysql.functions.library:join2","param":"(String,String)","returnType":"string"}]'))
    from relaysql.functions.library import SqlFunction
    register_function(s, "i", SqlFunction((("t", "STRING"),), "STRING", "t"), 1, T.IntegerType())
    assert s.sql("select i('7') as x").schema["x"].dataType == T.IntegerType()
    with pytest.raises(FunctionConfigError, match="takes no options"):
        register_functions(s, parse_function_config(
            '[{"name":"m","mainClass":"relaysql.functions.library:suffix_new","param":"(String)","options":{"view":"x"}}]'))


def test_run_batch_fires_no_job(spark):
    job = SqlJob(JobSpec(input_schema='{"k":"long"}', output_schema='{"k":"long"}', sql="select k from source"))
    session = job.open(spark)
    grouped = session.range(1000).groupBy((F.col("id") % 7).alias("k")).count().select(F.to_json(F.struct("k")).alias("value"))
    spark.sparkContext.setJobGroup("no-job", "run_batch")
    try:
        out = job.run_batch(grouped)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("no-job")) == []
        assert out.values.count() == 7
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("no-job")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookup_takes_one_real_row_per_key(spark):
    table = spark.createDataFrame([("k", "a", 9), ("k", "b", 2), (None, "z", 1), ("only", None, None)], "k string, x string, y int")
    left = spark.createDataFrame([("k",), ("only",), ("none",), (None,)], "key string")
    got = {r.key: (r.x, r.y) for r in lookup_join(left, "key", table, "k", ["x", "y"]).collect()}
    assert got == {"k": ("b", 2), "only": (None, None), "none": (None, None), None: (None, None)}


def test_hot_lookup_key_is_split(spark):
    s = spark.newSession()
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
                 "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        s.conf.set(k, v)
    left = s.range(200_000, numPartitions=8).select(F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("key"), F.uuid().alias("pad"))
    table = s.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = lookup_join(left, "key", table, "k", ["v"])
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


class Client:
    def __init__(self, name):
        self.name = name

    def get(self, key):
        return f"{self.name}:{key}"


def test_each_service_has_its_own_client(spark):
    one = spark.range(1).select(F.lit("t").alias("t")).coalesce(1)
    a, b = (service_lookup(partial(Client, n)) for n in ("A", "B"))
    for _ in range(2):
        r = one.select(a("t").alias("a"), b("t").alias("b")).first()
        assert (r.a, r.b) == ("t_A:k1_new", "t_B:k1_new")


def test_sample_job_with_lookup(spark):
    spec = JobSpec.sample(lookup=True)
    job = SqlJob(spec, reference_views={"kv": lambda s: s.createDataFrame([("k1", "v1")], "k string, v string")})
    session = job.open(spark)
    out = job.run_batch(session.createDataFrame([('{"name":"jack","age":21,"favors":["a"]}',)], "value string"))
    assert json.loads(out.values.first().value)["newname"] == "jack_v1_new"


def test_commands(spark, tmp_path, capsys):
    """publish a table, run a job whose lookup is configured, dump its output."""
    spark.createDataFrame([("jack", 21, ["a"])], "name string, age int, favors array<string>").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([("k1", "v1")], "k string, v string").write.parquet(str(tmp_path / "kv"))
    folder = lambda n: str(tmp_path / n)
    assert main(["publish", folder("t"), folder("in"), "--transport", "text"]) == 0
    sample = JobSpec.sample(lookup=True)
    values = ["", "1", "lookup-job", folder("in"), folder("out"), "", "", "", sample.input_schema, sample.output_schema, sample.functions, sample.sql]
    options = ["--transport", "text", "--available-now", "--checkpoint", folder("ckpt")]
    assert main([*values, *options, "--reference", f"kv={folder('kv')}"]) == 0
    capsys.readouterr()
    assert main(["dump", folder("out"), "--transport", "text"]) == 0
    assert json.loads(capsys.readouterr().out) == {"newname": "jack_v1_new", "age": 21, "favors": ["a"]}
    with pytest.raises(SystemExit, match="quarantine"):
        main([*values, *options, "--on-bad-record", "quarantine"])


SHIPPED = """
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", "file://" + sys.argv[1]).getOrCreate()
from relaysql.functions.registry import register_function
from relaysql.functions.library import reverse_text
register_function(spark, "p1", reverse_text)
print("GOT", spark.range(1).selectExpr("p1('abc') AS x").first().x)
"""


def test_package_reaches_executors_with_a_uri_checkpoint_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"}
    import pyspark
    home = tmp_path / "spark"          # executors write to "work" in Spark's home: give them one of their own
    home.mkdir()
    for name in os.listdir(os.path.dirname(pyspark.__file__)):
        if name != "work":
            (home / name).symlink_to(os.path.join(os.path.dirname(pyspark.__file__), name))
    env["SPARK_HOME"] = str(home)
    env["SPARK_SCALA_VERSION"] = "2.13"
    script = tmp_path / "shipped.py"
    script.write_text(SHIPPED % REPO)
    done = subprocess.run([sys.executable, str(script), str(tmp_path / "ckpt")], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "GOT cba" in done.stdout, done.stderr[-2000:]


def test_text_source_has_one_column(spark):
    from relaysql.sources.topic import text_sink, text_source
    out = shared_path(spark, "one-column")
    text_sink(out).write(spark.createDataFrame([("a",)], "value string"), batch_id=0, run="r")
    assert text_source(out).read(spark).columns == ["value"]


NINES = "9" * 41


@pytest.mark.parametrize("field,given,want", [
    ("l", "9007199254740993e0", 9007199254740993),
    ("l", "9007199254740993.0", 9007199254740993),
    ("l", "12345678901234567.8e1", 123456789012345678),
    ("l", "9223372036854775807.9999", 9223372036854775807),
    ("i", "0." + NINES, 0),
    ("i", "-0." + NINES, 0),
    ("i", "2147483647." + NINES, 2147483647),
    ("i", "1e-400000000", 0),
    ("i", "-0.0", 0),
    ("a", f'[0.{NINES},2.0,"1,0",null,1e2,9e-1]', [0, 2, 10, 0, 100, 0]),
    ("i", "1e400000000", None), ("i", "2147483648.0", None), ("l", "9223372036854775808.0", None),
    ("i", '{"z":1}', None), ("i", "NaN", None), ("a", "[1,2147483648e0]", None),
])
def test_integers_keep_the_digits_of_the_message(spark, field, given, want):
    from relaysql.operators.decode import decode
    from relaysql.operators.schema import parse_schema_spec

    fields = parse_schema_spec('{"i":"int","l":"long","a":"array<int>","s":"string","d":"double"}')
    values = {"i": "1", "l": "1", "a": "[]", "s": '"x, [7.0 \\" 1234567890123456789.0"', "d": "0.1234567890123456789"}
    for extra in ({}, {"d": '"1,000.5"'}):            # the typed parse fits, or does not
        text = "{" + ",".join(f'"{k}":{v}' for k, v in {**values, field: given, **extra}.items()) + "}"
        out = decode(spark.createDataFrame([(text,)], "value string"), fields, "quarantine")
        if want is None:
            assert [r.reason for r in out.rejected.collect()] == [f"coercion:{field}"]
        else:
            row = out.rows.collect()[0]
            assert row[field] == want and row.s == 'x, [7.0 " 1234567890123456789.0'


def test_a_long_message_with_long_digits(spark):
    from relaysql.operators.decode import decode
    from relaysql.operators.schema import parse_schema_spec

    text = json.dumps({"s": 'x\\"y\', 1[:2' * 200_000})[:-1] + ',"l":9007199254740993e0}'
    fields = parse_schema_spec('{"l":"long"}')
    assert decode(spark.createDataFrame([(text,)], "value string"), fields).rows.collect()[0].l == 9007199254740993
