import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from relaysql.operators.decode import decode
from relaysql.operators.schema import parse_schema_spec

SCHEMA_A = parse_schema_spec('{"name":"string","age":"int"}')

# FIXTURES §3: message -> (name, age) or the bad-record reason
EDGE = [
    ('{"name":"jack","age":21}', ("jack", 21)),
    ('{"name":5,"age":"21"}', ("5", 21)),
    ('{"name":{"a":1},"age":"1,234"}', ('{"a":1}', 1234)),
    ('{"name":[1, 2],"age":21.9}', ("[1,2]", 21)),
    ('{"name":"n"}', ("n", 0)),
    ('{"name":"n","age":null}', ("n", 0)),
    ('{"name":"n","age":true}', ("n", 1)),
    ("{name:'q',age:3}", ("q", 3)),
    ('{"name":"a","name":"b","age":1}', ("b", 1)),
    ('{"name":"x","age":1} tail', ("x", 1)),
    ('{"name":"n","age":""}', ("n", 0)),
    ('{"name":"n","age":"null"}', ("n", 0)),
    ('{"name":"n","age":" 7 "}', ("n", 7)),
    ('{"name":"n","age":"1e2"}', ("n", 100)),
    ('{"NAME":"n","age":1}', "missing:name"),
    ('{"name":null,"age":1}', "missing:name"),
    ('{"name":"n","age":"abc"}', "coercion:age"),
    ('{"name":"n","age":3000000000}', "coercion:age"),
    ("not json", "malformed"),
    ('[{"name":"n"}]', "malformed"),
    ("", "empty"),
    (None, "empty"),
]


def _run(spark, messages, fields, texts, policy="quarantine"):
    df = messages(spark, texts)
    return decode(df, fields, policy)


def test_edge_messages_quarantine(spark, messages):
    out = _run(spark, messages, SCHEMA_A, [m for m, _ in EDGE])
    good = sorted((r["name"], r["age"]) for r in out.rows.collect())
    bad = sorted((r["value"] or "", r["reason"]) for r in out.rejected.collect())
    assert good == sorted(e for _, e in EDGE if isinstance(e, tuple))
    assert bad == sorted(((m or ""), e) for m, e in EDGE if isinstance(e, str))


def test_fail_policy_raises_on_bad_record(spark, messages):
    out = _run(spark, messages, SCHEMA_A, ['{"name":"a","age":1}', '{"name":"n","age":"abc"}'], "fail")
    with pytest.raises((PySparkException, CapturedException, Exception), match="coercion:age"):
        out.rows.collect()


def test_fail_policy_passes_good_batches(spark, messages):
    out = _run(spark, messages, SCHEMA_A, ['{"name":"a","age":"1,000"}'], "fail")
    assert [tuple(r) for r in out.rows.collect()] == [("a", 1000)]


def test_fail_policy_checks_rows_even_when_no_column_is_read(spark, messages):
    out = _run(spark, messages, SCHEMA_A, ['{"name":"a"}', "not json"], "fail")
    with pytest.raises(Exception, match="malformed"):
        out.rows.count()


def test_every_type(spark, messages):
    fields = parse_schema_spec('{"s":"string","i":"int","l":"long","d":"double","f":"float","b":"boolean",'
                               '"sa":"array<string>","ia":"array<int>","x":"timestamp"}')
    msg = ('{"s":"a","i":"2","l":9000000000,"d":"1,234.5","f":1.5,"b":"Y",'
           '"sa":["code",1,null,{"a":1}],"ia":["1","2,0",3.0,null],"x":{"t":1}}')
    out = _run(spark, messages, fields, [msg])
    (r,) = out.rows.collect()
    assert r.s == "a" and r.i == 2 and r.l == 9000000000 and r.d == 1234.5 and r.f == 1.5 and r.b is True
    assert r.sa == ["code", "1", None, '{"a":1}']
    assert r.ia == [1, 20, 3, 0]
    assert r.x == '{"t":1}'


def test_boolean_spellings_and_defaults(spark, messages):
    fields = parse_schema_spec('{"k":"int","b":"boolean"}')
    texts = ['{"k":1,"b":true}', '{"k":2,"b":"t"}', '{"k":3,"b":"1"}', '{"k":4,"b":"N"}', '{"k":5,"b":"false"}',
             '{"k":6}', '{"k":7,"b":"maybe"}']
    out = _run(spark, messages, fields, texts)
    assert sorted(tuple(r) for r in out.rows.collect()) == [
        (1, True), (2, True), (3, True), (4, False), (5, False), (6, False)]
    assert [r.reason for r in out.rejected.collect()] == ["coercion:b"]


def test_array_rules(spark, messages):
    fields = parse_schema_spec('{"ia":"array<int>","sa":"array<string>"}')
    texts = ['{"ia":[1],"sa":[]}', '{"sa":[]}', '{"ia":["x"],"sa":[]}', '{"ia":[1],"sa":"scalar"}']
    out = _run(spark, messages, fields, texts)
    assert [tuple(r) for r in out.rows.collect()] == [([1], [])]
    assert sorted(r.reason for r in out.rejected.collect()) == ["coercion:ia", "malformed", "missing:ia"]


def test_numeric_defaults_for_all_numeric_types(spark, messages):
    fields = parse_schema_spec('{"i":"int","l":"long","d":"double","f":"float","b":"boolean"}')
    (r,) = _run(spark, messages, fields, ["{}"]).rows.collect()
    assert tuple(r) == (0, 0, 0.0, 0.0, False)


def test_undeclared_keys_and_other_columns_are_dropped(spark):
    df = spark.createDataFrame([("k", '{"name":"a","age":1,"extra":2}', 7)], "key string, value string, offset int")
    out = decode(df, SCHEMA_A, "fail")
    assert out.rows.columns == ["name", "age"]


def test_reserved_field_names(spark, messages):
    with pytest.raises(ValueError, match="reserved"):
        decode(messages(spark, ["{}"]), parse_schema_spec('{"__ok":"int"}'))
