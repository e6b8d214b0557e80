import pytest
from pyspark.sql import functions as F

from relaysql.functions import library
from relaysql.functions.lookup import const_lookup, lookup_join, service_lookup
from relaysql.functions.registry import (
    FunctionConfigError,
    param_arity,
    parse_function_config,
    register_function,
    register_functions,
)
from relaysql.session import job_session
from tests.fake_service import make_client


@pytest.mark.parametrize("param,n", [("(String)", 1), ("(String,String)", 2), ("(String,String,String)", 3),
                                     ("()", 1), ("(String,)", 1), ("(,String)", 2), ("(,)", 0),
                                     ("(a,b,c,d)", 4)])
def test_param_arity(param, n):
    assert param_arity(param) == n


def test_config_rules():
    assert parse_function_config("") == ()
    assert parse_function_config("   ") == ()
    (s,) = parse_function_config('[{"name":"m1","mainClass":"m:f","param":"()","returnType":"String"}]')
    assert s.arity == 1 and s.spark_return_type.simpleString() == "string"
    with pytest.raises(FunctionConfigError):
        parse_function_config('[{"name":"m1","mainClass":"m:f","param":"(a,b,c,d)"}]')
    with pytest.raises(FunctionConfigError):
        parse_function_config('[{"name":"m1","mainClass":"m:f"}]')
    with pytest.raises(FunctionConfigError):
        parse_function_config('{"name":"m1"}')


def test_sql_functions_follow_jvm_concat(spark):
    s = job_session(spark)
    register_function(s, "m1", library.suffix_new)
    register_function(s, "MyUDF", library.suffix_test)
    register_function(s, "m2", library.join2)
    register_function(s, "m3", library.join3)
    r = s.sql("select m1('jack') a, m1(null) b, MyUDF('x') c, m2('a', null) d, m3('a', 1, true) e").collect()[0]
    assert tuple(r) == ("jack_new", "null_new", "x_Test", "a_null", "a_1_true")


def test_sql_function_is_inlined_not_python(spark):
    s = job_session(spark)
    register_function(s, "m1", library.suffix_new)
    plan = s.sql("select m1(cast(id as string)) from range(3)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "concat" in plan


def test_multi_column_function(spark):
    s = job_session(spark)
    register_function(s, "hs", library.head_tail)
    r = s.sql("select m.* from (select hs('view') as m)").collect()[0]
    assert (r.head, r.tail) == ("v", "iew")


def test_register_from_config_with_python(spark):
    s = job_session(spark)
    register_functions(s, parse_function_config(
        '[{"name":"p1","mainClass":"relaysql.functions.library:reverse_text","param":"(String)","returnType":"string"},'
        '{"name":"m1","mainClass":"relaysql.functions.library.suffix_new","param":"(String)","returnType":"string"}]'))
    assert tuple(s.sql("select p1('abc') a, m1('x') b").collect()[0]) == ("cba", "x_new")


def test_plain_python_callable(spark):
    s = job_session(spark)
    register_function(s, "up", lambda x: None if x is None else x.upper())
    assert s.sql("select up('ab') u").collect()[0].u == "AB"


def test_arity_mismatch_and_bad_target(spark):
    s = job_session(spark)
    with pytest.raises(FunctionConfigError):
        register_function(s, "m", library.join2, arity=1)
    with pytest.raises(FunctionConfigError):
        register_functions(s, parse_function_config('[{"name":"m","mainClass":"no.such:thing","param":"()"}]'))


def test_const_lookup(spark):
    s = job_session(spark)
    s.createDataFrame([("k1", "v1"), ("k2", "v2")], "k string, v string").createOrReplaceTempView("kv")
    register_function(s, "lp", const_lookup("kv", "k", "v", "k1", "plus"))
    register_function(s, "lq", const_lookup("kv", "k", "v", "k1", "pooled"))
    register_function(s, "lm", const_lookup("kv", "k", "v", "missing", "pooled"))
    r = s.sql("select lp('jack') a, lq('jack') b, lm('jack') c").collect()[0]
    assert tuple(r) == ("jack+v1", "jack_v1_new", "jack_null_new")


def test_const_lookup_runs_once_as_subquery(spark):
    s = job_session(spark)
    s.createDataFrame([("k1", "v1")], "k string, v string").createOrReplaceTempView("kv")
    register_function(s, "lp", const_lookup("kv", "k", "v"))
    plan = s.sql("select lp(cast(id as string)) from range(10)")._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan


def test_service_lookup_fixed_and_keyed(spark):
    df = spark.createDataFrame([("jack",), (None,), ("zed",)], "name string")
    fixed = service_lookup(make_client)
    keyed = service_lookup(make_client, key=None, style="plus")
    got = [tuple(r) for r in df.select(fixed("name").alias("a"), keyed("name").alias("b")).collect()]
    assert got == [("jack_v1_new", "jack+J"), ("null_v1_new", "null+null"), ("zed_v1_new", "zed+null")]


def test_lookup_join_is_broadcast_by_size_only(spark):
    session = spark.newSession()
    left = session.createDataFrame([(1,), (2,), (3,)], "k int")
    table = session.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    small = lookup_join(left, "k", table, "id", ["v"])
    assert sorted(tuple(r) for r in small.collect()) == [(1, "b"), (2, "c"), (3, None)]
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "strategy=broadcast" not in small._jdf.queryExecution().optimizedPlan().toString()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = lookup_join(left, "k", table, "id", ["v"])
    assert sorted(tuple(r) for r in big.collect()) == [(1, "b"), (2, "c"), (3, None)]
    assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()


def test_python_functions_of_several_columns(spark):
    config = [{"name": n, "mainClass": f"relaysql.functions.library:{t}", "param": "(String)",
               "returnType": "struct<head:string,tail:string,size:long>"} for n, t in (("sp", "split_text"), ("sr", "split_row"))]
    s = job_session(spark)
    register_functions(s, parse_function_config(config))
    s.createDataFrame([("jack",), ("",), (None,)], "t string").createOrReplaceTempView("texts")
    rows = s.sql("select t, sp(t) as a, sr(t) as b from texts").collect()
    got = {r.t: (tuple(r.a), r.b and tuple(r.b)) for r in rows}
    assert got == {"jack": (("j", "ack", 4), ("j", "ack", 4)), "": (("", "", 0), ("", "", 0)),
                   None: ((None, None, None), None)}
    assert s.sql("select m.* from (select sp(t) as m from texts)").columns == ["head", "tail", "size"]


def test_struct_return_types_are_checked(spark):
    bad = {"name": "x", "mainClass": "relaysql.functions.library:split_row", "param": "(String)"}
    (spec,) = parse_function_config([{**bad, "returnType": "struct<head string"}])
    with pytest.raises(FunctionConfigError, match="returnType"):
        register_functions(job_session(spark), (spec,))
    (spec,) = parse_function_config([{**bad, "mainClass": "relaysql.functions.library:suffix_new", "returnType": "struct<a:int>"}])
    with pytest.raises(FunctionConfigError, match="config says"):
        register_functions(job_session(spark), (spec,))
