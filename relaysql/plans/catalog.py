"""The checked queries: one per operator of SURVEY §2, each with a DuckDB oracle.

Every query reads the driver tables under ``sf_dir`` in full, turns them into
JSON messages the way a producer would, and runs a real job over them
(decode -> ``source`` -> SQL -> shape, and where the operator is about output,
encode -> re-read). ``ORACLES`` holds the equivalent SQL over the raw tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.functions.lookup import const_lookup, lookup_join, service_join
from relaysql.operators.band_join import band_join
from relaysql.operators.sketches import distinct_bound, estimates, merge, rank_bound, sketch
from relaysql.plans.conformance import CONFORMANCE
from relaysql.plans.job import BatchResult, SqlJob, preview
from relaysql.session import shared_path
from relaysql.sources.tables import (
    EVENT_SCHEMA,
    EVENT_SOURCE_SQL,
    as_messages,
    event_fields,
    event_messages,
    read_table,
)
from relaysql.sources.topic import table_as_messages, text_sink, text_source, value_only
from relaysql.spec import JobSpec
from relaysql.streaming.runner import start_stream

Query = Callable[[SparkSession, str], DataFrame]

LIB = "relaysql.functions.library"


def fn(name: str, target: str, param: str = "(String)", return_type: str = "string") -> dict:
    return {"name": name, "mainClass": f"{LIB}:{target}", "param": param, "returnType": return_type}


def spec_of(input_schema: str, output_schema: str | dict, sql: str, functions: list | None = None,
            **kw) -> JobSpec:
    out = output_schema if isinstance(output_schema, str) else json.dumps(output_schema)
    return JobSpec(input_schema=input_schema, output_schema=out, sql=sql,
                   functions=json.dumps(functions) if functions else "", **kw)


def run(spark: SparkSession, job: SqlJob, messages: Callable[[SparkSession], DataFrame]) -> BatchResult:
    """Open the job's session, build its messages there and run one batch."""
    session = job.open(spark)
    return job.run_batch(messages(session))


def events_job(spark: SparkSession, sf_dir: str, sql: str, output_schema: str | dict,
               functions: list | None = None, **job_kw) -> BatchResult:
    """A job over the ``events`` messages with the full ``events`` input schema."""
    job = SqlJob(spec_of(EVENT_SCHEMA, output_schema, sql, functions), **job_kw)
    return run(spark, job, lambda s: event_messages(s, sf_dir))


def sql_output(sql: str) -> Query:
    """A conformance query: no output schema, the SQL result is returned as is. A shared
    decode is stored, not cached: a cache nobody releases would serve later queries too."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return events_job(spark, sf_dir, sql, "", share="store").result

    return q


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return deco


def with_source(sql: str) -> str:
    return f"WITH source AS ({EVENT_SOURCE_SQL}) SELECT * FROM ({sql}) AS q"


# --- minimum slice: the flagship (S2, D1, D2, T1, Q1, F2, F3, O1, O2) -------------------

FLAGSHIP_INPUT = '{"user_id":"long","event_type":"string"}'
FLAGSHIP_OUTPUT = '{"newname":"string","user_id":"long"}'
FLAGSHIP_SQL = "select m1(event_type) as newname, user_id from source"
FLAGSHIP_FUNCTIONS = [fn("m1", "suffix_new")]
FLAGSHIP_ORACLE = "SELECT json_object('newname', event_type || '_new', 'user_id', user_id)::VARCHAR AS value FROM events"


def flagship_job() -> SqlJob:
    return SqlJob(spec_of(FLAGSHIP_INPUT, FLAGSHIP_OUTPUT, FLAGSHIP_SQL, FLAGSHIP_FUNCTIONS))


@register("sql_project_udf", FLAGSHIP_ORACLE)
def sql_project_udf(spark, sf_dir):
    """Events -> JSON -> decode -> ``m1(event_type)`` -> shape -> JSON text."""
    return run(spark, flagship_job(), lambda s: event_messages(s, sf_dir)).values


@register("sql_preview", "SELECT event_type || '_new' AS newname, user_id, event_id FROM events ORDER BY event_id LIMIT 20")
def sql_preview(spark, sf_dir):
    """Q2: the first rows of the result, as a preview shows them; the job's SQL orders
    its result, so the rows are determined."""
    return preview(events_job(spark, sf_dir, "select m1(event_type) as newname, user_id, event_id from source order by event_id",
                              {"newname": "string", "user_id": "long", "event_id": "long"}, FLAGSHIP_FUNCTIONS).shaped)


# --- decode (D1-D5) --------------------------------------------------------------------


def _plain(table: str, schema: dict, sql: str, out: dict | None = None,
           fields: Callable[[], list] | None = None, **spec_kw) -> Query:
    def q(spark, sf_dir):
        job = SqlJob(spec_of(json.dumps(schema), out or schema, sql, **spec_kw))
        return run(spark, job, lambda s: as_messages(read_table(s, sf_dir, table), *(fields() if fields else list(schema)))).shaped

    return q


register("decode_string", "SELECT c_custkey, c_name, c_mktsegment FROM customer")(
    _plain("customer", {"c_custkey": "long", "c_name": "string", "c_mktsegment": "string"},
           "select c_custkey, c_name, c_mktsegment from source",
           fields=lambda: ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
)

register("decode_int",
         "SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity, "
         "CAST(trunc(CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END * l_quantity) AS INTEGER) AS near FROM lineitem")(
    _plain("lineitem", {"l_orderkey": "long", "l_linenumber": "int", "l_quantity": "int", "near": "int"},
           "select l_orderkey, l_linenumber, l_quantity, near from source",
           # just below the next integer, or just above the next one down: truncated toward zero
           fields=lambda: ["l_orderkey", "l_linenumber", "l_quantity",
                           (F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)
                            * (F.floor("l_quantity").cast("decimal(12,0)") + F.lit("0.9999999").cast("decimal(8,7)"))).alias("near")])
)

register("decode_long",
         "SELECT o_orderkey, o_custkey, o_orderkey * 1000000000 + o_custkey AS big FROM orders")(
    _plain("orders", {"o_orderkey": "long", "o_custkey": "long"},
           "select o_orderkey, o_custkey, o_orderkey * 1000000000 + o_custkey as big from source",
           out={"o_orderkey": "long", "o_custkey": "long", "big": "long"})
)

register("decode_double",
         "SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax FROM lineitem")(
    _plain("lineitem", {"l_orderkey": "long", "l_linenumber": "int", "l_extendedprice": "double",
                        "l_discount": "double", "l_tax": "double"},
           "select * from source")
)

register("decode_float", "SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value_f FROM events")(
    _plain("events", {"event_id": "long", "value": "float"},
           "select event_id, cast(value as double) as value_f from source",
           out={"event_id": "long", "value_f": "double"})
)

register("decode_boolean",
         "SELECT event_id, value > 50 AS big, event_type IN ('click', 'view') AS flag FROM events")(
    _plain("events", {"event_id": "long", "big": "boolean", "flag": "boolean"},
           "select event_id, big, flag from source",
           fields=lambda: [
               "event_id", (F.col("value") > 50).alias("big"),
               # spellings a producer may use for booleans
               F.when(F.col("event_type") == "click", "Y").when(F.col("event_type") == "view", "t")
               .when(F.col("event_type") == "error", "0").when(F.col("event_type") == "signup", "FALSE")
               .otherwise("n").alias("flag"),
           ])
)


@register("decode_array_string",
          "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, "
          "CAST(count(DISTINCT event_type) AS INTEGER) AS n_types FROM events GROUP BY user_id")
def decode_array_string(spark, sf_dir):
    job = SqlJob(spec_of('{"user_id":"long","types":"array<string>"}',
                         {"user_id": "long", "types": "string", "n_types": "int"},
                         "select user_id, array_join(types, ',') as types, size(types) as n_types from source"))

    def messages(s):
        per_user = read_table(s, sf_dir, "events").groupBy("user_id").agg(
            F.sort_array(F.collect_set("event_type")).alias("types"))  # bounded: distinct types
        return as_messages(per_user, "user_id", "types")

    return run(spark, job, messages).shaped


@register("decode_array_int",
          "SELECT l_orderkey, array_to_string(list_sort(list(l_linenumber)), ',') AS lines, "
          "CAST(sum(l_linenumber) AS INTEGER) AS line_sum FROM lineitem GROUP BY l_orderkey")
def decode_array_int(spark, sf_dir):
    job = SqlJob(spec_of('{"l_orderkey":"long","lines":"array<int>"}',
                         {"l_orderkey": "long", "lines": "string", "line_sum": "int"},
                         "select l_orderkey, concat_ws(',', transform(lines, x -> cast(x as string))) as lines, "
                         "aggregate(lines, 0, (a, x) -> a + x) as line_sum from source"))

    def messages(s):
        per_order = read_table(s, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            F.sort_array(F.collect_list("l_linenumber")).alias("lines"))  # bounded: lines of one order
        as_text = F.transform("lines", lambda x: x.cast("string")).alias("lines")
        # even orders send the numbers as JSON strings, odd ones as numbers
        return per_order.select(
            F.when(F.col("l_orderkey") % 2 == 0, F.to_json(F.struct("l_orderkey", as_text)))
            .otherwise(F.to_json(F.struct("l_orderkey", "lines"))).alias("value"))

    return run(spark, job, messages).shaped


@register("decode_fallback_text",
          "SELECT event_id, replace(props, ' ', '') AS props, props->>'k' AS k FROM events")
def decode_fallback_text(spark, sf_dir):
    # props travels as a nested JSON object and is declared with an unknown type
    job = SqlJob(spec_of('{"event_id":"long","props":"object"}', {"event_id": "long", "props": "string", "k": "string"},
                         "select event_id, props, get_json_object(props, '$.k') as k from source"))
    return run(spark, job, lambda s: as_messages(
        read_table(s, sf_dir, "events"), "event_id", F.from_json("props", "k INT").alias("props"))).shaped


@register("decode_missing_defaults",
          "SELECT event_id, event_type, CASE WHEN event_type IN ('error', 'click', 'view') THEN 0.0 "
          "ELSE value END AS value, CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(user_id AS INTEGER) END AS n "
          "FROM events")
def decode_missing_defaults(spark, sf_dir):
    schema = {"event_id": "long", "event_type": "string", "value": "double", "n": "int"}
    et = F.col("event_type")
    job = SqlJob(spec_of(json.dumps(schema), schema, "select * from source"))
    return run(spark, job, lambda s: as_messages(
        read_table(s, sf_dir, "events"), "event_id", "event_type",
        # missing key / text "null" / empty text / the number as text
        F.when(et == "error", F.lit(None)).when(et == "click", "null").when(et == "view", "")
        .otherwise(F.col("value").cast("string")).alias("value"),
        F.when(et == "signup", F.lit(None)).otherwise(F.col("user_id")).alias("n"),
    )).shaped


@register("decode_coercion",
          "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent, "
          "o_custkey FROM orders")
def decode_coercion(spark, sf_dir):
    schema = {"o_orderkey": "long", "o_totalprice": "double", "urgent": "int", "o_custkey": "long"}
    job = SqlJob(spec_of(json.dumps(schema), schema, "select * from source"))
    return run(spark, job, lambda s: as_messages(
        read_table(s, sf_dir, "orders"),
        F.format_number("o_orderkey", 0).alias("o_orderkey"),        # "12,345"
        F.format_number("o_totalprice", 2).alias("o_totalprice"),    # "112,946.26"
        F.when(F.col("o_orderpriority") == "1-URGENT", "true").otherwise("false").alias("urgent"),
        (F.col("o_custkey") + F.lit(0.0)).alias("o_custkey"),       # 899.0
    )).shaped


@register("bad_record_quarantine",
          "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 10 <> 0 THEN 'ok' "
          "WHEN (event_id // 10) % 4 = 0 THEN 'malformed' WHEN (event_id // 10) % 4 = 1 THEN 'missing:event_type' "
          "WHEN (event_id // 10) % 4 = 2 THEN 'coercion:user_id' ELSE 'empty' END AS reason FROM events) t "
          "GROUP BY reason")
def bad_record_quarantine(spark, sf_dir):
    """Every 10th message is broken one of four ways; count accepted and rejected by reason."""
    schema = '{"event_id":"long","user_id":"long","event_type":"string"}'
    job = SqlJob(spec_of(schema, schema, "select * from source", on_bad_record="quarantine"))

    def messages(s):
        e = read_table(s, sf_dir, "events")
        kind = F.when(F.col("event_id") % 10 != 0, -1).otherwise(F.floor(F.col("event_id") / 10) % 4)
        good = F.to_json(F.struct("event_id", "user_id", "event_type"))
        return e.select(
            F.when(kind == -1, good)
            .when(kind == 0, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(",")))
            .when(kind == 1, F.to_json(F.struct("event_id", "user_id")))
            .when(kind == 2, F.to_json(F.struct("event_id", F.lit("abc").alias("user_id"), "event_type")))
            # empty, or white space of some kind
            .otherwise(F.element_at(F.array(*map(F.lit, ["", "\t", " \r\n", "\n"])), ((F.col("event_id") / 40).cast("int") % 4 + 1))).alias("value"))

    out = run(spark, job, messages)
    # one pass over the decode stage that both the rows and the rejects come from
    return out.checked.groupBy(F.coalesce("__reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


register("schema_drop_unknown", "SELECT CAST(event_id AS INTEGER) AS event_id, event_type FROM events")(
    _plain("events", {"event_id": "int", "user_id": "long", "event_type": "string", "value": "double"},
           "select * from source", out={"event_id": "int", "event_type": "string", "value": "double"},
           unknown_types="drop")
)


@register("project_output_schema", "SELECT event_id, upper(event_type) AS et FROM events")
def project_output_schema(spark, sf_dir):
    return events_job(spark, sf_dir, "select value, upper(event_type) as et, user_id, event_id, props from source",
                      {"event_id": "long", "et": "string"}).shaped


# --- encode (O2) -----------------------------------------------------------------------


def _get(path: str, cast: str | None = None):
    c = F.get_json_object("value", f"$.{path}")
    return (c.cast(cast) if cast else c).alias(path)


@register("encode_primitives",
          "SELECT event_id, event_type, CAST(user_id AS INTEGER) AS uid, value, "
          "CAST(CAST(value AS FLOAT) AS DOUBLE) AS vf, value > 50 AS big FROM events")
def encode_primitives(spark, sf_dir):
    out = events_job(spark, sf_dir,
                     "select event_id, event_type, cast(user_id as int) as uid, value, cast(value as float) as vf, "
                     "value > 50 as big from source",
                     {"event_id": "long", "event_type": "string", "uid": "int", "value": "double",
                      "vf": "float", "big": "boolean"})
    # one parse of each encoded message; the float is re-read from its text
    r = F.from_json("value", "event_id BIGINT, event_type STRING, uid INT, value DOUBLE, vf STRING, "
                             "big BOOLEAN").alias("r")
    return out.values.select(r).select("r.event_id", "r.event_type", "r.uid", "r.value",
                                       F.col("r.vf").cast("float").cast("double").alias("vf"), "r.big")


@register("encode_arrays",
          "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, "
          "array_to_string(list_sort(list(DISTINCT CAST(hour(ts) % 4 AS INTEGER))), ',') AS hours "
          "FROM events GROUP BY user_id")
def encode_arrays(spark, sf_dir):
    out = events_job(spark, sf_dir,
                     "select user_id, sort_array(collect_set(event_type)) as types, "
                     "sort_array(collect_set(cast(hour(to_timestamp(ts)) % 4 as int))) as hours "
                     "from source group by user_id",
                     {"user_id": "long", "types": "array<string>", "hours": "array<int>"})
    parsed = out.values.select(F.from_json("value", "user_id BIGINT, types ARRAY<STRING>, hours ARRAY<INT>").alias("r"))
    return parsed.select("r.user_id", F.array_join("r.types", ",").alias("types"),
                         F.array_join(F.transform("r.hours", lambda x: x.cast("string")), ",").alias("hours"))


@register("encode_fallback", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS d FROM events")
def encode_fallback(spark, sf_dir):
    out = events_job(spark, sf_dir, "select event_id, to_date(ts) as d from source",
                     {"event_id": "long", "d": "date"})
    return out.values.select(_get("event_id", "bigint"), _get("d"))


@register("encode_nulls",
          "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS t, "
          "event_type <> 'error' AS has_t, CASE WHEN event_type = 'click' THEN 0 ELSE CAST(user_id AS INTEGER) END AS u, "
          "CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS v, "
          "CASE WHEN event_type = 'purchase' THEN false ELSE value > 50 END AS b FROM events")
def encode_nulls(spark, sf_dir):
    out = events_job(spark, sf_dir,
                     "select event_id, case when event_type = 'error' then null else event_type end as t, "
                     "case when event_type = 'click' then null else cast(user_id as int) end as u, "
                     "case when event_type = 'view' then null else value end as v, "
                     "case when event_type = 'purchase' then null else value > 50 end as b from source",
                     {"event_id": "long", "t": "string", "u": "int", "v": "double", "b": "boolean"})
    r = F.from_json("value", "event_id BIGINT, t STRING, u INT, v DOUBLE, b BOOLEAN").alias("r")
    return out.values.select(r, (F.instr("value", '"t":') > 0).alias("has_t")).select(
        "r.event_id", "r.t", "has_t", "r.u", "r.v", "r.b")


# --- functions (F1-F6) -----------------------------------------------------------------

NULL_ERROR = "CASE WHEN event_type = 'error' THEN NULL ELSE event_type END"


@register("udf_suffix_test", "SELECT event_id, event_type || '_Test' AS t FROM events")
def udf_suffix_test(spark, sf_dir):
    return events_job(spark, sf_dir, "select event_id, MyUDF(event_type) as t from source",
                      {"event_id": "long", "t": "string"}).shaped


@register("udf_suffix_new",
          "SELECT event_id, CASE WHEN event_type = 'error' THEN 'null_new' ELSE event_type || '_new' END AS t "
          "FROM events")
def udf_suffix_new(spark, sf_dir):
    return events_job(spark, sf_dir, f"select event_id, m1({NULL_ERROR}) as t from source",
                      {"event_id": "long", "t": "string"}, [fn("m1", "suffix_new")]).shaped


@register("udf_two_args",
          "SELECT event_id, CASE WHEN event_type = 'error' THEN 'null' ELSE event_type END || '_' || "
          "CAST(user_id AS VARCHAR) AS t FROM events")
def udf_two_args(spark, sf_dir):
    return events_job(spark, sf_dir, f"select event_id, m2({NULL_ERROR}, user_id) as t from source",
                      {"event_id": "long", "t": "string"}, [fn("m2", "join2", "(String,String)")]).shaped


@register("udf_three_args",
          "SELECT event_id, event_type || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '_' || props AS t FROM events")
def udf_three_args(spark, sf_dir):
    return events_job(spark, sf_dir, "select event_id, m3(event_type, ts, props) as t from source",
                      {"event_id": "long", "t": "string"}, [fn("m3", "join3", "(String,String,String)")]).shaped


@register("udf_from_config",
          "SELECT event_id, event_type || '_new' AS a, event_type || '_' || CAST(user_id AS VARCHAR) AS b, "
          "reverse(event_type) AS c, event_type || '_Test' AS d FROM events")
def udf_from_config(spark, sf_dir):
    """Several functions from one config, SQL-bodied and Python ("()" counts as one argument)."""
    functions = [fn("m1", "suffix_new"), fn("m2", "join2", "(String,String)"),
                 fn("p1", "reverse_text", "()", "string")]
    return events_job(spark, sf_dir,
                      "select event_id, m1(event_type) as a, m2(event_type, user_id) as b, p1(event_type) as c, "
                      "MyUDF(event_type) as d from source",
                      {"event_id": "long", "a": "string", "b": "string", "c": "string", "d": "string"},
                      functions).shaped


@register("udf_python", "SELECT event_id, reverse(event_type) AS r FROM events")
def udf_python(spark, sf_dir):
    """User code in Python, run as an Arrow-batched pandas UDF."""
    return events_job(spark, sf_dir, "select event_id, p1(event_type) as r from source",
                      {"event_id": "long", "r": "string"}, [fn("p1", "reverse_text")]).shaped


@register("udf_multi_column",
          "SELECT event_id, substr(event_type, 1, 1) AS head, substr(event_type, 2) AS tail FROM events")
def udf_multi_column(spark, sf_dir):
    return events_job(spark, sf_dir, "select event_id, m.* from (select event_id, hs(event_type) as m from source)",
                      {"event_id": "long", "head": "string", "tail": "string"},
                      [fn("hs", "head_tail")]).shaped


_SPLIT_TYPE = "struct<head:string,tail:string,size:long>"


@register("udf_struct_python",
          "SELECT event_id, CASE WHEN event_type <> 'error' THEN substr(event_type, 1, 1) END AS head, "
          "CASE WHEN event_type <> 'error' THEN substr(event_type, 2) END AS tail, "
          "CASE WHEN event_type <> 'error' THEN length(event_type) END AS size, "
          "substr(event_type, 1, 1) AS row_head, length(event_type) AS row_size FROM events")
def udf_struct_python(spark, sf_dir):
    """Several columns from configured Python: Arrow batches (nulls included) and a row function."""
    functions = [fn("sp", "split_text", "(String)", _SPLIT_TYPE), fn("sr", "split_row", "(String)", _SPLIT_TYPE)]
    return events_job(spark, sf_dir,
                      f"select event_id, m.*, r.head as row_head, r.size as row_size from (select event_id, "
                      f"sp({NULL_ERROR}) as m, sr(event_type) as r from source)", "", functions).result


# --- lookups (F4, F5) ------------------------------------------------------------------

LOOKUP_KEY = "NATION_7"
_KV_ORACLE = ("(SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey "
              f"WHERE n_name = '{LOOKUP_KEY}')")


def _kv(session: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value reference data: nation name -> region name."""
    n = read_table(session, sf_dir, "nation")
    r = read_table(session, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("k"), F.col("r_name").alias("v"))


def _lookup_query(style: str) -> Query:
    def q(spark, sf_dir):
        job = SqlJob(
            spec_of(EVENT_SCHEMA, {"event_id": "long", "a": "string", "b": "string"},
                    "select event_id, m1(event_type) as a, m0(event_type) as b from source"),
            extra_functions={"m1": const_lookup("kv", "k", "v", LOOKUP_KEY, style),
                             "m0": const_lookup("kv", "k", "v", "k1", style)},
            reference_views={"kv": lambda s: _kv(s, sf_dir)},
        )
        return run(spark, job, lambda s: event_messages(s, sf_dir)).shaped

    return q


register("lookup_const_plus",
         f"SELECT event_id, event_type || '+' || {_KV_ORACLE} AS a, event_type || '+null' AS b FROM events")(
    _lookup_query("plus"))
register("lookup_const_pooled",
         f"SELECT event_id, event_type || '_' || {_KV_ORACLE} || '_new' AS a, event_type || '_null_new' AS b "
         "FROM events")(_lookup_query("pooled"))


@register("lookup_keyed",
          "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def lookup_keyed(spark, sf_dir):
    """Per-row key: customer messages joined to the nation table, stored and joined by size."""
    schema = {"c_custkey": "long", "c_name": "string", "c_nationkey": "int"}
    job = SqlJob(spec_of(json.dumps(schema), schema, "select * from source"))
    out = run(spark, job, lambda s: as_messages(read_table(s, sf_dir, "customer"), *schema))
    nation = read_table(out.source.sparkSession, sf_dir, "nation")
    return lookup_join(out.source, "c_nationkey", nation, "n_nationkey", ["n_name"]).select(
        "c_custkey", "c_name", "n_name")


class TableClient:
    """A key/value service in the worker's own process, for the checked query."""

    def __init__(self, data: dict):
        self.data = data

    def get(self, key):
        return self.data.get(key)


@register("lookup_service",
          "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_custkey % 10 <> 0")
def lookup_service(spark, sf_dir):
    """Per-row key, store behind a client: each distinct key is asked once, cluster-wide.
    The client's table is ``nation`` (25 rows); every tenth customer asks for a key it lacks."""
    schema = {"c_custkey": "long", "k": "string"}
    job = SqlJob(spec_of(json.dumps(schema), schema, "select * from source"))
    key = F.when(F.col("c_custkey") % 10 == 0, "none").otherwise(F.col("c_nationkey").cast("string")).alias("k")
    out = run(spark, job, lambda s: as_messages(read_table(s, sf_dir, "customer"), "c_custkey", key))
    names = {str(r.n_nationkey): r.n_name for r in read_table(spark, sf_dir, "nation").collect()}
    out.checked.persist(StorageLevel.MEMORY_AND_DISK)       # read for its keys, then joined
    return service_join(out.source, "k", partial(TableClient, names), "n_name").select("c_custkey", "n_name")


@register("lookup_duplicates",
          "SELECT s_suppkey, c.c_name, c.c_acctbal FROM supplier LEFT JOIN (SELECT c_nationkey, max(c_name) AS c_name, "
          "arg_max(c_acctbal, c_name) AS c_acctbal FROM customer GROUP BY c_nationkey) c ON s_nationkey = c_nationkey")
def lookup_duplicates(spark, sf_dir):
    """A lookup table with many rows per key and two value columns: one real row counts."""
    schema = {"s_suppkey": "long", "s_nationkey": "int"}
    job = SqlJob(spec_of(json.dumps(schema), schema, "select * from source"))
    out = run(spark, job, lambda s: as_messages(read_table(s, sf_dir, "supplier"), *schema))
    customers = read_table(out.source.sparkSession, sf_dir, "customer")
    return lookup_join(out.source, "s_nationkey", customers, "c_nationkey", ["c_name", "c_acctbal"]).select(
        "s_suppkey", "c_name", "c_acctbal")


@register("lookup_from_config",
          f"SELECT event_id, event_type || '_' || {_KV_ORACLE} || '_new' AS a, event_type || '_null_new' AS b FROM events")
def lookup_from_config(spark, sf_dir):
    """The pooled lookup named in the function config alone, options and all."""
    entry = lambda name, key: {
        "name": name, "mainClass": "relaysql.functions.lookup:const_lookup", "param": "(String)", "returnType": "string",
        "options": {"view": "kv", "key_col": "k", "value_col": "v", "key": key, "style": "pooled"}}
    return events_job(spark, sf_dir, "select event_id, m1(event_type) as a, m0(event_type) as b from source",
                      {"event_id": "long", "a": "string", "b": "string"}, [entry("m1", LOOKUP_KEY), entry("m0", "k1")],
                      reference_views={"kv": lambda s: _kv(s, sf_dir)}).shaped


@register("lookup_view_join",
          "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey "
          "JOIN region ON n_regionkey = r_regionkey")
def lookup_view_join(spark, sf_dir):
    """Reference tables as views beside ``source``; the SQL joins them."""
    schema = {"c_custkey": "long", "c_nationkey": "int"}
    job = SqlJob(
        spec_of(json.dumps(schema), {"c_custkey": "long", "n_name": "string", "r_name": "string"},
                "select c.c_custkey, n.n_name, r.r_name from source c join nation_ref n on c.c_nationkey = n.n_nationkey "
                "join region_ref r on n.n_regionkey = r.r_regionkey"),
        reference_views={"nation_ref": f"{sf_dir}/nation.parquet", "region_ref": f"{sf_dir}/region.parquet"},
    )
    return run(spark, job, lambda s: as_messages(read_table(s, sf_dir, "customer"), *schema)).shaped


# --- sources and sinks (S1-S3, K1, K2) -------------------------------------------------

TOPIC_ORACLE = "SELECT json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type)::VARCHAR AS value FROM events"


@register("topic_value_only", TOPIC_ORACLE)
def topic_value_only(spark, sf_dir):
    """Records shaped like a topic read (binary key/value and metadata) -> value text."""
    e = read_table(spark, sf_dir, "events")
    records = e.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "event_type")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    return value_only(records)


@register("publish_table_as_messages",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def publish_table_as_messages(spark, sf_dir):
    """K2: publish a table as messages to a topic (text twin), read them back."""
    folder = shared_path(spark, "topics", "orders")
    text_sink(folder).write(table_as_messages(
        read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")))
    back = text_source(folder).read(spark)
    return back.select(F.from_json("value", "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
                                            "o_totalprice DOUBLE").alias("r")).select("r.*")


@register("topic_dump", TOPIC_ORACLE)
def topic_dump(spark, sf_dir):
    """S3: everything in a topic from the beginning, as message text."""
    folder = shared_path(spark, "topics", "events")
    text_sink(folder).write(table_as_messages(read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")))
    return text_source(folder).read(spark)


def _stream_in_parts(spark: SparkSession, sf_dir: str, job: SqlJob, parts: int = 3) -> DataFrame:
    """Publish ``events`` messages in ``parts`` appends (``event_id % parts``); after
    each append run the stream with ``availableNow`` from its checkpoint, so each
    micro-batch holds exactly one part. Returns the sink's messages."""
    topic = shared_path(spark, "streams", "in")
    out = shared_path(spark, "streams", "out")
    checkpoint = shared_path(spark, "streams", "checkpoint")
    events = read_table(spark, sf_dir, "events")
    for i in range(parts):
        part = events.where(F.col("event_id") % parts == i)
        text_sink(topic).write(as_messages(part, *event_fields()))
        query = start_stream(job, spark, text_source(topic), text_sink(out), checkpoint=checkpoint,
                             available_now=True)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"stream failed: {query.exception()}")
    return text_source(out).read(spark)


@register("stream_sql_job", FLAGSHIP_ORACLE)
def stream_sql_job(spark, sf_dir):
    """The flagship job as a stream over a topic (text twin).

    All ``events`` messages are published at once; one ``availableNow`` run then
    cuts them into several micro-batches (``maxFilesPerTrigger``), each decoded,
    queried and published by ``foreachBatch``."""
    topic = shared_path(spark, "streams", "in")
    out = shared_path(spark, "streams", "out")
    text_sink(topic).write(as_messages(read_table(spark, sf_dir, "events"), *event_fields()))
    query = start_stream(flagship_job(), spark, text_source(topic, maxFilesPerTrigger=3), text_sink(out),
                         checkpoint=shared_path(spark, "streams", "checkpoint"), available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return text_source(out).read(spark).select("value")


@register("stream_batch_local_agg",
          "SELECT CAST(event_id % 3 AS INTEGER) AS part, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_batch_local_agg(spark, sf_dir):
    """An aggregate sees one micro-batch only; batch i holds ``event_id % 3 = i``."""
    job = SqlJob(spec_of('{"event_id":"long","event_type":"string"}',
                         {"part": "int", "event_type": "string", "n": "long"},
                         "select cast(min(event_id % 3) as int) as part, event_type, count(*) as n "
                         "from source group by event_type"))
    back = _stream_in_parts(spark, sf_dir, job)
    return back.select(F.from_json("value", "part INT, event_type STRING, n BIGINT").alias("r")).select("r.*")


# --- beyond one SQL statement (§2.7): band joins, kept sketches ------------------------------

BAND_WIDTH = 5.0


def _stored_events(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A job's result, stored: decoded once for what reads it several times."""
    result = events_job(spark, sf_dir, sql, "").result
    path = shared_path(spark, "events")
    result.write.parquet(path)
    return result.sparkSession.read.schema(result.schema).parquet(path)


@register("join_band",
          "SELECT a.event_id, a.value, b.event_id AS near_event_id, b.event_type AS near_event_type, b.value AS near_value "
          "FROM events a JOIN events b ON a.user_id = b.user_id AND CAST(a.ts AS DATE) = CAST(b.ts AS DATE) "
          f"AND abs(a.value - b.value) <= {BAND_WIDTH} WHERE a.event_type = 'purchase' AND b.event_type <> 'purchase'")
def join_band(spark, sf_dir):
    """Purchases with the user's other events of the day that are worth about as much."""
    events = _stored_events(spark, sf_dir, "select event_id, user_id, substr(ts, 1, 10) as day, event_type, value from source")
    pairs = band_join(events.where("event_type = 'purchase'"), events.where("event_type <> 'purchase'"),
                      "value", "value", BAND_WIDTH, ["user_id", "day"], right_prefix="near_")
    return pairs.select("event_id", "value", "near_event_id", "near_event_type", "near_value")


SKETCH_SHARES = {"p25": 0.25, "p50": 0.5, "p90": 0.9}


@register("sketch_rollup",
          "SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS users, true AS users_near, true AS p25_near, "
          "true AS p50_near, true AS p90_near FROM events GROUP BY event_type")
def sketch_rollup(spark, sf_dir):
    """Sketches kept per day and type, merged to types; each estimate against the exact figure."""
    events = _stored_events(spark, sf_dir, "select event_type, substr(ts, 1, 10) as day, user_id, value from source")
    path = shared_path(spark, "sketches")
    sketch(events, ["event_type", "day"], ["user_id"], ["value"]).write.parquet(path)
    kept = merge(events.sparkSession.read.parquet(path), ["event_type"])
    # one small row per type
    read = estimates(kept, SKETCH_SHARES).withColumnsRenamed({"event_type": "_type", "n_rows": "_kept"})
    ranks = [F.count_if(F.col("value") < F.col(f"value_{p}")).alias(f"{p}_below") for p in SKETCH_SHARES]
    ranks += [F.count_if(F.col("value") <= F.col(f"value_{p}")).alias(f"{p}_upto") for p in SKETCH_SHARES]
    exact = events.join(read, events.event_type.eqNullSafe(F.col("_type"))).groupBy("event_type").agg(
        F.max("_kept").alias("n_rows"), F.count_distinct("user_id").alias("users"), F.max("user_id_distinct").alias("_users"), *ranks)
    near = [((F.col(f"{p}_below") / F.col("n_rows") <= share + rank_bound()) & (F.col(f"{p}_upto") / F.col("n_rows") >= share - rank_bound())
             ).alias(f"{p}_near") for p, share in SKETCH_SHARES.items()]
    return exact.select("event_type", "n_rows", "users",
                        (F.abs(F.col("_users") - F.col("users")) <= F.col("users") * distinct_bound()).alias("users_near"), *near)


# --- SQL conformance (§2.7) ------------------------------------------------------------

for _name, (_spark_sql, _duck_sql) in CONFORMANCE.items():
    register(_name, with_source(_duck_sql or _spark_sql))(sql_output(_spark_sql))

