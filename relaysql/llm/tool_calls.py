"""Operator 6: tool calls linked to their results.

``link_tool_calls`` takes chat messages (conv_id, turn, role, content, tool_calls,
tool_call_id): ``tool_calls`` is a JSON array of ``{"id", "function": {"name",
"arguments"}, "depends_on": [ids]}``, and a message with a ``tool_call_id`` is a
result. It hash-joins calls and results by conversation and identifier, orders
calls so that each stands after those it depends on, validates the arguments
against the tools' schemas and serialises each call with its result as canonical
JSON (sorted keys, no spaces). SQL functions and joins only.

Order: ``(level, turn, idx)``. Where all dependencies of a conversation point back,
the order of the messages is already topological and every level is 0. In the
others a call's level is the greatest number of dependencies on one path from it that
stand later in the conversation. Rounds settle calls whose dependencies are settled and
pass over calls with a single dependency, so chains and cycles take a logarithm of their
length in rounds, and a mesh its depth; no number of rounds is set. A call in a cycle, or
behind one, gets status ``cycle`` and no level.
No conversation is gathered in one place, however many turns it has.

Defined results: a call without an id or a name has status ``malformed``; of calls
with one id in a conversation the first counts, others are ``duplicate``; of
results with one id the first counts, ``n_results`` tells how many there were; a
result without a call is ``orphan`` (its call fields are null). Unknown
dependencies are errors and otherwise ignored. Arguments that are no JSON object
(null, malformed, a key twice) are an error and serialised as null. Tool calls that
are no JSON array are skipped. A null conversation is a conversation of its own.
Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import release, table, written

CALLS = "array<struct<id:string,function:struct<name:string,arguments:string>,depends_on:array<string>>>"

# The production tools. name, parameter, type, required.
TOOLS = [
    ("search", "text", "string", True), ("search", "limit", "integer", True), ("search", "options", "object", False),
    ("search", "conv", "integer", False),
    ("translate", "text", "string", True), ("translate", "limit", "integer", False), ("translate", "conv", "integer", True),
    ("translate", "options", "object", False),
    ("summarize", "text", "string", True), ("summarize", "limit", "number", True), ("summarize", "options", "object", True),
    ("summarize", "conv", "integer", False),
]


def json_type(value: Column) -> Column:
    """JSON Schema's name of a variant's type."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "VOID", "null").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
            .when(kind == "BIGINT", "integer").when(kind.startswith("OBJECT"), "object")
            .when(kind.startswith("ARRAY"), "array").otherwise("number"))


def _messages(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv_key"),
        F.col("turn").cast("bigint").alias("turn"), F.col("content").cast("string").alias("content"),
        F.col("tool_calls").cast("string").alias("tool_calls"), F.col("tool_call_id").cast("string").alias("tool_call_id"))


def _levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_key, call_id, level (null: in or behind a cycle) of the calls in conversations
    with a dependency that does not point back; ``edges``: conv_key, call_id, dep, forward."""
    tangled = edges.where("forward").groupBy("conv_key").agg(F.count("*").alias("n_forward"))
    own = written(edges.join(tangled, "conv_key").select("conv_key", "call_id", "dep", "forward", "n_forward"), "calls-edges")
    if own.isEmpty():
        return calls.select("conv_key", "call_id", F.lit(0).cast("bigint").alias("level")).limit(0)
    # a node's level is the greatest of its base and, over its edges, weight + level of the target
    key = ["conv_key", "call_id"]
    base = written(own.select(*key, "n_forward").unionByName(own.select("conv_key", F.col("dep").alias("call_id"), "n_forward")).distinct().withColumn(
        "base", F.lit(0).cast("bigint")), "calls-base")
    left = written(own.select(*key, "dep", "n_forward", F.col("forward").cast("bigint").alias("w")), "calls-left")
    release(own)
    while True:
        ahead = base.join(left.groupBy(*key).agg(F.count("*").alias("n_out"), F.min("dep").alias("next"), F.min("w").alias("step")), key, "left").select(
            "conv_key", F.col("call_id").alias("dep"), F.col("base").alias("below"), "n_out", "next", "step")
        # a target without edges is settled, one with a single edge is passed over: chains and cycles double their steps
        settled, sole = F.col("n_out").isNull(), F.coalesce(F.col("n_out") == 1, F.lit(False))
        moved = written(left.join(ahead, ["conv_key", "dep"]).select(
            *key, "n_forward", F.when(sole, F.col("next")).when(~settled, F.col("dep")).alias("dep"),
            F.least(F.col("n_forward") + 1, F.col("w") + F.when(sole, F.col("step")).otherwise(0)).alias("w"),
            F.when(settled | sole, F.col("w") + F.col("below")).otherwise(0).alias("least"), (settled | sole).alias("changed")), "calls-round")
        if moved.where("changed").isEmpty():
            break
        # no path without a cycle passes more forward dependencies than there are
        raised = moved.groupBy(*key).agg(F.max(F.greatest("least", F.when(F.col("dep").isNotNull() & (F.col("w") > F.col("n_forward")), F.col("w")))).alias("least"))
        higher = written(base.join(raised, key, "left").select(
            *key, "n_forward", F.least(F.col("n_forward") + 1, F.greatest("base", "least")).alias("base")), "calls-base")
        rest = moved.where("dep is not null").join(higher.where("base > n_forward").select(*key), key, "left_anti")
        rest = written(rest.groupBy(*key, "dep", "n_forward").agg(F.max("w").alias("w")), "calls-left")
        release(base, left, moved)
        base, left = higher, rest
    # what still has edges leads to others that have: into a cycle
    stuck = left.select(*key).distinct().withColumn("stuck", F.lit(True))
    return base.join(stuck, key, "left").select(
        *key, F.when((F.col("base") <= F.col("n_forward")) & F.col("stuck").isNull(), F.col("base")).alias("level"))


def link_tool_calls(messages: DataFrame, tools: DataFrame) -> DataFrame:
    """``tools``: name, param, type, required. One row per call, and per result without
    one: conv_id, call_id, turn, idx, name, status, level, valid, errors, arguments,
    result_turn, n_results, result, record."""
    m = _messages(messages)
    raw = m.where("tool_calls is not null").select(
        "conv_id", "conv_key", "turn", F.posexplode(F.from_json("tool_calls", CALLS)).alias("idx", "c")).select(
        "conv_id", "conv_key", "turn", "idx", F.col("c.id").alias("call_id"), F.col("c.function.name").alias("name"),
        F.col("c.function.arguments").alias("raw_arguments"), F.coalesce("c.depends_on", F.array().cast("array<string>")).alias("depends_on"))
    at = F.struct(F.col("turn"), F.col("idx"))
    calls = written(raw, "calls")
    good = F.col("call_id").isNotNull() & (F.col("call_id") != "") & F.col("name").isNotNull() & (F.col("name") != "")
    firsts = written(calls.where(good).groupBy("conv_key", "call_id").agg(F.min(at).alias("first")), "calls-first")

    # dependencies between calls that exist
    wanted = calls.where(good).join(firsts, ["conv_key", "call_id"]).where(at == F.col("first")).select(
        "conv_key", "call_id", "first", F.explode(F.array_distinct("depends_on")).alias("dep"))
    deps = wanted.join(firsts.select("conv_key", F.col("call_id").alias("dep"), F.col("first").alias("dep_at")), ["conv_key", "dep"], "left")
    deps = written(deps.select("conv_key", "call_id", "dep", F.col("dep_at").isNull().alias("unknown"),
                               F.coalesce(F.col("dep_at") >= F.col("first"), F.lit(False)).alias("forward")), "calls-deps")
    level = _levels(firsts, deps.where("not unknown")).withColumnRenamed("level", "raised").withColumn("in_tangle", F.lit(True))

    # arguments against schemas: one row per argument, joined to the parameters by name
    parsed = calls.withColumn("v", F.try_parse_json("raw_arguments")).withColumn(
        "is_object", F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
    key = ["conv_key", "turn", "idx"]
    given = parsed.where("is_object").select(*key, "name", "v")
    pieces = given.lateralJoin(given.sparkSession.tvf.variant_explode(F.col("v").outer()).select(F.col("key").alias("param"), "value"))
    pieces = pieces.select(*key, "name", "param", json_type(F.col("value")).alias("kind"))
    known = tools.select(F.col("name").alias("t_name"), F.col("param").alias("t_param"), F.col("type").alias("t_type")).distinct()
    judged = pieces.join(known, (F.col("name") == F.col("t_name")) & (F.col("param") == F.col("t_param")), "left")
    fits = (F.col("kind") == F.col("t_type")) | ((F.col("t_type") == "number") & (F.col("kind") == "integer"))
    wrong = judged.select(*key, F.when(F.col("t_type").isNull(), F.concat(F.lit("unknown parameter "), "param")).when(
        ~fits, F.concat(F.lit("wrong type of "), "param")).alias("error"), F.col("param"))
    need = tools.groupBy("name").agg(F.array_sort(F.collect_set(F.when(F.col("required"), F.col("param")))).alias("needed"),
                                     F.lit(True).alias("known_tool"))        # bounded by the tools' parameters
    per_call = wrong.groupBy(*key).agg(F.collect_list("error").alias("wrong"), F.collect_set("param").alias("present"))

    unknown = deps.where("unknown").groupBy("conv_key", "call_id").agg(F.collect_list("dep").alias("missing"))
    results = m.where("tool_call_id is not null").groupBy("conv_id", "conv_key", F.col("tool_call_id").alias("call_id")).agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("n_results"))

    none = F.array().cast("array<string>")
    table_ = parsed.join(need, "name", "left").join(per_call, key, "left").join(firsts, ["conv_key", "call_id"], "left").join(
        level, ["conv_key", "call_id"], "left").join(unknown, ["conv_key", "call_id"], "left")
    state = (F.when(~F.coalesce(good, F.lit(False)), "malformed").when(F.col("first") != at, "duplicate")
             .when(F.coalesce("in_tangle", F.lit(False)) & F.col("raised").isNull(), "cycle"))
    absent = F.transform(F.array_except(F.coalesce("needed", none), F.coalesce("present", none)), lambda p: F.concat(F.lit("missing parameter "), p))
    errors = F.array_sort(F.concat(
        F.when(F.col("is_object"), F.coalesce("wrong", none)).otherwise(F.array(F.lit("arguments are not an object"))),
        F.when(F.col("is_object"), absent).otherwise(none),
        F.when(F.coalesce("known_tool", F.lit(False)), none).otherwise(F.array(F.lit("unknown tool"))),
        F.transform(F.coalesce("missing", none), lambda d: F.concat(F.lit("unknown dependency "), d))))
    checked = table_.select(
        "conv_id", "conv_key", "call_id", "turn", "idx", "name", state.alias("state"),
        F.when(state.isNull(), F.coalesce("raised", F.lit(0).cast("bigint"))).alias("level"), errors.alias("errors"),
        F.when(F.col("is_object"), F.to_json("v")).alias("arguments"))
    # only calls in their own right take a result
    takes = F.when(F.coalesce(F.col("state"), F.lit("cycle")) == "cycle", F.col("call_id")).alias("link_id")
    r = results.select(F.col("conv_id").alias("r_conv"), F.col("conv_key").alias("r_key"), F.col("call_id").alias("r_id"), "result", "n_results")
    linked = checked.select("*", takes).join(r, (F.col("conv_key") == F.col("r_key")) & (F.col("link_id") == F.col("r_id")), "full_outer")
    status = F.when(F.col("conv_key").isNull(), "orphan").when(F.col("state").isNotNull(), F.col("state")).when(
        F.col("r_id").isNull(), "unanswered").otherwise("linked")
    out = linked.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"), F.coalesce("call_id", "r_id").alias("call_id"), "turn",
        F.col("idx").cast("bigint").alias("idx"), "name", status.alias("status"), "level",
        F.when(F.col("conv_key").isNotNull(), F.size("errors") == 0).alias("valid"), "errors", "arguments",
        F.col("result.turn").alias("result_turn"), F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        F.col("result.content").alias("result"))
    text = lambda c: F.coalesce(F.to_json(F.col(c).try_cast("string").cast("variant")), F.lit("null"))
    record = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), text("call_id"),
        F.lit(',"name":'), text("name"), F.lit(',"result":'), text("result"), F.lit("}"))
    return out.withColumn("record", record)


def messages_from_conversations(conversations: DataFrame) -> DataFrame:
    """Tool-call messages made from plain conversations: each user turn becomes a call,
    each assistant turn the result of the turn before it. Some calls break their schema,
    depend on calls that come later, or stay unanswered, as the texts and ids have it."""
    call_id = lambda t: F.concat_ws("_", F.lit("call"), F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), t.cast("string"))
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.length(text)
    name = F.element_at(F.array(F.lit("search"), F.lit("translate"), F.lit("summarize")), (F.pmod(F.length(text), F.lit(3)) + 1).cast("int"))
    limit = F.when(n % 5 == 0, F.to_json(F.struct(n.cast("string").alias("limit")))).otherwise(F.to_json(F.struct(n.alias("limit"))))
    arguments = F.concat(
        F.lit("{ "), F.when(n >= 40, F.concat(F.regexp_replace(F.to_json(F.struct(text.alias("text"))), r"^\{|\}$", ""), F.lit(" ,\n "))).otherwise(""),
        F.lit('"options" : {"z": '), F.col("turn").cast("string"), F.lit(', "a": true}, '),
        F.regexp_replace(limit, r"^\{|\}$", ""), F.lit(', "conv": '), F.col("conv_id").cast("string"), F.lit(" }"))
    ahead = F.pmod(F.col("conv_id"), F.lit(10)) == 0
    deps = F.when(ahead & (F.col("turn") <= 1), F.array(call_id(F.col("turn") + 2))).when(
        (F.col("turn") >= 2) & ~(ahead & (F.col("turn") <= 3)), F.array(call_id(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    call = F.to_json(F.array(F.struct(call_id(F.col("turn")).alias("id"), F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"),
                                      deps.alias("depends_on"))))
    return conversations.select(
        "conv_id", "turn", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", F.lit(None)).otherwise(F.col("text")).alias("content"),
        F.when(F.col("role") == "user", call).alias("tool_calls"),
        F.when(F.col("role") == "assistant", call_id(F.col("turn") - 1)).alias("tool_call_id"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    linked = link_tool_calls(messages_from_conversations(table(spark, sf_dir, "conversations")), tools)
    return linked.select("conv_id", "call_id", "turn", "name", "status", "level", "valid", F.array_join("errors", "; ").alias("errors"),
                         "result_turn", "n_results", F.sha2("record", 256).alias("record_sha256"))


ORACLE = """
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t, text FROM conversations),
calls AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, t, length(t) AS n,
         ['search', 'translate', 'summarize'][length(t) % 3 + 1] AS name, conv_id % 10 = 0 AS ahead
  FROM c WHERE role = 'user'),
results AS (
  SELECT conv_id, 'call_' || conv_id || '_' || (turn - 1) AS call_id, min(turn) AS result_turn, min(text) AS result, count(*) AS n_results
  FROM c WHERE role = 'assistant' GROUP BY 1, 2),
dep AS (
  SELECT *, CASE WHEN ahead AND turn <= 1 THEN 'call_' || conv_id || '_' || (turn + 2)
                 WHEN turn >= 2 AND NOT (ahead AND turn <= 3) THEN 'call_' || conv_id || '_' || (turn - 2) END AS needs FROM calls),
lvl AS (
  SELECT d.*, d.needs IS NOT NULL AND o.call_id IS NULL AS unknown,
         CASE WHEN o.turn > d.turn THEN 1 ELSE 0 END AS level
  FROM dep d LEFT JOIN calls o ON o.conv_id = d.conv_id AND o.call_id = d.needs),
e AS (
  SELECT *, list_sort([x FOR x IN [
    CASE WHEN n < 40 THEN 'missing parameter text' END,
    CASE WHEN n % 5 = 0 THEN 'wrong type of limit' END,
    CASE WHEN unknown THEN 'unknown dependency ' || needs END] IF x IS NOT NULL]) AS errors,
    '{"conv":' || conv_id || ',"limit":' || CASE WHEN n % 5 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END
      || ',"options":{"a":true,"z":' || turn || '}' || CASE WHEN n >= 40 THEN ',"text":' || CAST(to_json(t) AS VARCHAR) ELSE '' END || '}' AS arguments
  FROM lvl),
j AS (
  SELECT coalesce(e.conv_id, r.conv_id) AS conv_id, coalesce(e.call_id, r.call_id) AS call_id, e.turn, e.name, e.level, e.errors, e.arguments,
         r.result_turn, coalesce(r.n_results, 0) AS n_results, r.result, e.call_id IS NULL AS orphan, r.call_id IS NULL AS unanswered
  FROM e FULL OUTER JOIN results r ON e.conv_id = r.conv_id AND e.call_id = r.call_id)
SELECT conv_id, call_id, turn, name, CASE WHEN orphan THEN 'orphan' WHEN unanswered THEN 'unanswered' ELSE 'linked' END AS status,
       CAST(level AS BIGINT) AS level, CASE WHEN NOT orphan THEN len(errors) = 0 END AS valid, CASE WHEN NOT orphan THEN array_to_string(errors, '; ') END AS errors,
       result_turn, n_results,
       sha256('{"arguments":' || coalesce(arguments, 'null') || ',"id":' || CAST(to_json(call_id) AS VARCHAR) || ',"name":' || coalesce(CAST(to_json(name) AS VARCHAR), 'null')
              || ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null') || '}') AS record_sha256
FROM j
"""
