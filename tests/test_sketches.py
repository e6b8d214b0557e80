from pyspark.sql import functions as F

from relaysql.operators.sketches import distinct_bound, estimates, merge, rank_bound, sketch


def test_merged_sketches_agree_with_one_pass(spark):
    n = 60_000
    df = spark.range(n).select((F.col("id") % 7).alias("day"), F.lit("a").alias("k"), (F.col("id") % 20_000).alias("u"),
                               F.col("id").cast("double").alias("v"))
    kept = sketch(df, ["k", "day"], ["u"], ["v"])
    shares = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    for got in (estimates(merge(kept, ["k"]), shares).collect(), estimates(sketch(df, ["k"], ["u"], ["v"]), shares).collect()):
        (r,) = got
        assert r.n_rows == n and abs(r.u_distinct - 20_000) <= 20_000 * distinct_bound()
        for name, p in shares.items():
            assert abs(r[f"v_{name}"] / n - p) <= rank_bound()


def test_small_groups_are_exact_and_merge_to_the_same(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 1, "y", 2.0), ("a", 2, "x", 3.0), ("b", 1, None, None),
                                (None, 1, "z", float("nan")), (None, 2, "z", 5.0)], "k string, day int, u string, v double")
    once = estimates(sketch(df, ["k"], ["u"], ["v"]))
    later = estimates(merge(sketch(df, ["k", "day"], ["u"], ["v"]), ["k"]))
    want = {("a", 3, 2, 2.0), ("b", 1, 0, None), (None, 2, 1, 5.0)}
    for got in (once, later):
        assert {(r.k, r.n_rows, r.u_distinct, r.v_p50) for r in got.collect()} == want
    assert sketch(df.where("day > 9"), ["k"], ["u"], ["v"]).count() == 0


def test_other_types_and_tables_united(spark):
    df = spark.sql("select 'a' as k, date'2024-01-01' + cast(id % 3 as int) as d, cast(id as decimal(9,2)) as m from range(9)")
    one = sketch(df, ["k"], ["d"], ["m"])
    both = estimates(merge(one.unionByName(one), ["k"]), {"low": 0.0, "top": 1.0})
    (r,) = both.collect()
    assert (r.n_rows, r.d_distinct, r.m_low, r.m_top) == (18, 3, 0.0, 8.0)


def test_sketches_are_partial_before_the_shuffle(spark):
    df = spark.range(1000, numPartitions=4).select(F.lit("a").alias("k"), "id")
    plan = sketch(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hll_sketch_agg") >= 2 and plan.count("Exchange hashpartitioning(k") <= 1


def test_count_distinct_spreads_a_hot_group_by_value(spark):
    """Spark's own plan meets a hot key: values are dealt by key *and* value before one partial row per task and key."""
    df = spark.range(1000, numPartitions=4).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("k"),
                                                   (F.col("id") * 7).alias("u"))
    plan = df.groupBy("k").agg(F.count_distinct("u"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "u#" in exchanges[1].split("hashpartitioning")[1].split("ENSURE")[0]
