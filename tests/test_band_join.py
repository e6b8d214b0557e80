import random

import pytest
from pyspark.sql import functions as F

from relaysql.operators.band_join import band_join


def brute(left, right, width, keyed=True):
    return sorted((a[0], b[0]) for a in left for b in right
                  if (not keyed or (a[1] is not None and a[1] == b[1])) and a[2] is not None and b[2] is not None
                  and abs(a[2] - b[2]) <= width)


def ids(df):
    return sorted((r.id, r.r_id) for r in df.collect())


SCHEMA = "id int, k string, v double"


@pytest.mark.parametrize("width,cell_rows", [(0.5, 4096), (0.1, 3), (7.0, 2), (1e-9, 4096)])
def test_band_join_equals_brute_force(spark, width, cell_rows):
    rng = random.Random(5)
    edge = [0.0, -0.0, width, -width, 2 * width, 3 * width, 1e15, 1e15 + width, 1e300, -1e300]
    value = lambda: rng.choice(edge) if rng.random() < 0.3 else round(rng.uniform(-5, 5), 1)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), None if rng.random() < 0.05 else value()) for i in range(160)]
    left, right = rows[:80], rows[80:]
    got = band_join(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "v", "v", width, ["k"],
                    cell_rows=cell_rows)
    assert ids(got) == brute(left, right, width)


def test_band_join_without_keys_repeated_rows_and_types(spark):
    left = [(1, "x", 1.0), (1, "x", 1.0), (2, None, 3.0)]
    right = [(7, "y", 1.5), (8, "y", 2.4)]
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    got = band_join(make(left), make(right), "v", "v", 0.7)
    assert ids(got) == brute(left, right, 0.7, keyed=False) and len(ids(got)) == 3
    whole = band_join(make(left).withColumn("v", F.col("v").cast("long")), make(right).withColumn("v", F.col("v").cast("long")),
                      "v", "v", 1)
    assert ids(whole) == [(1, 7), (1, 7), (1, 8), (1, 8), (2, 8)]
    special = make([(1, "x", float("nan")), (2, "x", float("inf")), (3, "x", None)])
    assert ids(band_join(special, special, "v", "v", 1.0, ["k"])) == []
    empty = make([]).where("id > 0")
    assert ids(band_join(empty, make(right), "v", "v", 1.0)) == ids(band_join(make(left), empty, "v", "v", 1.0)) == []


def test_band_join_arguments(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="width"):
        band_join(df, df, "v", "v", 0)
    with pytest.raises(ValueError, match="right_prefix"):
        band_join(df, df, "v", "v", 1, right_prefix="")
    odd = df.withColumnsRenamed({"id": "_bin", "k": "_l"})
    assert [tuple(r) for r in band_join(odd, odd, "v", "v", 1, ["_l"]).collect()] == [(1, "a", 1.0, 1, "a", 1.0)]


def test_band_join_compares_neighbours_and_splits_hot_bins(spark):
    """One key; half of each side stands at one value. No nested loop, and no task holds the hot bin."""
    n, conf = 4000, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.shuffle.partitions": "16"}
    df = spark.range(n).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("k"),
                               F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id") * 10.0).alias("v"))
    old = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        pairs = band_join(df, df, "v", "v", 1.0, ["k"], cell_rows=100)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(per_task) == (n // 2) ** 2 + n // 2          # odd rows meet themselves only
    assert max(per_task) < sum(per_task) / 5
