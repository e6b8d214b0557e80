"""Approximate aggregates that are kept and merged later.

``sketch`` makes one row per group with Spark's own sketches as binary columns:
HyperLogLog for distinct counts, KLL for quantiles. Such rows are small (some KB), are
stored like any table, and ``merge`` rolls them up to fewer keys without the rows they
came from: days into months, users into regions, yesterday's table with today's. Both are
partial before the shuffle, so a hot group is one small row per task.

``estimates`` reads them. Bounds: a distinct count is within ``distinct_bound(lg_k)``
of the exact one (three standard errors), a quantile's rank within
``rank_bound(k)`` of the one asked for (99 percent of the time, the library's figure).
Merging keeps these bounds.

Null values are not counted; a group without values has 0 distinct ones and null quantiles.
NaN is not a quantile value. Distinct values are compared as text where they are neither
integers, text nor binary. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12
KLL_K = 200

_HLL_TYPES = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def distinct_bound(lg_k: int = LG_K) -> float:
    """Relative error of a distinct count, three standard errors."""
    return 3 * 1.04 / (2 ** lg_k) ** 0.5


def rank_bound(k: int = KLL_K) -> float:
    """Error of a quantile's rank, as a share of the rows (double-sided, 99 percent)."""
    return 2.446 / k ** 0.9433


def sketch(df: DataFrame, keys: list[str], distinct: list[str] = (), quantiles: list[str] = (),
           lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """keys, ``n_rows``, ``<column>_hll`` for each of ``distinct``, ``<column>_kll`` for each of ``quantiles``."""
    aggs = [F.count("*").alias("n_rows")]
    for c in distinct:
        value = F.col(c) if isinstance(df.schema[c].dataType, _HLL_TYPES) else F.col(c).cast("string")
        aggs.append(F.hll_sketch_agg(value, F.lit(lg_k)).alias(f"{c}_hll"))
    aggs += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"{c}_kll") for c in quantiles]
    return df.groupBy(*keys).agg(*aggs)


def merge(sketches: DataFrame, keys: list[str], k: int = KLL_K) -> DataFrame:
    """Rows of :func:`sketch` (or of several, united) merged to ``keys``; the same columns."""
    aggs = [F.sum("n_rows").alias("n_rows")]
    for c in sketches.columns:
        if c in keys:
            continue
        if c.endswith("_hll"):
            aggs.append(F.hll_union_agg(c).alias(c))
        elif c.endswith("_kll"):
            aggs.append(F.kll_merge_agg_double(c, F.lit(k)).alias(c))
    return sketches.groupBy(*keys).agg(*aggs)


def estimates(sketches: DataFrame, probabilities: dict[str, float] | None = None) -> DataFrame:
    """The sketch columns read: ``<column>_distinct`` (long), and ``<column>_<name>`` (double) for
    each of ``probabilities`` (name to share, such as ``{"p50": 0.5}``); other columns as they are."""
    out: list[Column] = []
    for c in sketches.columns:
        if c.endswith("_hll"):
            out.append(F.hll_sketch_estimate(c).alias(c.removesuffix("_hll") + "_distinct"))
        elif c.endswith("_kll"):
            for name, p in (probabilities or {"p50": 0.5}).items():
                value = F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(p)))
                out.append(value.alias(f"{c.removesuffix('_kll')}_{name}"))
        else:
            out.append(F.col(c))
    return sketches.select(*out)
