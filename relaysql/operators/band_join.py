"""Band join of two large sides: pairs with equal keys and ``|left - right| <= width``.

Spark plans a non-equi condition on top of equal keys as one comparison of every pair
within a key, and without keys as a nested loop. Here values are cut into bins of twice
the width: a left row stands in its own bin, a right row in the one or two bins that its
band reaches, so bins meet by an ordinary equi-join and the comparison sees neighbours
only. Each pair meets in exactly one bin, that of its left row.

A bin that holds many rows of one key (``CELL_ROWS`` on a side) is a grid: left rows are
dealt over ``pl`` parts and copied to ``pr``, right rows the other way round, so a cell
holds about ``CELL_ROWS`` of either side however hot the bin is, and pairs still meet once.
Rows are counted per key and bin before (pre-aggregated); only bins in need of a grid are
kept, stored under the shared folder, so that the join knows their size: at most one per
``CELL_ROWS`` rows. Rows are dealt by a hash of all their columns, which
survives a lost executor; rows equal in every column share a part, and where those alone
are too many, AQE splits the partition.

Null keys, null and NaN values match nothing. Infinite values match nothing either (a
difference of infinities is NaN or infinite). Repeated rows each give their pairs. Empty sides give
an empty result. Right columns come out with ``right_prefix``; a name that both sides then
have is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaysql.session import shared_path

CELL_ROWS = 4096
# Bins are computed in doubles: below FAR bins from zero a bin is off by less than SLACK.
# Values beyond share one bin on each side, split like any hot one.
FAR = 2.0 ** 40
SLACK = 2.0 ** -10


def band_join(left: DataFrame, right: DataFrame, left_value: str, right_value: str, width: float,
              keys: list[str] | tuple[str, ...] = (), right_prefix: str = "r_", cell_rows: int = CELL_ROWS) -> DataFrame:
    """Inner join of ``left`` and ``right`` on equal ``keys`` and values at most ``width`` apart.

    ``left`` and ``right`` are read twice (counted, then joined); store a dear one first."""
    if not width > 0:
        raise ValueError("width must be positive; equal values are an equi-join")
    renamed = [right_prefix + c for c in right.columns]
    if clash := set(left.columns) & set(renamed):
        raise ValueError(f"both sides have {sorted(clash)}; choose another right_prefix")

    def binned(value: Column, shift: float = 0.0) -> Column:
        at = F.floor(value.cast("double") / F.lit(2.0 * width) + F.lit(shift))
        return at.cast("bigint")

    def clamped(value: Column) -> Column:
        q = 2.0 * width * FAR
        return F.greatest(F.least(value.cast("double"), F.lit(q)), F.lit(-q))

    on = [f"_k{i}" for i in range(len(keys))]

    def packed(df: DataFrame, name: str, value: str) -> DataFrame:
        rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name),
                         *(F.col(f"`{k}`").alias(o) for k, o in zip(keys, on)), F.col(f"`{value}`").alias(f"{name}_value"))
        known = ~F.isnan(F.col(f"{name}_value").cast("double"))       # false or null for what matches nothing
        for o in on:
            known = known & F.col(o).isNotNull()
        return rows.where(known)

    half = 0.5 + SLACK
    l_rows, r_rows = packed(left, "_l", left_value), packed(right, "_r", right_value)
    l_bins = l_rows.withColumn("_bin", binned(clamped(F.col("_l_value"))))
    r_bins = r_rows.withColumn("_bin", F.explode(F.sequence(
        binned(clamped(F.col("_r_value")), -half), binned(clamped(F.col("_r_value")), half))))
    cell = [*on, "_bin"]
    counts = l_bins.groupBy(*cell).agg(F.count("*").alias("_nl")).join(
        r_bins.groupBy(*cell).agg(F.count("*").alias("_nr")), cell)
    grids = counts.select(*cell, F.ceil(F.col("_nl") / cell_rows).cast("int").alias("_pl"),
                          F.ceil(F.col("_nr") / cell_rows).cast("int").alias("_pr")).where("_pl > 1 OR _pr > 1")
    path = shared_path(left.sparkSession, "band-grids")
    grids.write.parquet(path)
    grids = left.sparkSession.read.schema(grids.schema).parquet(path)

    def part(row: str, parts: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(row), F.col(parts)).cast("int"), F.lit(0))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))

    l_cells = l_bins.join(grids, cell, "left").withColumn("_i", part("_l", "_pl")).withColumn("_j", every("_pr"))
    r_cells = r_bins.join(grids, cell, "left").withColumn("_j", part("_r", "_pr")).withColumn("_i", every("_pl"))
    pairs = l_cells.drop("_pl", "_pr").join(r_cells.drop("_pl", "_pr"), [*cell, "_i", "_j"])
    near = pairs.where(F.abs(F.col("_l_value") - F.col("_r_value")) <= F.lit(width))
    return near.select("_l.*", *(F.col(f"_r.`{c}`").alias(n) for c, n in zip(right.columns, renamed)))
