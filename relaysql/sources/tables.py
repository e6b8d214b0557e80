"""Driver tables as message streams.

The checked queries feed jobs with JSON messages made from the parquet tables
(``to_json(struct(...)) AS value``), the way a producer would publish rows. The
builders here are plain projections over the scan, so they are map-only and
Catalyst prunes the parquet read to the columns a message uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_table(session: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_messages(df: DataFrame, *fields: Column | str) -> DataFrame:
    """One JSON object text per row, made from ``fields``, in column ``value``.

    Like a producer writing to a topic with many partitions, the rows are first
    spread over the task slots when the table arrives in fewer partitions (the
    driver tables are single parquet row groups); a table that is already split
    is serialised where it lies.
    """
    from relaysql.plans.job import spread

    return spread(df).select(F.to_json(F.struct(*fields)).alias("value"))


def event_fields() -> list[Column]:
    """The ``events`` message: every column, ``ts`` as text, plus a tag list."""
    return [
        F.col("event_id"),
        F.date_format("ts", TS_FORMAT).alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
        F.array(
            F.col("event_type"),
            F.substring("event_type", 1, 1),
            (F.col("user_id") % 5).cast("string"),
        ).alias("tags"),
    ]


def event_messages(session: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(read_table(session, sf_dir, "events"), *event_fields())


# Input schema of the ``events`` message (declaration order = column order).
EVENT_SCHEMA = (
    '{"event_id":"long","ts":"string","user_id":"long","event_type":"string",'
    '"value":"double","props":"string","tags":"array<string>"}'
)

# The same table in DuckDB terms, for oracles: ``WITH source AS (...)``.
EVENT_SOURCE_SQL = (
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props, "
    "[event_type, substr(event_type, 1, 1), CAST(user_id % 5 AS VARCHAR)] AS tags FROM events"
)
