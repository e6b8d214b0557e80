"""Lookups from SQL: the value of a key in reference data.

The sample functions look up one fixed key in an external store for every row
and append the value to their argument. Per-row network calls do not scale, so
the lookup is re-expressed four ways:

* :func:`const_lookup` - the store is a table or view (key column, value
  column). The function is SQL-bodied with a scalar subquery, which Spark runs
  once per query and folds in as a constant; no join, no per-row work.
* :func:`lookup_join` - the key comes from each row. A left join to the lookup
  table reduced to one row per key: lazily, with a broadcast, where the table's size
  by its plan statistics is below the broadcast threshold; else to a stored snapshot
  (:func:`lookup_snapshot`, which jobs can make once and reuse), where AQE splits hot
  keys of the join.
* :func:`service_join` - the key comes from each row and the store is a service. The
  distinct keys of all rows are asked once each, cluster-wide, by a bounded number of
  tasks with one call in flight; the answers are stored and joined back.
* :func:`service_lookup` - the store is a service reachable only through a
  client. An iterator pandas UDF keeps one client per Python worker and asks it
  once per distinct key of each Arrow batch.

A missing key gives the text ``null`` in the result, as JVM string
concatenation would.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaysql.functions.library import SqlFunction, jvm_text
from relaysql.session import shared_path, ship_package

# Fixed value: the key the sample lookup functions read.
DEFAULT_KEY = "k1"


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value_sql(view: str, key_col: str, value_col: str, key: str) -> str:
    return (
        f"(SELECT max({_ident(value_col)}) FROM {_ident(view)} "
        f"WHERE {_ident(key_col)} = {_sql_str(key)})"
    )


def const_lookup(view: str, key_col: str, value_col: str, key: str = DEFAULT_KEY,
                 style: str = "plus") -> SqlFunction:
    """One-argument function appending the value of ``key`` from ``view``.

    ``style="plus"`` gives ``t1 + "+" + v`` (F4, a new connection per row in the
    original); ``style="pooled"`` gives ``t1 + "_" + v + "_new"`` (F5).
    """
    v = _value_sql(view, key_col, value_col, key)
    if style == "plus":
        body = f"concat({jvm_text('t1')}, '+', {jvm_text(v)})"
    elif style == "pooled":
        body = f"concat({jvm_text('t1')}, '_', {jvm_text(v)}, '_new')"
    else:
        raise ValueError("style must be 'plus' or 'pooled'")
    return SqlFunction((("t1", "STRING"),), "STRING", body)


@dataclass(frozen=True)
class Snapshot:
    """A lookup table reduced to one row per key (column ``__lookup_key``) and stored
    under the shared folder, for any number of joins; ``release`` removes it."""

    table: DataFrame
    path: str

    def release(self) -> None:
        spark = self.table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _stored(df: DataFrame) -> Snapshot:
    path = shared_path(df.sparkSession, "lookup")
    df.write.parquet(path)
    return Snapshot(df.sparkSession.read.parquet(path), path)


def _reduced(table: DataFrame, table_key: str, value_cols: list[str]) -> DataFrame:
    values = F.struct(*[F.col(c) for c in value_cols])
    return table.where(F.col(table_key).isNotNull()).groupBy(F.col(table_key).alias("__lookup_key")).agg(
        F.max(values).alias("v")).select("__lookup_key", "v.*")


def lookup_snapshot(table: DataFrame, table_key: str, value_cols: list[str]) -> Snapshot:
    """``table`` reduced to one row per key, as :func:`lookup_join` does, and stored."""
    return _stored(_reduced(table, table_key, value_cols))


def _broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def lookup_join(df: DataFrame, key: str, table: DataFrame | Snapshot, table_key: str | None = None,
                value_cols: list[str] | None = None) -> DataFrame:
    """Left-join ``value_cols`` of ``table`` to ``df`` on ``df[key] == table[table_key]``.

    Of several rows with one key the greatest counts, compared column by column, so
    values always come from one real row and the join never multiplies rows. A table
    whose plan statistics lie below the broadcast threshold is reduced and broadcast
    when the join runs, and nothing is written. A larger one is stored first, so that its
    reduced size is known when the join is planned; as both sides are plain scans, AQE
    can split a hot key. A :class:`Snapshot` is joined as it is.
    """
    if isinstance(table, Snapshot):
        stored = table.table
    else:
        reduced = _reduced(table, table_key, value_cols)
        size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        stored = F.broadcast(reduced) if size <= _broadcast_limit(df.sparkSession) else _stored(reduced).table
    return df.join(stored, df[key] == stored["__lookup_key"], "left").drop("__lookup_key")


def service_answers(df: DataFrame, key: str, client_factory: Callable[[], object], value_col: str = "value",
                    max_in_flight: int = 64) -> Snapshot:
    """``client.get(k)`` (text) for every distinct key of ``df[key]`` but null, stored.

    Keys meet in one row each before anyone is asked, so the service hears of a key once,
    however many rows and partitions have it; at most ``max_in_flight`` tasks ask, one call
    at a time. The answers are stored when this returns: later jobs and retries of them do
    not ask again (a task lost with its executor asks its keys anew).
    """
    if max_in_flight < 1:
        raise ValueError("max_in_flight must be at least 1")
    ship_package(df.sparkSession)
    identity = hashlib.sha256(cloudpickle.dumps(client_factory)).hexdigest()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = _client(identity, client_factory)
        for batch in batches:
            answers = [client.get(k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if a is None else str(a) for a in answers], pa.string())], names=["__lookup_key", value_col])

    keys = df.select(F.col(key).alias("__lookup_key")).where("__lookup_key is not null").distinct().repartition(max_in_flight)
    schema = T.StructType([keys.schema["__lookup_key"], T.StructField(value_col, T.StringType())])
    return _stored(keys.mapInArrow(ask, schema))


def service_join(df: DataFrame, key: str, client_factory: Callable[[], object], value_col: str = "value",
                 max_in_flight: int = 64) -> DataFrame:
    """``df`` with the service's answer to each row's key in ``value_col`` (null where the key
    is null or unknown); see :func:`service_answers`. ``df`` is read twice, once for its
    keys: pass a decoded batch that is shared, or a table."""
    return lookup_join(df, key, service_answers(df, key, client_factory, value_col, max_in_flight))


_CLIENTS: dict[str, object] = {}


def _client(identity: str, factory: Callable[[], object]):
    """One client per Python worker process and factory."""
    if identity not in _CLIENTS:
        _CLIENTS[identity] = factory()
    return _CLIENTS[identity]


def service_lookup(client_factory: Callable[[], object], key: str | None = DEFAULT_KEY,
                   style: str = "pooled"):
    """Pandas UDF calling ``client.get(k)`` through a per-process client.

    With ``key`` set (the sample functions), the key is fixed and the service is
    asked once per Arrow batch; with ``key=None`` the argument itself is the key
    and each distinct key of a batch is asked once. ``client_factory`` must be
    picklable (a module-level function) so executors can build their own client.
    """
    if style not in ("plus", "pooled"):
        raise ValueError("style must be 'plus' or 'pooled'")
    # what the factory pickles to tells factories apart, partials and closures too
    identity = hashlib.sha256(cloudpickle.dumps(client_factory)).hexdigest()

    def fmt(t: pd.Series, v: pd.Series) -> pd.Series:
        t = t.astype(object).where(t.notna(), "null")
        v = v.astype(object).where(v.notna(), "null")
        if style == "plus":
            return t + "+" + v
        return t + "_" + v + "_new"

    @F.pandas_udf(T.StringType())
    def lookup(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = _client(identity, client_factory)
        for t in batches:
            if key is not None:
                v = pd.Series([client.get(key)] * len(t), index=t.index, dtype=object)
            else:
                keys = t.dropna().unique()
                values = {k: client.get(k) for k in keys}
                v = t.map(values)
            yield fmt(t, v)

    return lookup


# a function config may name these two with "options" for their arguments
const_lookup.from_options = True  # type: ignore[attr-defined]
service_lookup.from_options = True  # type: ignore[attr-defined]
