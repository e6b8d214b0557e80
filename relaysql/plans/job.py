"""One job = decode -> view ``source`` -> user SQL -> shape -> JSON.

:meth:`SqlJob.run_batch` is the core. It builds DataFrames and fires no Spark job,
so the decode, the SQL and the encode are one Catalyst plan. Every declared field
is decoded and checked whatever the SQL reads (a bad record is bad either way), and
user filters stay above the decode; besides the SQL's own shuffles there is at most
one, which spreads an input of few partitions. ``source`` is a view over the decode:
where the analysed SQL names it several times, the decoded stage is shared, so the
messages are read and parsed once (``SqlJob(share=...)``), and given back with
:meth:`BatchResult.release`. The stream runner calls the same method once per
micro-batch, so every batch is computed independently (aggregates, windows and
DISTINCT see one batch).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from relaysql.functions import library
from relaysql.functions.registry import register_function, register_functions
from relaysql.operators.decode import Decoded, decoder_for
from relaysql.operators.shape import encode_json, shape
from relaysql.session import job_session, shared_path
from relaysql.spec import JobSpec

SOURCE_VIEW = "source"
# Fixed value: the SQL name of the function every job gets, whatever its config
# says (F1).
COMMON_FUNCTION = "MyUDF"
PREVIEW_ROWS = 20
SHARE_MODES = ("cache", "store", "no")


@dataclass(frozen=True)
class BatchResult:
    source: DataFrame        # decoded, typed table behind the view ``source``
    result: DataFrame        # the SQL result as the user wrote it
    shaped: DataFrame        # projected onto the output schema, nulls resolved
    values: DataFrame        # one JSON text per row, column ``value``
    rejected: DataFrame | None  # bad messages (value, reason) under quarantine
    checked: DataFrame       # decode stage shared by ``source`` and ``rejected``
    mentions: int            # how often the SQL reads ``source``
    stored_at: str | None = None  # where the shared stage lies, if it is stored
    cached: bool = False          # is the shared stage persisted

    def release(self) -> None:
        """Give back the shared decode stage; the results cannot be read anew from it."""
        if self.cached:
            self.checked.unpersist()
        if self.stored_at is not None:
            spark = self.checked.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(self.stored_at)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class SqlJob:
    def __init__(self, spec: JobSpec, extra_functions: dict | None = None,
                 reference_views: dict[str, Callable[[SparkSession], DataFrame] | str] | None = None,
                 rebalance: bool | int = True, share: str = "cache"):
        """``extra_functions`` maps names to function objects registered beside
        the config's; ``reference_views`` are extra read-only views (lookup
        tables) the SQL and SQL-bodied lookup functions may name, each given as
        a parquet path or as a function building the DataFrame in a session
        (``versioned_view`` for tables replaced while jobs run). A stream binds
        them anew for every micro-batch.

        ``rebalance``: decoding is CPU-bound, so when a batch arrives in fewer
        partitions than the cluster has task slots (few topic partitions, one
        large file), it is spread round-robin first - over up to
        ``SPREAD_FACTOR`` times its partitions, capped by the slots (or over
        ``rebalance`` partitions when an int is given). A batch that already has
        enough partitions - the normal case at scale, and always for a topic read
        with ``minPartitions`` - is left as it is, with no shuffle.

        ``share``: how SQL that names ``source`` more than once gets it decoded once.
        ``"cache"`` persists the decoded stage in memory and on the executors' disks
        when the SQL first runs (no job before); ``"store"`` writes it under the
        shared folder at once, for batches beyond the executors' disks or where
        executors come and go; ``"no"`` decodes once per mention."""
        if share not in SHARE_MODES:
            raise ValueError(f"share must be one of {SHARE_MODES}, got {share!r}")
        self.share = share
        self.spec = spec
        self.extra_functions = dict(extra_functions or {})
        self.reference_views = dict(reference_views or {})
        self._view_schemas: dict[str, StructType] = {}
        self.rebalance = rebalance

    def open(self, spark: SparkSession) -> SparkSession:
        """A session for this job with its functions and reference views registered."""
        session = job_session(spark, self.spec.extra_conf)
        self.prepare(session)
        return session

    def bind_views(self, session: SparkSession) -> None:
        """Register the reference views as their tables are now. Files are listed here,
        once: whatever reads a view until the next call reads the same files. A path keeps
        the schema it had first, so binding it again runs no job."""
        for name, view in self.reference_views.items():
            if callable(view):
                df = view(session)
            elif name in self._view_schemas:
                df = session.read.schema(self._view_schemas[name]).parquet(view)
            else:
                df = session.read.parquet(view)
                self._view_schemas[name] = df.schema
            df.createOrReplaceTempView(name)

    def prepare(self, session: SparkSession) -> None:
        self.bind_views(session)
        register_function(session, COMMON_FUNCTION, library.suffix_test)
        register_functions(session, self.spec.function_specs)
        for name, obj in self.extra_functions.items():
            register_function(session, name, obj)

    def run_batch(self, messages: DataFrame, value_col: str = "value") -> BatchResult:
        """Run the job over one batch of messages (a DataFrame with a text column).

        The view is made in ``messages``' own session, which must be one from
        :meth:`open` (or a streaming batch of it).
        """
        if self.rebalance:
            messages = spread(messages, None if self.rebalance is True else int(self.rebalance))
        decoder = decoder_for(messages.sparkSession, self.spec.input_fields, self.spec.on_bad_record)
        decoded = decoder(messages, value_col)
        result, stored_at, cached = self._sql(decoded), None, False
        mentions = source_mentions(result)
        if mentions > 1 and self.share == "cache":
            decoded.checked.persist(StorageLevel.MEMORY_AND_DISK)
            cached = True
        elif mentions > 1 and self.share == "store":
            stored_at = shared_path(messages.sparkSession, "decoded")
            decoded.checked.write.parquet(stored_at)
            decoded = decoder.split(messages.sparkSession.read.schema(decoded.checked.schema).parquet(stored_at))
            result = self._sql(decoded)
        shaped = shape(result, self.spec.output_fields) if self.spec.output_fields else result
        return BatchResult(decoded.rows, result, shaped, encode_json(shaped), decoded.rejected, decoded.checked,
                           mentions, stored_at, cached)

    def _sql(self, decoded: Decoded) -> DataFrame:
        decoded.rows.createOrReplaceTempView(SOURCE_VIEW)
        return decoded.rows.sparkSession.sql(self.spec.sql)


def versioned_view(folder: str) -> Callable[[SparkSession], DataFrame]:
    """A reference view over the newest whole version of a parquet table whose versions
    are folders ``version=N``, each complete once its ``_SUCCESS`` file is there. A writer
    adds a version and leaves older ones to the batches still reading them, so a batch
    never meets a half-written table or files that vanish."""
    def newest(session: SparkSession) -> DataFrame:
        hadoop = session._jvm.org.apache.hadoop.fs.Path
        files = hadoop(folder).getFileSystem(session._jsparkSession.sessionState().newHadoopConf())
        whole = [s.getPath().getParent() for s in files.globStatus(hadoop(f"{folder.rstrip('/')}/version=*/_SUCCESS")) or ()]
        if not whole:
            raise FileNotFoundError(f"no whole version below {folder}")
        return session.read.parquet(max(whole, key=lambda p: int(p.getName().split("=")[1])).toString())

    return newest


def source_mentions(result: DataFrame) -> int:
    """How often the analysed plan, subqueries included, reads the view ``source``."""
    return result._jdf.queryExecution().analyzed().toString().count(f"View (`{SOURCE_VIEW}`")


# At most this many partitions are made from each input partition: enough to
# use a small machine's cores for a single-file input, without turning a small
# micro-batch into thousands of empty tasks on a large cluster.
SPREAD_FACTOR = 8


def spread(df: DataFrame, target: int | None = None) -> DataFrame:
    """Round-robin ``df`` over more partitions when it has few.

    The target is ``target`` if given, else ``min(task slots, SPREAD_FACTOR x
    input partitions)``; an input already at or above it is left alone (no
    shuffle). Nothing runs here: partitions are counted only where the plan is
    narrow down to its scan. A plan with a shuffle (or a subquery) gets its
    partitions when it runs, from AQE, and counting them would run it.
    """
    if _runs_to_count(df):
        return df
    n = df.rdd.getNumPartitions()
    if target is None:
        target = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_FACTOR * max(n, 1))
    if n < target:
        return df.repartition(target)
    return df


def _runs_to_count(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "AdaptiveSparkPlan" in plan or "Exchange" in plan


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """Q2: the first ``n`` result rows, as ``show()`` would print them."""
    return df.limit(n)
