"""The micro-batch runner.

``start_stream`` reads messages with Structured Streaming and hands every
micro-batch to :meth:`SqlJob.run_batch` through ``foreachBatch``. That keeps the
original semantics - the SQL sees one batch, with no state carried between
batches (J3) - while allowing any SQL, including window functions and sorts
that a streaming plan would reject.

Delivery: source offsets live in the query checkpoint (under the shared
``spark.checkpoint.dir``), so a restarted or failed query resumes from the last
committed batch and re-runs at most that batch: at-least-once to Kafka,
effectively once to the text sink, which commits each batch whole and once (its
folder carries the query's id, which lives in the checkpoint, so another query or a
new checkpoint appends beside it).
Tasks lost with an executor are retried by Spark from the batch's source
offsets; nothing is held on the driver.

Reference views are resolved anew for each micro-batch (``SqlJob.bind_views``): a
batch sees the lookup tables as they are when it starts, the same for all its reads.

When a batch has two outputs (results and quarantined messages), or its SQL reads
``source`` more than once, the decoded batch is persisted (memory and disk) for the
duration of the batch, so the messages are read and parsed once; with a preview the
shaped result is persisted, so the SQL runs once. Both are released when the batch
is done.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from relaysql.plans.job import SqlJob, preview
from relaysql.session import shared_path
from relaysql.sources.topic import MessageSink, MessageSource
from relaysql.spec import DEFAULT_APP_NAME

# Fixed value: Spark's local property with the running query's id.
QUERY_ID = "sql.streaming.queryId"


def batch_handler(job: SqlJob, sink: MessageSink, quarantine: MessageSink | None = None,
                  show_preview: bool = False):
    """The ``foreachBatch`` function: run the job on the batch and publish."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        job.bind_views(batch.sparkSession)
        out = job.run_batch(batch)
        held = []
        if quarantine is not None and not out.cached and out.stored_at is None:
            held.append(out.checked.persist(StorageLevel.MEMORY_AND_DISK))
        if show_preview:
            held.append(out.shaped.persist(StorageLevel.MEMORY_AND_DISK))
        try:
            if show_preview:
                preview(out.shaped).show(truncate=False)
            run = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
            sink.write(out.values, batch_id, run)
            if quarantine is not None and out.rejected is not None:
                quarantine.write(out.rejected.selectExpr("to_json(struct(*)) AS value"), batch_id, run)
        finally:
            for df in held:
                df.unpersist()
            out.release()

    return handle


def start_stream(job: SqlJob, spark: SparkSession, source: MessageSource, sink: MessageSink, *,
                 quarantine: MessageSink | None = None, checkpoint: str | None = None,
                 available_now: bool = False, show_preview: bool = False,
                 query_name: str | None = None) -> StreamingQuery:
    """Start the job as a streaming query.

    The trigger is the spec's interval (``processingTime``); ``available_now``
    processes what is there and stops, for tests and backfills.
    """
    if quarantine is not None and job.spec.on_bad_record != "quarantine":
        raise ValueError("a quarantine sink needs on_bad_record='quarantine'")
    if quarantine is None and job.spec.on_bad_record == "quarantine":
        raise ValueError("on_bad_record='quarantine' needs a quarantine sink, else bad messages would be lost")
    if checkpoint is None and job.spec.app_name == DEFAULT_APP_NAME:
        raise ValueError("give a checkpoint or an app name of its own: two jobs must not share a checkpoint")
    session = job.open(spark)
    checkpoint = checkpoint or shared_path(spark, "streams", job.spec.app_name, unique=False)
    writer = (
        source.read_stream(session)
        .writeStream.foreachBatch(batch_handler(job, sink, quarantine, show_preview))
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{job.spec.interval_seconds} seconds")
    return writer.start()
