"""Message topics: where messages come from and go to.

A message source yields a DataFrame with one text column ``value``; a message
sink takes one. Two transports are supported with the same shape:

* ``kafka`` - Spark's Kafka connector (needs the
  ``spark-sql-kafka-0-10`` package on the classpath). Only the record value is
  kept; key, partition, offset and timestamp are dropped.
* ``text`` - a folder of text files, one message per line: the file twin of a
  topic, used for tests and for replaying captured messages.

Scale notes. Reading is split by Kafka partition (``minPartitions`` can split
further) or by file block; ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``
bound one micro-batch. Writing is one task per DataFrame partition, each with
its own producer or file; no row passes through the driver.

Whole batches in text folders. A stream's batch is written to a folder of its own,
``run=R/batch_id=N/attempt=A``, and becomes visible to ``MessageSource.read`` with an empty
marker file ``run=R/_commits/N-A``, made when all its files are there. A reader lists the
markers and reads the folders they name, so it sees a batch whole or not at all, also
while one is written or run again; the driver lists one name per batch. A batch with a
marker is not written again: the first whole attempt stands. A streaming read of such a
folder takes files as they appear, as from any folder, and may see a failed attempt's too.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSPORTS = ("kafka", "text")
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13"


class ConnectorMissing(RuntimeError):
    """The Kafka connector is not on the classpath."""


def _kafka_missing(e: Exception) -> bool:
    text = str(e).lower()
    return "kafka" in text and "find" in text and "data source" in text


def _missing(e: Exception) -> ConnectorMissing:
    return ConnectorMissing(
        f"the Kafka source/sink needs {KAFKA_PACKAGE}:<spark version> on the classpath "
        "(e.g. spark-submit --packages); the text transport works without it")


def _load(reader, transport: str, *path: str) -> DataFrame:
    try:
        return reader.load(*path)
    except Exception as e:  # AnalysisException from the data source lookup
        if transport == "kafka" and _kafka_missing(e):
            raise _missing(e) from e
        raise


def _files(session: SparkSession, path: str):
    """The Hadoop file system of a path, and the class of its paths."""
    hadoop = session._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(session._jsparkSession.sessionState().newHadoopConf()), hadoop


def committed(session: SparkSession, folder: str, run: str = "*", batch_id: int | str = "*") -> list[str]:
    """The folders of the whole batches below a text sink's folder: one attempt per run
    and batch, the one with the smallest name should two drivers have made markers."""
    folder = folder.rstrip("/")
    files, hadoop = _files(session, folder)
    found: dict[tuple[str, str], str] = {}
    for status in files.globStatus(hadoop(f"{folder}/run={run}/_commits/{batch_id}-*")) or ():
        marker = status.getPath()
        number, attempt = marker.getName().split("-", 1)
        key = (marker.getParent().getParent().getName(), number)
        found[key] = min(attempt, found.get(key, attempt))
    return [f"{folder}/{r}/batch_id={n}/attempt={a}" for (r, n), a in sorted(found.items())]


def _visible(session: SparkSession, folder: str) -> list[str]:
    """What a batch read of a text folder reads: the folder itself, or, where a stream has
    written to it, its whole batches and the plain files and folders beside them."""
    folder = folder.rstrip("/")
    files, hadoop = _files(session, folder)
    if not (files.globStatus(hadoop(f"{folder}/run=*")) or ()):
        return [folder]
    beside = [s.getPath() for s in files.listStatus(hadoop(folder))]
    # batches of earlier versions have their files in the batch's folder itself
    older = [s.getPath().getParent().toString() for s in files.globStatus(hadoop(f"{folder}/run=*/batch_id=*/_SUCCESS")) or ()]
    return committed(session, folder) + older + [p.toString() for p in beside if not p.getName().startswith(("run=", "_", "."))]


def value_only(records: DataFrame) -> DataFrame:
    """Keep the message value of topic records, as text."""
    return records.select(F.col("value").cast("string").alias("value"))


@dataclass(frozen=True)
class MessageSource:
    """A topic (or its text-file twin) to read messages from."""

    transport: str
    location: str            # bootstrap servers for kafka, folder for text
    topic: str = ""
    group_id: str = ""
    starting_offsets: str = "latest"
    options: dict = field(default_factory=dict, hash=False)

    def __post_init__(self):
        if self.transport not in TRANSPORTS:
            raise ValueError(f"transport must be one of {TRANSPORTS}")
        if self.transport == "kafka" and not self.topic:
            raise ValueError("a kafka source needs a topic")

    def reader_options(self, streaming: bool) -> dict[str, str]:
        if self.transport == "text":
            return {k: str(v) for k, v in self.options.items()}
        opts = {
            "kafka.bootstrap.servers": self.location,
            "subscribe": self.topic,
            # a batch read cannot start at the end of the topic
            "startingOffsets": "earliest" if not streaming and self.starting_offsets == "latest" else self.starting_offsets,
            "failOnDataLoss": "true",
        }
        if self.group_id:
            opts["kafka.group.id"] = self.group_id
        if not streaming:
            opts["endingOffsets"] = "latest"
        opts.update({k: str(v) for k, v in self.options.items()})
        return opts

    def read_stream(self, session: SparkSession) -> DataFrame:
        reader = session.readStream.format(self.transport).options(**self.reader_options(True))
        if self.transport == "text":
            return value_only(_load(reader, self.transport, self.location))
        return value_only(_load(reader, self.transport))

    def read(self, session: SparkSession) -> DataFrame:
        """Batch read of what is in the topic now (S3 reads from ``earliest``)."""
        reader = session.read.format(self.transport).options(**self.reader_options(False))
        if self.transport == "text":
            paths = _visible(session, self.location)
            if not paths:
                return session.createDataFrame([], "value string")
            return value_only(_load(reader, self.transport, paths))
        return value_only(_load(reader, self.transport))


def kafka_source(servers: str, topic: str, group_id: str = "", starting_offsets: str = "latest",
                 **options) -> MessageSource:
    """A topic source. Pass ``minPartitions`` (e.g. the cluster's task slots) to
    split topic partitions into more Spark partitions without a shuffle, and
    ``maxOffsetsPerTrigger`` to bound one micro-batch."""
    return MessageSource("kafka", servers, topic, group_id, starting_offsets, options)


def text_source(folder: str, **options) -> MessageSource:
    return MessageSource("text", folder, options=options)


@dataclass(frozen=True)
class MessageSink:
    """A topic (or its text-file twin) to publish messages to (K1)."""

    transport: str
    location: str
    topic: str = ""
    options: dict = field(default_factory=dict, hash=False)

    def __post_init__(self):
        if self.transport not in TRANSPORTS:
            raise ValueError(f"transport must be one of {TRANSPORTS}")
        if self.transport == "kafka" and not self.topic:
            raise ValueError("a kafka sink needs a topic")

    def writer_options(self) -> dict[str, str]:
        if self.transport == "text":
            return {k: str(v) for k, v in self.options.items()}
        opts = {"kafka.bootstrap.servers": self.location, "topic": self.topic}
        opts.update({k: str(v) for k, v in self.options.items()})
        return opts

    def write(self, values: DataFrame, batch_id: int | None = None, run: str | None = None) -> None:
        """Publish the ``value`` column (appended, as to a topic).

        For text with a ``batch_id`` and ``run``, the identity that a stream's
        checkpoint holds, each batch goes to its own ``run=R/batch_id=N`` folder and
        is committed whole (see the module): run again after a failure it takes the
        place of attempts that were not, and never that of another run.
        """
        if batch_id is not None and not run:
            raise ValueError("a batch needs the identity of its run, else it could replace another run's output")
        out = values.select(F.col("value").cast("string").alias("value"))
        if self.transport == "kafka":
            try:
                out.write.format("kafka").options(**self.writer_options()).save()
            except Exception as e:
                if _kafka_missing(e):
                    raise _missing(e) from e
                raise
            return
        if batch_id is None:
            out.write.mode("append").options(**self.writer_options()).text(self.location)
            return
        session, folder = values.sparkSession, f"{self.location.rstrip('/')}/run={run}"
        if committed(session, self.location, run, batch_id):
            return
        attempt = uuid.uuid4().hex[:12]
        path = f"{folder}/batch_id={batch_id}"
        out.write.options(**self.writer_options()).text(f"{path}/attempt={attempt}")
        files, hadoop = _files(session, folder)
        files.create(hadoop(f"{folder}/_commits/{batch_id}-{attempt}"), False).close()
        for status in files.listStatus(hadoop(path)):        # attempts that no reader was shown
            if status.getPath().getName() != f"attempt={attempt}":
                files.delete(status.getPath(), True)


def kafka_sink(servers: str, topic: str, **options) -> MessageSink:
    return MessageSink("kafka", servers, topic, options)


def text_sink(folder: str, **options) -> MessageSink:
    return MessageSink("text", folder, options=options)


def table_as_messages(df: DataFrame) -> DataFrame:
    """K2: every row of a table as one JSON message text (``value``)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def publish_table(df: DataFrame, sink: MessageSink) -> None:
    """K2: publish a DataFrame as messages."""
    sink.write(table_as_messages(df))
