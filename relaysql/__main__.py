"""Run a job from the command line (J1, J2), or one of the two topic commands (S3, K2).

    python -m relaysql MASTER INTERVAL_S APP_NAME IN_SERVERS OUT_SERVERS IN_TOPIC \\
        OUT_TOPIC GROUP_ID INPUT_SCHEMA OUTPUT_SCHEMA FUNCTIONS SQL [options]

The twelve positional values are the job configuration; exactly twelve are
required. ``--transport text`` reads and writes folders of text files instead
of topics (the servers arguments are then the input and output folders).
``--reference NAME=PATH`` adds a Parquet table as a view for lookups, and a function
config's ``options`` name the view. ``--prototype`` drops fields of unknown types.

    python -m relaysql dump SERVERS TOPIC [--transport text] [--out FOLDER]
    python -m relaysql publish PARQUET SERVERS TOPIC [--transport text]

``dump`` prints the messages of a topic from its beginning (or writes them to a
folder of text files); ``publish`` sends each row of a table as a JSON message.
"""

from __future__ import annotations

import argparse
import sys

from relaysql.plans.job import SqlJob
from relaysql.sources.topic import kafka_sink, kafka_source, publish_table, text_sink, text_source
from relaysql.spec import ARG_NAMES, JobSpec
from relaysql.streaming.runner import start_stream


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m relaysql", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", nargs="*", metavar="ARG", help=f"the {len(ARG_NAMES)} job values: {' '.join(ARG_NAMES)}")
    p.add_argument("--transport", choices=("kafka", "text"), default="kafka")
    p.add_argument("--on-bad-record", choices=("fail", "quarantine"), default="fail")
    p.add_argument("--quarantine", help="topic (or folder) for rejected messages; implies quarantine")
    p.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    p.add_argument("--reference", action="append", default=[], metavar="NAME=PATH", help="a Parquet table as a view")
    p.add_argument("--prototype", action="store_true", help="drop schema fields of unknown types")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--preview", action="store_true", help="print the first result rows of each batch")
    return p.parse_args(argv)


def topic_command(argv: list[str]) -> int:
    """``dump`` and ``publish``."""
    p = argparse.ArgumentParser(prog="python -m relaysql")
    commands = p.add_subparsers(dest="command", required=True)
    dump = commands.add_parser("dump", help="print a topic's messages from its beginning")
    publish = commands.add_parser("publish", help="send a table's rows as JSON messages")
    publish.add_argument("table", help="Parquet path")
    for c in (dump, publish):
        c.add_argument("servers")
        c.add_argument("topic", nargs="?", default="")
        c.add_argument("--transport", choices=("kafka", "text"), default="kafka")
    dump.add_argument("--out", help="folder for the messages; printed when not given")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    if args.command == "publish":
        sink = kafka_sink(args.servers, args.topic) if args.transport == "kafka" else text_sink(args.servers)
        publish_table(spark.read.parquet(args.table), sink)
        return 0
    source = (kafka_source(args.servers, args.topic, starting_offsets="earliest") if args.transport == "kafka"
              else text_source(args.servers))
    messages = source.read(spark)
    if args.out:
        text_sink(args.out).write(messages)
    else:
        for row in messages.toLocalIterator():      # one partition at a time
            print(row["value"])
    return 0


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] in (["dump"], ["publish"]):
        return topic_command(argv)
    args = parse_args(argv)
    if args.on_bad_record == "quarantine" and not args.quarantine:
        raise SystemExit("--on-bad-record quarantine needs --quarantine TOPIC, else bad messages would be lost")
    policy = "quarantine" if args.quarantine else args.on_bad_record
    spec = JobSpec.from_args(args.job, on_bad_record=policy, unknown_types="drop" if args.prototype else "string")
    references = dict(r.split("=", 1) for r in args.reference)

    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName(spec.app_name)
    if spec.master:
        builder = builder.master(spec.master)
    spark = builder.getOrCreate()
    slots = spark.sparkContext.defaultParallelism

    if args.transport == "kafka":
        extra = {"minPartitions": slots}
        if args.max_offsets_per_trigger:
            extra["maxOffsetsPerTrigger"] = args.max_offsets_per_trigger
        source = kafka_source(spec.in_servers, spec.in_topic, spec.group_id, args.starting_offsets, **extra)
        sink = kafka_sink(spec.out_servers, spec.out_topic)
        bad = kafka_sink(spec.out_servers, args.quarantine) if args.quarantine else None
    else:
        source, sink = text_source(spec.in_servers), text_sink(spec.out_servers)
        bad = text_sink(args.quarantine) if args.quarantine else None

    query = start_stream(SqlJob(spec, reference_views=references), spark, source, sink, quarantine=bad, checkpoint=args.checkpoint,
                         available_now=args.available_now, show_preview=args.preview, query_name=spec.app_name)
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
