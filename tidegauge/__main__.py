"""The jobs as commands: ``spark-submit --packages <kafka connector> -m tidegauge <command>``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from tidegauge.operators.publish import read_with_reasons
from tidegauge.schemas import INPUT_TOPIC, OUTPUT_TOPIC
from tidegauge.session import configure
from tidegauge.sources import dictionary, messages, sinks
from tidegauge.streaming import sensor_stream


def _properties() -> dict[str, str]:
    """Database credentials, from the environment of the caller."""
    named = {"user": os.environ.get("DICTIONARY_USER"), "password": os.environ.get("DICTIONARY_PASSWORD")}
    return {name: value for name, value in named.items() if value}


def _dictionary_source(spark: SparkSession, args) -> DataFrame:
    if args.dictionary.startswith("jdbc:"):
        return dictionary.read_jdbc(spark, args.dictionary, properties=_properties())
    return dictionary.read_table(spark, args.dictionary)


def load_dictionary(spark: SparkSession, args) -> None:
    """Replace the dictionary with the five standard device types."""
    types = dictionary.default_device_types(spark)
    if args.dictionary.startswith("jdbc:"):
        dictionary.replace_jdbc(types, args.dictionary, properties=_properties())
    else:
        dictionary.replace_table(types, args.dictionary)


def _connection(args) -> dict[str, str]:
    """Connection options (security, for one) that the reader and the writer of topics share."""
    return dict(option.split("=", 1) for option in args.option)


def source_options(args) -> dict[str, str]:
    """Options of the topic read besides servers and topic."""
    options = {"starting": args.starting, **_connection(args)}
    if args.group:
        options["group_id"] = args.group
    if args.records_per_batch:
        options["maxOffsetsPerTrigger"] = str(args.records_per_batch)
    return options


def _source(spark: SparkSession, args) -> DataFrame:
    if args.input_folder:
        return messages.stream_files(spark, args.input_folder)
    return messages.stream_kafka(spark, args.servers, args.input_topic, **source_options(args))


def _writer(args) -> sinks.BatchWriter:
    if args.output_folder:
        return sinks.files_writer(args.output_folder, args.output_partitions)
    return sinks.kafka_writer(args.servers, args.output_topic, args.output_partitions, **_connection(args))


def stream(spark: SparkSession, args) -> None:
    """Run the job from topic to topic (or folder to folder) until it is stopped.

    With ``--split`` every message is parsed once into a table of accepted events and rejected
    messages there, and the statistics read its accepted part; without it rejected messages are
    only counted.
    """
    source, write = _source(spark, args), _writer(args)
    names = dictionary.snapshot(_dictionary_source(spark, args))
    trigger = {"availableNow": True} if args.once else {}
    if args.split:
        split = sensor_stream.start_split(source, args.split, f"{args.checkpoint}/split", **trigger)
        if args.once:
            split.awaitTermination()
        source = sensor_stream.stream_accepted(spark, args.split)
    sensor_stream.start(source, names, write, f"{args.checkpoint}/statistics", **trigger)
    # Either query's failure ends the command.
    if args.once:
        for query in spark.streams.active:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def read(spark: SparkSession, args) -> None:
    """Show the aggregate rows as they arrive, and what is no such row with the reason, until stopped."""
    source = messages.stream_kafka(spark, args.servers, args.output_topic, **_connection(args))
    rows = read_with_reasons(source)
    rows.writeStream.format("console").option("truncate", "false").start().awaitTermination()


def parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidegauge")
    commands = parser.add_subparsers(required=True)
    for run in (load_dictionary, stream, read):
        command = commands.add_parser(run.__name__.replace("_", "-"), help=run.__doc__.splitlines()[0])
        command.set_defaults(run=run)
        if run is not load_dictionary:
            command.add_argument("--servers", help="of the topics")
            command.add_argument("--output-topic", default=OUTPUT_TOPIC)
            command.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="for the topics, e.g. kafka.security.protocol=SSL")
        if run is not read:
            command.add_argument("--dictionary", required=True, help="jdbc: address, or folder of Parquet files")
        if run is stream:
            command.add_argument("--input-topic", default=INPUT_TOPIC)
            command.add_argument("--group", help="consumer group")
            command.add_argument("--starting", default="earliest", help="earliest, latest, or offsets as JSON")
            command.add_argument("--records-per-batch", type=int, help="bounds a catch-up, and the state it holds")
            command.add_argument("--output-partitions", type=int, help="deal rows out to so many partitions in turn")
            command.add_argument("--input-folder", help="read files of messages instead of a topic")
            command.add_argument("--output-folder", help="write files of messages instead of a topic")
            command.add_argument("--split", help="folder for accepted events and rejected messages")
            command.add_argument("--once", action="store_true", help="work through what is there, then end")
            command.add_argument("--checkpoint", required=True)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(configure(SparkSession.builder.appName("tidegauge").getOrCreate()), args)


if __name__ == "__main__":
    main()
