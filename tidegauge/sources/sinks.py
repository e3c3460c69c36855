"""Writers for finished batches of messages, and the reader of what they wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.publish import aggregate_messages, event_messages, read_aggregate_messages, round_robin
from tidegauge.schemas import AGGREGATE_SCHEMA, INPUT_TOPIC, OUTPUT_TOPIC
from tidegauge.sources.messages import read_kafka

BatchWriter = Callable[[DataFrame, int], None]


def files_writer(path: str, files: int | None = None) -> BatchWriter:
    """Write aggregate rows as JSON lines, one folder per batch.

    A batch that is run again after a failure overwrites its own folder, so the output holds each
    batch once. ``files`` deals the rows out to that many files in turn.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        messages = aggregate_messages(rows)
        if files:
            messages = messages.repartition(files)
        messages.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def kafka_writer(
    servers: str, topic: str = OUTPUT_TOPIC, partitions: int | None = None, **options: str
) -> BatchWriter:
    """Write aggregate rows to a topic, at least once (needs the Kafka connector package).

    ``partitions`` deals the messages out in turn; without it the producer's own partitioner does.
    ``options`` are passed on, for a secured connection for one.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        messages = aggregate_messages(rows)
        if partitions:
            messages = round_robin(messages, partitions)
        chosen = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
        messages.write.format("kafka").options(**chosen).save()

    return write


def publish_kafka(events: DataFrame, servers: str, topic: str = INPUT_TOPIC) -> None:
    """Write typed events to a topic, keyed by device."""
    writer = event_messages(events).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_kafka_stream(
    events: DataFrame, servers: str, checkpoint: str, topic: str = INPUT_TOPIC, **trigger
) -> StreamingQuery:
    """Write a stream of typed events to a topic, keyed by device."""
    writer = (
        event_messages(events)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_aggregates(spark: SparkSession, path: str) -> DataFrame:
    """The aggregate rows under a folder of :func:`files_writer`; none if no batch has been written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], AGGREGATE_SCHEMA)
    return read_aggregate_messages(spark.read.schema("value STRING").text(path))


def read_aggregates_kafka(spark: SparkSession, servers: str, topic: str = OUTPUT_TOPIC, **options: str) -> DataFrame:
    """The aggregate rows a topic holds now."""
    return read_aggregate_messages(read_kafka(spark, servers, topic, **options))
