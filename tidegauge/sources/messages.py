"""Message sources: Kafka topics and folders of text files, in batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schemas import INPUT_TOPIC


def kafka_options(
    servers: str, topic: str, group_id: str | None = None, starting: str = "earliest", **options: str
) -> dict[str, str]:
    """Options of a topic read; others such as ``maxOffsetsPerTrigger`` are passed on.

    Progress lives in the checkpoint, so the group id is optional.
    """
    chosen = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **options}
    if group_id:
        chosen["kafka.group.id"] = group_id
    return chosen


def decode_value(records: DataFrame) -> DataFrame:
    """Message value as text; key, partition, offset and timestamp are dropped."""
    return records.select(F.col("value").cast("string").alias("value"))


def stream_kafka(spark: SparkSession, servers: str, topic: str = INPUT_TOPIC, **options: str) -> DataFrame:
    """Unbounded text messages of a topic (needs the Kafka connector package)."""
    return decode_value(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load())


def read_kafka(spark: SparkSession, servers: str, topic: str = INPUT_TOPIC, **options: str) -> DataFrame:
    """The messages a topic holds now (needs the Kafka connector package)."""
    return decode_value(spark.read.format("kafka").options(**kafka_options(servers, topic, **options)).load())


def stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded text messages, one per line, of the files that appear in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Text messages, one per line, of a folder."""
    return spark.read.text(path)
