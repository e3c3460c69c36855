"""The event and region tables as events, messages and dictionary of the sensor job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.publish import event_json, event_messages
from tidegauge.sources.dictionary import BROADCAST_ROWS, Dictionary, snapshot


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same table, one file or a folder of part files, as a stream of its files.

    Without such a table, reading its schema fails.
    """
    # A stream takes a single file only by a pattern; this one matches the name and nothing else.
    return spark.readStream.schema(read_events(spark, folder).schema).parquet(f"{folder}/event[s].parquet")


def to_events(table: DataFrame, *extra: str) -> DataFrame:
    """Rows of the event table as typed sensor events."""
    return table.select(
        *extra,
        F.col("user_id").cast("string").alias("device_id"),
        (F.col("user_id") % 7).cast("int").alias("device_type_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("temperature"),
        F.from_json("props", "k DOUBLE")["k"].alias("humidity"),
    )


def to_messages(table: DataFrame) -> DataFrame:
    return event_messages(to_events(table)).select("value")


def read_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    region = spark.read.parquet(f"{folder}/region.parquet")
    return region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("type_name"))


def region_dictionary(spark: SparkSession, folder: str, broadcast_rows: int = BROADCAST_ROWS) -> Dictionary:
    return snapshot(read_dictionary(spark, folder), broadcast_rows)


def _rewrite(value: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(value, pattern, replacement)


def damaged_messages(table: DataFrame) -> DataFrame:
    """Every event as a message, most of them damaged in one of eleven ways chosen by the event id."""
    published = to_events(table, "event_id").select("event_id", event_json().alias("value"))
    kind = F.col("event_id") % 16
    value = F.col("value")
    damages = [
        F.left(value, F.length(value) - 1),
        _rewrite(value, '"temperature":[^,]*,', ""),
        _rewrite(value, '"event_time":"[^"]*"', '"event_time":1704067200'),
        _rewrite(value, '"device_type_id":([0-9]+)', '"device_type_id":"$1.0"'),
        _rewrite(value, '"humidity":[^}]*', '"humidity":null'),
        F.concat(value, F.lit(" x")),
        F.concat(F.lit("["), value, F.lit("]")),
        _rewrite(value, '"temperature":([^,]*)', '"temperature":"$1d"'),
        _rewrite(value, '"device_id":"[^"]*",', ""),
        _rewrite(value, '"device_type_id":[0-9]+', '"device_type_id":3000000000'),
        _rewrite(value, '"event_time":"[^"]*"', '"event_time":"yesterday"'),
    ]
    damaged = value
    for number, text in enumerate(damages, start=1):
        damaged = F.when(kind == number, text).otherwise(damaged)
    return published.select(damaged.alias("value"))
