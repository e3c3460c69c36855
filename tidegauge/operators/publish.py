"""Rows to keyed JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidegauge.functions.event_time import format_event_time
from tidegauge.schemas import AGGREGATE_SCHEMA


def event_json() -> Column:
    """The columns of a typed event as one JSON text."""
    return F.to_json(F.struct(
        "device_id",
        "device_type_id",
        format_event_time(F.col("event_time")).alias("event_time"),
        "temperature",
        "humidity",
    ))


def event_messages(events: DataFrame) -> DataFrame:
    """Typed events to messages: ``key`` is the device id, ``value`` the event as JSON."""
    return events.select(F.col("device_id").cast("string").alias("key"), event_json().alias("value"))


def aggregate_messages(rows: DataFrame) -> DataFrame:
    """Aggregate rows to JSON messages without key, fields in declared order."""
    return rows.select(F.to_json(F.struct(*AGGREGATE_SCHEMA.names)).alias("value"))


def read_aggregate_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Aggregate messages (text or UTF-8 bytes) back to rows; bad messages are left out."""
    parsed = _parsed_aggregates(messages, value)
    return parsed.where(F.col("reason").isNull()).select("row.*")


def rejected_aggregate_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages that :func:`read_aggregate_messages` leaves out, with a ``reason``."""
    return _parsed_aggregates(messages, value).where(F.col("reason").isNotNull()).select("value", "reason")


def _parsed_aggregates(messages: DataFrame, value: str) -> DataFrame:
    text = F.col(value).cast("string")
    given = F.map_keys(F.from_json(text, "map<string,string>"))
    broken = "_broken"
    schema = StructType([*AGGREGATE_SCHEMA.fields, StructField(broken, StringType())])
    read = F.from_json(text, schema, {"columnNameOfCorruptRecord": broken})
    # Bound to a generator, so that the parse is not repeated for each condition on it.
    parsed = messages.select(F.inline(F.array(F.struct(text.alias("value"), read.alias("row"), given.alias("given")))))
    reason = F.when(F.col("given").isNull() | F.col(f"row.{broken}").isNotNull(), "malformed_json")
    for name in AGGREGATE_SCHEMA.names:
        reason = reason.when(~F.array_contains("given", name), f"missing_{name}")
    row = F.struct(*[F.col(f"row.{name}").alias(name) for name in AGGREGATE_SCHEMA.names]).alias("row")
    return parsed.select("value", row, reason.alias("reason"))


def read_with_reasons(messages: DataFrame, value: str = "value") -> DataFrame:
    """Every message of aggregates: its row, or, where there is none, the message and the ``reason``."""
    parsed = _parsed_aggregates(messages, value)
    text = F.when(F.col("reason").isNotNull(), F.col("value"))
    row = [F.when(F.col("reason").isNull(), F.col(f"row.{name}")).alias(name) for name in AGGREGATE_SCHEMA.names]
    return parsed.select(*row, text.alias("rejected"), "reason")


def round_robin(messages: DataFrame, partitions: int) -> DataFrame:
    """Deal messages out to ``partitions`` in turn, as the ``partition`` column of a Kafka write.

    The messages of each task are counted first, so that a task goes on where the one before it ends, and partitions
    differ by one message at most, however many tasks there are. What a task reads should be the same both times, as it is of
    files and written tables; else the numbers are a little uneven. Batch only, which includes
    the frames a stream hands to its batch writer.
    """
    task = F.spark_partition_id()
    counts = messages.select(task.alias("task")).groupBy("task").agg(F.count("*").alias("n")).collect()
    first, before = {}, 0
    for row in sorted(counts):
        first[row["task"]] = before
        before = (before + row["n"]) % partitions
    starts = messages.sparkSession.createDataFrame(list(first.items()), "_task INT, _first INT")
    # The lower 33 bits number the rows of a task.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    placed = messages.withColumns({"_task": task, "_number": number}).join(F.broadcast(starts), "_task", "left")
    turn = F.pmod(F.col("_number") + F.coalesce("_first", F.lit(0)), F.lit(partitions)).cast("int")
    return placed.select(*messages.columns, turn.alias("partition"))
