"""What a stream's state holds: the windows that are still open, read from the checkpoint as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Spark writes of a committed batch.
_COMMIT = "nextBatchWatermarkMs LONG"


def watermark(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds up to which event time has passed after the last committed batch; 0 before any event."""
    commits = spark.read.text(f"{checkpoint}/commits")
    passed = F.from_json("value", _COMMIT)["nextBatchWatermarkMs"]
    return commits.where(F.col("value").startswith("{")).agg(F.max(passed)).first()[0] or 0


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per window and type the job of :func:`~tidegauge.streaming.sensor_stream.start` has not closed yet:

    ``window_start``, ``window_end``, ``device_type``, ``events``, ``state_rows`` (what the window
    costs in the state store), ``age_ms`` (event time passed since its start) and ``waits_ms`` (event time until it closes).
    Read with Spark's state source, so that it is a distributed scan of the last committed state, also
    of a job that is running.
    """
    passed = F.lit(watermark(spark, checkpoint))
    state = spark.read.format("statestore").load(checkpoint)
    rows = state.select("key.window", "key.device_type", F.col("value")["count"].alias("n"))
    per_window = rows.groupBy("window", "device_type").agg(F.sum("n").alias("events"), F.count("*").alias("state_rows"))
    return per_window.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "device_type",
        "events",
        "state_rows",
        (passed - F.unix_millis("window.start")).alias("age_ms"),
        (F.unix_millis("window.end") - passed).alias("waits_ms"),
    )
