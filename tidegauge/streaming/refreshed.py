"""Events named by a dictionary that may be replaced while the stream runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.enrich import enrich, hot_ids
from tidegauge.sources import versions
from tidegauge.sources.dictionary import BROADCAST_ROWS

ENRICHED = "device_type STRING, event_time TIMESTAMP, temperature DOUBLE, humidity DOUBLE"


def start(
    events: DataFrame, dictionary_path: str, path: str, checkpoint: str, broadcast_rows: int = BROADCAST_ROWS, **trigger
) -> StreamingQuery:
    """Write streaming ``events`` with their type names to ``path``, a folder per micro-batch and version.

    The newest version of the dictionary (:mod:`tidegauge.sources.versions`) is chosen once per micro-batch, so that a
    change shows from the next batch on and never within one. The choice is noted before the batch is written: a
    batch that is repeated after a failure takes the same version, whatever has been replaced meanwhile.
    """
    spark = events.sparkSession

    def take(batch: DataFrame, batch_id: int) -> None:
        noted = f"{path}/chosen/batch={batch_id}"
        files, at = versions._files(spark, path)
        if not files.exists(at(f"{noted}/_SUCCESS")):
            chosen = spark.range(1).select(F.lit(versions.newest(spark, dictionary_path)).cast("long").alias("version"))
            chosen.write.mode("overwrite").parquet(noted)
        version = spark.read.schema("version LONG").parquet(noted).first()["version"]
        dictionary = versions.dictionary(spark, dictionary_path, version, broadcast_rows)
        # A streaming job may run without adaptive execution; the batch itself tells which ids are hot.
        named = enrich(batch, dictionary, () if dictionary.is_broadcastable else hot_ids(batch))
        named.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The events written so far, with ``version`` and ``batch``."""
    return spark.read.schema(f"{ENRICHED}, version LONG, batch INT").parquet(f"{path}/rows")


def stream(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream of enriched events, for the window operators."""
    rows = spark.readStream.schema(f"{ENRICHED}, version LONG, batch INT").parquet(f"{path}/rows")
    return rows.select("device_type", "event_time", "temperature", "humidity")
