"""Session settings the results depend on, and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that change results (not performance)."""
    # Labels are UTC, and a timestamp without an offset is read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # JSON objects may repeat a key; the last value wins.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidegauge-")


def _application_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/tidegauge-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: on a cluster a
    machine-local path would be lost with the machine.
    """
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back. ``options`` are the Parquet writer's.

    Cuts the lineage: what follows can read it several times, and an executor loss costs at most
    the tasks that were running, never a second pass over the source.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> None:
    """Delete the shared folders of this application, once its results have been written out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
