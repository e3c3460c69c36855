"""A dictionary table in versions: replaced at one stroke, read as it was at any time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schemas import DICTIONARY_SCHEMA
from tidegauge.sources.dictionary import BROADCAST_ROWS, Dictionary, checked_copy

POINTERS = "version LONG, folder STRING, valid_from TIMESTAMP, rows LONG"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions of a table: ``version``, ``folder``, ``valid_from``, ``rows``; none before the first."""
    files, at = _files(spark, path)
    if not files.exists(at(f"{path}/versions")):
        return spark.createDataFrame([], POINTERS)
    return spark.read.schema(POINTERS).json(f"{path}/versions")


def replace(df: DataFrame, path: str) -> int:
    """Make these rows the newest version, and give its number.

    The rows are checked and written to a folder of their own first. Then one small file names the folder; it is
    moved to its place, which either happens or not. A write that fails, or a dictionary that is refused, leaves the
    last version as it was, and two writers cannot both make the same version.
    """
    spark = df.sparkSession
    checked, rows = checked_copy(df)
    folder = f"data-{uuid.uuid4().hex}"
    checked.write.parquet(f"{path}/{folder}")
    number = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    files, at = _files(spark, path)
    files.mkdirs(at(f"{path}/versions"))
    pending = f"{path}/pending-{uuid.uuid4().hex}"
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("version"), F.lit(folder).alias("folder"),
        F.current_timestamp().alias("valid_from"), F.lit(rows).cast("long").alias("rows"),
    )
    row.coalesce(1).write.json(pending)
    [part] = [f.getPath() for f in files.listStatus(at(pending)) if f.getPath().getName().endswith(".json")]
    # A rename does not replace a file that is there.
    place = at(f"{path}/versions/{number:012}.json")
    moved = not files.exists(place) and files.rename(part, place)
    files.delete(at(pending), True)
    if not moved:
        raise RuntimeError(f"version {number} of {path} was made by another writer")
    return number


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of one version, by default of the newest. The folder is resolved now and stays the same after."""
    known = versions(spark, path)
    chosen = known.where(F.col("version") == version) if version else known.orderBy(F.col("version").desc())
    row = chosen.select("folder").first()
    if row is None:
        raise ValueError(f"no version {version or ''} of a dictionary in {path}")
    return spark.read.schema(DICTIONARY_SCHEMA).parquet(f"{path}/{row['folder']}")


def newest(spark: SparkSession, path: str) -> int:
    return versions(spark, path).agg(F.max("version")).first()[0]


def dictionary(spark: SparkSession, path: str, version: int, broadcast_rows: int = BROADCAST_ROWS) -> Dictionary:
    """One version as a dictionary for the lookup. It was checked when it was written and does not change."""
    rows = versions(spark, path).where(F.col("version") == version).select("rows").first()["rows"]
    return Dictionary(read(spark, path, version), rows, broadcast_rows)
