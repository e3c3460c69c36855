"""The device type dictionary: load once, check, freeze; replace."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schemas import DEVICE_TYPES, DICTIONARY_SCHEMA, TYPE_NAME_LENGTH
from tidegauge.session import written

# With names of at most 100 characters (400 bytes) this many rows stay below 10 MB.
BROADCAST_ROWS = 20_000
TABLE = "device_types"


@dataclass(frozen=True)
class Dictionary:
    """A frozen copy of the dictionary; later changes of its source are not seen."""

    frame: DataFrame
    rows: int
    broadcast_rows: int = BROADCAST_ROWS

    @property
    def is_broadcastable(self) -> bool:
        return self.rows <= self.broadcast_rows


def _per_id(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(
        F.count("*").alias("copies"),
        F.count_if(F.col("type_name").isNull()).alias("nameless"),
        F.count_if(F.length("type_name") > TYPE_NAME_LENGTH).alias("too_long"),
    )


def problems(source: DataFrame) -> DataFrame:
    """Why ``source`` would be refused: ``id``, ``problem``, and the ``rows`` that have it; no rows if it would not."""
    rows = {
        "null id": F.when(F.col("id").isNull(), F.col("copies")),
        "repeated id": F.when(F.col("id").isNotNull() & (F.col("copies") > 1), F.col("copies")),
        "null name": F.col("nameless"),
        "name over 100 characters": F.col("too_long"),
    }
    told = [F.struct(F.lit(problem).alias("problem"), n.alias("rows")) for problem, n in rows.items()]
    found = F.filter(F.array(*told), lambda x: x["rows"] > 0)
    return _per_id(source.select(*_columns())).select("id", F.inline(found))


def _check(df: DataFrame) -> int:
    per_id = _per_id(df)
    found = per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count_if(F.col("id").isNull()).alias("null ids"),
        F.count_if(F.col("copies") > 1).alias("repeated ids"),
        F.coalesce(F.sum("nameless"), F.lit(0)).alias("null names"),
        F.coalesce(F.sum("too_long"), F.lit(0)).alias("names over 100 characters"),
    ).first()
    problems = {name: n for name, n in found.asDict().items() if name != "rows" and n}
    if problems:
        raise ValueError(f"dictionary refused: {problems}")
    return found["rows"]


def _columns() -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in DICTIONARY_SCHEMA]


def _copy(source: DataFrame) -> DataFrame:
    """The dictionary's columns in their types, computed once: what is checked is what is used."""
    return written(source.select(*_columns()))


def checked_copy(source: DataFrame) -> tuple[DataFrame, int]:
    """A copy of ``source`` that has passed the checks of a dictionary, and its number of rows."""
    copy = _copy(source)
    return copy, _check(copy)


def snapshot(source: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> Dictionary:
    """Read ``source`` once, write the copy to the shared folder and check it.

    A plain stream-static join would read a database table again in every micro-batch. Ids must be
    unique, otherwise the lookup would multiply events.
    """
    frame = _copy(source)
    return Dictionary(frame, _check(frame), broadcast_rows)


def read_jdbc(spark: SparkSession, url: str, table: str = TABLE, properties: dict | None = None) -> DataFrame:
    """Two columns of a database table; credentials come from the caller's ``properties``."""
    return spark.read.jdbc(url, table, properties=properties or {}).select("id", "type_name")


def replace_jdbc(df: DataFrame, url: str, table: str = TABLE, properties: dict | None = None) -> None:
    """Drop and recreate the database table with these rows.

    Spark names column types but no key or NOT NULL; rows are checked for both before they are written.
    """
    checked = _copy(df)
    _check(checked)
    (
        checked.write.mode("overwrite")
        .option("truncate", "false")
        .option("createTableColumnTypes", f"id INT, type_name VARCHAR({TYPE_NAME_LENGTH})")
        .jdbc(url, table, properties=properties or {})
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary kept as Parquet files."""
    return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the Parquet dictionary with these rows."""
    checked = _copy(df)
    _check(checked)
    checked.write.mode("overwrite").parquet(path)


def default_device_types(spark: SparkSession) -> DataFrame:
    """The five standard device types."""
    return spark.createDataFrame(DEVICE_TYPES, DICTIONARY_SCHEMA)
