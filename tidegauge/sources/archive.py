"""A topic kept as a table: records with partition and offset, read from and up to any position.

Records lie in folders by partition and by block of ``BLOCK`` offsets, so that a range of offsets is a choice of
folders: each partition is read from its own start to its own end, and what lies outside is not listed, let alone
opened. Inside the first and last block the offsets are compared.

Defined cases: a start is inclusive and an end exclusive; -2 is the earliest and -1 the latest position, as in the
options of a topic read; partitions that are not named begin at the earliest and end at the latest; positions beyond
what is there give what is there; offsets may have gaps; keys, values and timestamps may be null; a record without
partition or offset is refused when it is written.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1_000_000
EARLIEST, LATEST = -2, -1
SCHEMA = "key BINARY, value BINARY, offset LONG, timestamp TIMESTAMP, partition INT, first_offset LONG"

Positions = str | Mapping[int, int]


def append(records: DataFrame, path: str) -> None:
    """Add ``records`` (key, value, partition, offset, timestamp) to the table."""
    placed = records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        _present("offset").cast("long").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        _present("partition").cast("int").alias("partition"),
        (F.floor(F.col("offset") / BLOCK) * BLOCK).cast("long").alias("first_offset"),
    )
    # A block is one file; sorted, so that the statistics of its row groups tell offsets apart.
    placed = placed.repartition("partition", "first_offset").sortWithinPartitions("partition", "first_offset", "offset")
    placed.write.mode("append").partitionBy("partition", "first_offset").parquet(path)


def _present(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"record without {name}")))


def _named(positions: Positions, default: int) -> dict[int, int]:
    """Offsets by partition; ``default`` and what stands for it left out."""
    if isinstance(positions, str):
        known = {"earliest": EARLIEST, "latest": LATEST}
        if known.get(positions) != default:
            raise ValueError(f"no such position here: {positions}")
        return {}
    wrong = {p: o for p, o in positions.items() if o < 0 and o != default}
    if wrong:
        raise ValueError(f"no such position here: {wrong}")
    return {p: o for p, o in positions.items() if o != default}


def between(starting: Positions = "earliest", ending: Positions = "latest") -> Column | None:
    """The condition on ``partition``, ``first_offset`` and ``offset``, or none if all is wanted."""
    starts, ends = _named(starting, EARLIEST), _named(ending, LATEST)
    named = sorted({*starts, *ends})
    if not named:
        return None
    offset, block, partition = F.col("offset"), F.col("first_offset"), F.col("partition")
    ranges = [~partition.isin(named)]
    for p in named:
        own = partition == p
        if p in starts:
            own &= (block > starts[p] - BLOCK) & (offset >= starts[p])
        if p in ends:
            own &= (block < ends[p]) & (offset < ends[p])
        ranges.append(own)
    return reduce(or_, ranges)


def _chosen(records: DataFrame, starting: Positions, ending: Positions) -> DataFrame:
    condition = between(starting, ending)
    return (records if condition is None else records.where(condition)).drop("first_offset")


def read(spark: SparkSession, path: str, starting: Positions = "earliest", ending: Positions = "latest") -> DataFrame:
    """The records from the positions of ``starting`` up to those of ``ending``."""
    return _chosen(spark.read.schema(SCHEMA).parquet(path), starting, ending)


def stream(spark: SparkSession, path: str, starting: Positions = "earliest", **options: str) -> DataFrame:
    """The records from the positions of ``starting`` on, and those that are appended later, as a stream."""
    return _chosen(spark.readStream.schema(SCHEMA).options(**options).parquet(path), starting, "latest")


def positions_at(spark: SparkSession, path: str, millis: int) -> dict[int, int]:
    """By partition, the offset of its first record that is not older than a time; behind its last one if all are."""
    first = F.min(F.when(F.unix_millis("timestamp") >= millis, F.col("offset")))
    # One row for a partition.
    rows = spark.read.schema(SCHEMA).parquet(path).groupBy("partition").agg(
        F.coalesce(first, F.max("offset") + 1).alias("offset")
    )
    return {r.partition: r.offset for r in rows.collect()}
