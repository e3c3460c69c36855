"""Two-pass external shuffle into shards.

Pass 1 scatters the records over buckets small enough for a task's memory, by seeded hashes. Pass 2
permutes every bucket (Fisher-Yates with a generator seeded by bucket) and writes it. A record's
shard follows from its key and the number of shards alone (rendezvous hashing): with one more shard,
records move only into that one.

Defined cases: equal or null keys share a shard, and equal records are spread over its buckets like
any others; an empty table gives no rows; the record is kept in a struct, so no column can clash.
A key that many rows share makes its shard larger, as the law demands, but never a bucket: records
are dealt to buckets by row number, not by key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import written

#: Bytes a bucket may hold on average, and the fewest buckets of a shard.
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 4
#: The rows before each bucket are broadcast up to this number of buckets.
BROADCAST_BUCKETS = 100_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose hash with ``key`` is highest."""
    weights = [F.struct(F.xxhash64(F.lit(seed), F.lit(k), key).alias("weight"), F.lit(k).alias("k")) for k in range(shards)]
    return F.array_max(F.array(*weights))["k"]


def _permuted(bucket: pa.Table, seed: int) -> pa.RecordBatch:
    shard, number = bucket["shard"][0].as_py(), bucket["bucket"][0].as_py()
    order = np.random.default_rng([seed, shard, number]).permutation(bucket.num_rows)
    out = bucket.take(pa.array(order)).drop_columns(["row"])
    out = out.append_column("position", pa.array(np.arange(bucket.num_rows, dtype=np.int64)))
    return out.combine_chunks().to_batches()[0]


def _bucket_shuffler(seed: int):
    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            shard, bucket = rows["shard"].to_numpy(), rows["bucket"].to_numpy()
            ends = [*(np.flatnonzero((np.diff(shard) != 0) | (np.diff(bucket) != 0)) + 1), batch.num_rows]
            start = 0
            for end in ends:
                part = rows.slice(start, end - start)
                if held and (held[0]["shard"][0], held[0]["bucket"][0]) != (part["shard"][0], part["bucket"][0]):
                    yield _permuted(pa.concat_tables(held), seed)
                    held = []
                held.append(part)
                start = end
        if held:
            yield _permuted(pa.concat_tables(held), seed)

    return shuffle


def shuffle_shards(
    records: DataFrame, key: str, size: Column, shards: int = 8, seed: int = 20, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All ``records`` in shuffled order: ``shard``, ``bucket``, ``slot`` (gapless in the shard), ``record``.

    ``size`` gives a record's bytes. The shuffled buckets are written to the shared folder.
    """
    total = records.select(F.sum(size)).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // (shards * bucket_bytes)))
    row = F.monotonically_increasing_id()
    dealt = records.select(
        shard_of(F.col(key), shards, seed).alias("shard"),
        row.alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record"),
    ).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(buckets)))
    scattered = dealt.repartition(shards * buckets, "shard", "bucket").sortWithinPartitions("shard", "bucket", "row")
    schema = scattered.drop("row").schema.add("position", "long")
    shuffled = written(scattered.mapInArrow(_bucket_shuffler(seed), schema))

    counts = shuffled.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if shards * buckets <= BROADCAST_BUCKETS:
        bases = F.broadcast(bases)
    slot = (F.col("base") + F.col("position")).alias("slot")
    return shuffled.join(bases, ["shard", "bucket"]).select("shard", "bucket", slot, "record")
