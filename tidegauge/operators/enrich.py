"""Look up the device type name of each event in the dictionary snapshot."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.schemas import UNKNOWN_TYPE
from tidegauge.sources.dictionary import Dictionary

# An id is hot if it is that of so large a share of the events; there are at most as many hot ids as that allows.
HOT_SHARE = 1 / 64
# Ids the sketch keeps track of: an id of a hot share cannot be missed.
TRACKED = 4096
# Keys over which the events of hot ids are spread, from a number on that no id reaches.
BEYOND_IDS, SPREAD = 1 << 40, 1 << 20


def hot_ids(events: DataFrame) -> list[int]:
    """The device type ids that many events of a batch have, by a sketch of bounded size that every task adds to."""
    most = round(1 / HOT_SHARE)
    sketch = F.call_function("approx_top_k", "device_type_id", F.lit(most), F.lit(TRACKED))
    found = events.where("device_type_id IS NOT NULL").agg(F.count("*").alias("n"), sketch.alias("top")).first()
    return sorted(item["item"] for item in found["top"] or [] if item["count"] >= HOT_SHARE * found["n"])


def enrich(events: DataFrame, dictionary: Dictionary, hot: Sequence[int] = ()) -> DataFrame:
    """Left join on the id: one output row per event, ``device_type`` never null.

    A dictionary whose counted size allows it is broadcast, so events are not shuffled. A larger
    one is joined by shuffle, but for the entries of ``hot`` ids (:func:`hot_ids`), which are few: they are broadcast, and the
    events that need no other entry are spread evenly. In batch, adaptive execution splits the events of hot ids
    without being told; a stream has no such help, and takes them from the batch (:mod:`tidegauge.streaming.refreshed`)
    or from its user.
    """
    entries = dictionary.frame.select(F.col("id").alias("device_type_id"), "type_name")
    if dictionary.is_broadcastable:
        joined = events.join(F.broadcast(entries), "device_type_id", "left")
    elif not hot:
        joined = events.join(entries.hint("merge"), "device_type_id", "left")
    else:
        known = F.broadcast(entries.where(F.col("device_type_id").isin(*hot)).withColumnRenamed("type_name", "_hot_name"))
        # Keys beyond all ids, so that they meet no entry. Seeded, so that a retried task spreads its rows as before.
        spread = BEYOND_IDS + F.floor(F.rand(seed=1) * SPREAD)
        apart = F.col("device_type_id").isNull() | F.col("device_type_id").isin(*hot)
        told = events.join(known, "device_type_id", "left")
        told = told.withColumn("_key", F.when(apart, spread).otherwise(F.col("device_type_id").cast("long")))
        others = entries.select(F.col("device_type_id").cast("long").alias("_key"), "type_name").hint("merge")
        joined = told.join(others, "_key", "left")
        joined = joined.withColumn("type_name", F.coalesce("_hot_name", "type_name"))
    return joined.select(
        F.coalesce("type_name", F.lit(UNKNOWN_TYPE)).alias("device_type"),
        "event_time",
        "temperature",
        "humidity",
    )
