"""Tumbling event-time windows: value counts, then one result row per window and device type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.event_time import minute_label
from tidegauge.functions.numeric import (
    ORDINARY,
    exact_sum,
    float_sum,
    mean_of_ranges,
    mean_of_sums,
    number_range,
    round2,
)
from tidegauge.operators.median import weighted_median
from tidegauge.schemas import AGGREGATE_SCHEMA, MAX_OUT_OF_ORDER, WINDOW_SIZE
from tidegauge.session import written

GROUP = ["window_start", "window_end", "device_type"]


def with_watermark(events: DataFrame, delay: str = MAX_OUT_OF_ORDER) -> DataFrame:
    """Declare the event-time column and how far events may be out of order."""
    return events.withWatermark("event_time", delay)


def tumbling(events: DataFrame, size: str, *aggregates: Column, keys: tuple = ("device_type",)) -> DataFrame:
    """Any aggregates per epoch-aligned window ``[start, end)`` and key, as columns of the result.

    For aggregates with a bounded buffer; the exact median goes through :func:`value_counts`.
    """
    grouped = events.groupBy(F.window("event_time", size), *keys).agg(*aggregates)
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c != "window"],
    )


def value_counts(events: DataFrame, size: str = WINDOW_SIZE) -> DataFrame:
    """How often each humidity occurs per window and type, with its share of the temperature sum.

    The only shuffle that sees the events. Map-side aggregation folds copies before it, and the
    humidity in the key spreads a hot (window, type) over all tasks. Also the streaming state: it
    grows with distinct values, not with events. Temperatures out of the ordinary range of magnitude
    (``range``) are summed in rows of their own.
    """
    return tumbling(
        events.withColumn("range", number_range(F.col("temperature"))),
        size,
        F.count("*").alias("n"),
        exact_sum(F.col("temperature")).alias("exact_sum"),
        float_sum(F.col("temperature")).alias("float_sum"),
        keys=("device_type", "humidity", "range"),
    )


def window_means(events: DataFrame, size: str = WINDOW_SIZE) -> DataFrame:
    """Number of events and mean temperature per window and type: the exact sum, rounded once, by the number.

    Two aggregations, the second over one row for each range of magnitude of a group. No row order or
    partitioning changes the result.
    """
    ranges = tumbling(
        events.withColumn("range", number_range(F.col("temperature"))),
        size,
        exact_sum(F.col("temperature")).alias("exact_sum"),
        float_sum(F.col("temperature")).alias("float_sum"),
        F.count("*").alias("events"),
        keys=("device_type", "range"),
    )
    parts = ranges.groupBy(*GROUP).agg(
        _by_range().alias("ranges"), F.sum("float_sum").alias("float_sum"), F.sum("events").alias("events")
    )
    mean = mean_of_ranges(F.col("ranges"), F.col("float_sum"), F.col("events"))
    return parts.select(*GROUP, "events", mean.alias("avg_temperature"))


def _by_range() -> Column:
    return F.collect_list(F.struct("range", "exact_sum"))


def stats_from_counts(
    counts: DataFrame,
    keep: Callable[[DataFrame], DataFrame] = written,
    **limits: int,
) -> DataFrame:
    """Mean temperature and exact median humidity per group, not rounded.

    ``counts`` is read more than once, so it must be a table or persisted. ``limits`` are those of
    :func:`~tidegauge.operators.median.weighted_median`.
    """
    result = weighted_median(
        counts, GROUP, "humidity", "n", sums=("exact_sum", "float_sum"), keep=keep, **limits
    )
    mean = mean_of_sums(F.col("exact_sum"), F.col("float_sum"), F.col("n"))
    if (counts.agg(F.max("range")).first()[0] or ORDINARY) != ORDINARY:
        # At most one row for each range of magnitude of a group.
        ranges = counts.groupBy(*GROUP, "range").agg(F.sum("exact_sum").alias("exact_sum"))
        ranges = ranges.groupBy(*[F.col(k).alias(f"_{k}") for k in GROUP]).agg(_by_range().alias("ranges"))
        result = result.join(ranges, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in GROUP])
        mean = mean_of_ranges(F.col("ranges"), F.col("float_sum"), F.col("n"))
    return result.select(
        *GROUP, F.col("n").alias("events"), mean.alias("avg_temperature"), F.col("median").alias("median_humidity")
    )


def window_stats(events: DataFrame, size: str = WINDOW_SIZE, **limits: int) -> DataFrame:
    """Batch statistics of enriched events, not rounded. Runs the job that writes the counts."""
    return stats_from_counts(written(value_counts(events, size)), **limits)


def aggregate_rows(stats: DataFrame) -> DataFrame:
    """The five output columns: window labels without date, values rounded to two decimals.

    Labels come last: windows of different days share a label but stay separate rows.
    """
    return stats.select(
        minute_label(F.col("window_start")).alias("window_start"),
        minute_label(F.col("window_end")).alias("window_end"),
        "device_type",
        round2(F.col("avg_temperature")).alias("avg_temperature"),
        round2(F.col("median_humidity")).alias("median_humidity"),
    ).to(AGGREGATE_SCHEMA)
