"""Exact median from value counts, for groups of any size."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import written

# Distinct values of one group that one task sorts (the sort spills). Groups with more are split.
LARGE_GROUP = 500_000
# Rows of a value range, the share of a split group that one task sorts.
RANGE_ROWS = 500_000
# Group keys up to this many are small enough to broadcast.
BROADCAST_GROUPS = 100_000


def weighted_median(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    n: str,
    sums: Sequence[str] = (),
    keep: Callable[[DataFrame], DataFrame] = written,
    large_group: int = LARGE_GROUP,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per group: ``keys``, total ``n``, the totals of ``sums`` and the exact ``median``.

    ``counts`` holds each value once per group with its frequency ``n``, and must be cheap to read
    several times. A group of up to ``large_group`` values is sorted in one task. Larger groups,
    found by counting first, are split over tasks by value range; nothing is left out.
    """
    if counts.count() <= large_group:
        return _sorted_groups(counts, keys, value, n, sums)
    sizes = counts.groupBy(*keys).agg(F.count("*").alias("values")).where(F.col("values") > large_group)
    sizes = keep(sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], "values"))
    found = sizes.agg(F.count("*").alias("groups"), F.sum("values").alias("rows")).first()
    if not found["groups"]:
        return _sorted_groups(counts, keys, value, n, sums)
    small_enough = F.broadcast if found["groups"] <= BROADCAST_GROUPS else lambda df: df
    large = small_enough(sizes.drop("values"))
    same_group = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    small = counts.join(large, same_group, "left_anti")
    big = counts.join(large, same_group, "left_semi")
    tasks = math.ceil(found["rows"] / range_rows)
    return _sorted_groups(small, keys, value, n, sums).unionByName(
        _split_groups(big, keys, value, n, sums, keep, tasks, small_enough)
    )


def _lower(total: str) -> Column:
    """0-based rank of the lower middle row."""
    return F.call_function("div", F.col(total) - 1, F.lit(2))


def _upper(total: str) -> Column:
    """0-based rank of the upper middle row; the lower one again when the total is odd."""
    return F.call_function("div", F.col(total), F.lit(2))


def _holds(rank: Column, end: str, n: str) -> Column:
    """Whether the ``n`` rows that end before rank ``end`` include ``rank``."""
    return (rank < F.col(end)) & (rank >= F.col(end) - F.col(n))


def _median(value: str, end: str, n: str, total: str) -> Column:
    lower = F.max(F.when(_holds(_lower(total), end, n), F.col(value)))
    upper = F.max(F.when(_holds(_upper(total), end, n), F.col(value)))
    # The middle element itself if there is one: adding it to itself could overflow.
    odd = F.first(F.col(total)) % 2 == 1
    return F.when(odd, lower).otherwise((lower + upper) / 2)


def _sorted_groups(counts, keys, value, n, sums) -> DataFrame:
    """One shuffle by group and one sort; the final aggregation finds its rows in place."""
    group = Window.partitionBy(*keys)
    so_far = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"_end": F.sum(n).over(so_far), "_total": F.sum(n).over(group)})
    return ranked.groupBy(*keys).agg(
        F.sum(n).alias(n), *[F.sum(s).alias(s) for s in sums], _median(value, "_end", n, "_total").alias("median")
    )


def _split_groups(counts, keys, value, n, sums, keep, tasks, small_enough) -> DataFrame:
    # Ranges of equal size over (group, value): a large group covers several, in value order.
    ranges = keep(counts.repartitionByRange(tasks, *keys, value).withColumn("_range", F.spark_partition_id()))
    # One row per group and range, so few that a group fits one task whatever its size.
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranges.groupBy(*keys, "_range")
        .agg(F.sum(n).alias("_n"), *[F.sum(s).alias(s) for s in sums])
        .withColumns({
            "_end": F.sum("_n").over(so_far),
            "_total": F.sum("_n").over(group),
            **{s: F.sum(s).over(group) for s in sums},
        })
    )
    # The one or two ranges with the middle rows, and how many rows lie before them.
    middle = placed.where(_holds(_lower("_total"), "_end", "_n") | _holds(_upper("_total"), "_end", "_n")).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("_range").alias("_middle"),
        (F.col("_end") - F.col("_n")).alias("_before"),
        "_total",
        *sums,
    )
    in_middle = ranges.drop(*sums).join(
        small_enough(middle),  # at most two rows per group
        [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_range") == F.col("_middle")],
    )
    within = Window.partitionBy(*keys, "_range").orderBy(value)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        in_middle.withColumn("_rank_end", F.col("_before") + F.sum(n).over(so_far))
        .groupBy(*keys)
        .agg(
            _median(value, "_rank_end", n, "_total").alias("median"),
            F.first("_total").alias(n),
            *[F.first(s).alias(s) for s in sums],
        )
        .select(*keys, n, *sums, "median")
    )
