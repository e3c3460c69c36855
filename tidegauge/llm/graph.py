"""Connected components of a table of links, by Spark jobs only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import written


def spanning_stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each node of ``links`` with the smallest node it is connected to, that node left out."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := parent.setdefault(top, top)) != top:
            top = above
        while (above := parent[x]) != top:
            parent[x], x = top, above
        return top

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [(x, r) for x in list(parent) if (r := root(x)) != x]


#: Rows of a file of a compact table.
FILE_ROWS = 1_000_000


def compact(df: DataFrame) -> DataFrame:
    """``df`` as a table of few files in the shared folder, however many tasks made it.

    The rows are held by the executors until they are counted and written; what is lost meanwhile is made again.
    """
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        return written(held.coalesce(held.count() // FILE_ROWS + 1))
    finally:
        held.unpersist()


#: Links a task gathers before it passes their forest on.
GATHERED = 500_000
#: Links of all forests that one task contracts.
AT_ONCE = GATHERED


def _forest(links: list[tuple[int, int]]) -> pa.RecordBatch:
    stars = spanning_stars(links)
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in stars], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for batch in batches:
        held += zip(batch["a"].to_pylist(), batch["b"].to_pylist())
        if len(held) >= GATHERED:
            held = spanning_stars(held)
            if len(held) >= GATHERED // 2:
                yield _forest(held)
                held = []
    yield _forest(held)


def _fingerprint(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _with_least(links: DataFrame) -> DataFrame:
    """``links`` with the smallest neighbour ``least`` of their node ``a`` (a hot node's links are split by the join)."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least, "a")


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected to, for every node of ``links`` (a, b).

    Links are contracted task by task first. If at most ``AT_ONCE`` are left, one task contracts those.
    Beyond that, large and small stars alternate until nothing
    changes: each hangs a node's neighbours on the smallest of them, so that the number of rounds
    grows with the logarithm of the longest path, and no task ever holds a node's links together.

    After ``rounds`` rounds, if given, the work ends: nodes of one component are then connected, but
    connected nodes may be in several.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = compact(links.mapInArrow(_contract, "a long, b long"))
    if links.count() <= AT_ONCE:
        return _with_roots(written(links.coalesce(1).mapInArrow(_contract, "a long, b long")))
    links = links.distinct()
    seen = None if rounds else _fingerprint(links)
    done = 0
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).where("b > a").select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
        small = _with_least(large.distinct())
        # A node's smaller neighbours and the node itself hang on the smallest of them.
        small = small.select(F.col("a"), F.col("least").alias("b")).unionByName(
            small.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        )
        done += 1
        if done == rounds:
            ends = small.unionByName(small.select(F.col("b").alias("a"), "b"))
            return ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        links = compact(small.distinct())
        if rounds:
            continue
        now = _fingerprint(links)
        if now == seen:
            return _with_roots(links)
        seen = now


def _with_roots(stars: DataFrame) -> DataFrame:
    """Nodes and components of finished stars, the roots among the nodes."""
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
