"""Near-duplicate vectors of one label, found in navigable small-world graphs.

Equal vectors of a label are counted as one first. The distinct vectors of a label are dealt to shards, each
shard's graph is built once and written, and every vector walks its own shard's graph and, of every two shards,
the vectors of one walk the graph of the other. How wide the beams of a label are is settled by an audit: all
links of a sample of its vectors (about ``AUDITED``) are computed by brute force in every shard, and the beam
doubles until walks find ``RECALL`` of them, over all and on average of a sampled vector that has any, and
also find as many of the shard's own vectors when they start where any other walk starts. The widest beam that a shard asks for
is the label's. The sample's links serve the audit only: all links that are returned were walked to. They are
verified by cosine in double precision and never leave the task: what does is a count for each vector and a spanning forest, from
which components follow by Spark jobs. A graph is sent to a task with the vectors that walk it, which pass as a stream.

Defined cases: vectors that are null, zero, or hold null or non-finite numbers, and those with a null
label, link with nothing; vectors of different lengths do not link; repeated rows are vectors of
their own, also under one number; a null number is kept, and never the smallest of a component; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import graph, hnsw
from tidegauge.session import written

LEAST = 0.98
SHARD_VECTORS = 8192
BEAM = 24
RECALL = 0.995
#: Vectors of a label whose links are computed by brute force, about; and vectors of a shard that must find themselves.
AUDITED = 64
#: Shards whose vectors walk a graph in one task.
ASKING = 16

_KEYS = ("label", "width", "shard", "chunk")


def _unit(values: pa.ListArray, width: int) -> np.ndarray:
    flat = np.asarray(values.flatten().cast(pa.float64()), np.float64).reshape(-1, width)
    # Scaled first, lest squares overflow or vanish.
    flat = flat / np.abs(flat).max(1, keepdims=True)
    return flat / np.sqrt((flat**2).sum(1, keepdims=True))


def _build(shard: pa.Table) -> pa.Table:
    shard = shard.sort_by("row")
    vectors = _unit(shard["vector"].combine_chunks(), shard["width"][0].as_py())
    built = hnsw.Graph(vectors)
    parts = (shard["row"].to_numpy(), shard["copies"].to_numpy(), vectors, built.tables, built.entry, built.top)
    blob = pa.array([pickle.dumps(parts, protocol=5)], pa.binary())
    return shard.select(["label", "width", "shard"]).slice(0, 1).append_column("graph", blob)


def enough(found: list[int], real: list[int]) -> bool:
    """Whether of ``real`` links by vector enough are ``found``, over all and on average."""
    hits, all_ = np.array(found, float), np.array(real, float)
    return not len(all_) or bool(hits.sum() >= RECALL * all_.sum() and (hits / all_).mean() >= RECALL)


def audited_beam(index: hnsw.Graph, queries: np.ndarray, least: float = LEAST) -> tuple[int, int, int]:
    """The beam with which walks of ``queries`` and of vectors of the index itself find enough; links found with it, and links there are.

    The only brute force there is: all links of ``queries``. A vector of the index has itself to find.
    """
    truth = [np.flatnonzero(similar) for similar in queries @ index.vectors.T >= least]
    real = [(q, t) for q, t in zip(queries, truth) if len(t)]
    n = len(index.vectors)
    own = np.random.default_rng(n).permutation(n)[:AUDITED].tolist()
    counts = [len(t) for _, t in real]
    beam = BEAM
    while True:
        found = [len(np.intersect1d(index.similar(q, least, beam), t)) for q, t in real]
        selves = [int(i in index.similar(index.vectors[i], least, beam)) for i in own]
        if beam >= n or (enough(found, counts) and enough(selves, [1] * len(own))):
            return beam, sum(found), sum(counts)
        beam *= 2


def links_inside(index: hnsw.Graph, beam: int, least: float = LEAST) -> np.ndarray:
    """Which vectors of the index link: a walk of either suffices. One byte for a pair, however many link."""
    n = len(index.vectors)
    met = np.zeros((n, n), bool)
    for i in range(n):
        met[i, index.similar(index.vectors[i], least, beam, i)] = True
    met |= met.T
    np.fill_diagonal(met, False)
    return met


def _reported(rows: np.ndarray, links: np.ndarray, roots: np.ndarray | None = None) -> pa.RecordBatch:
    roots = np.full(len(rows), -1) if roots is None else roots
    columns = [rows, roots, links]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["row", "root", "links"])


def _counts_and_forest(rows: np.ndarray, index_rows: np.ndarray, copies, index_copies, hits) -> Iterator[pa.RecordBatch]:
    """``hits`` gives for each of ``rows`` the places in the index it links with, each pair of rows once."""
    every, place = np.unique(np.concatenate([rows, index_rows]), return_inverse=True)
    own, other = place[: len(rows)], place[len(rows) :]
    part, links = np.arange(len(every)), np.zeros(len(every), np.int64)
    for i, places in enumerate(hits):
        if not len(places):
            continue
        links[own[i]] += index_copies[places].sum()
        links[other[places]] += copies[i]
        met = np.unique(np.append(part[other[places]], part[own[i]]))
        if len(met) > 1:
            part[np.isin(part, met[1:])] = met[0]
    linked, moved = np.flatnonzero(links), np.flatnonzero(part != np.arange(len(every)))
    yield _reported(every[linked], links[linked])
    yield _reported(every[moved], np.zeros(len(moved)), every[part[moved]])


class _Index:
    """The graph of a shard that came last, and the beam of its label."""

    def __init__(self, row: dict):
        self.rows, self.copies, *parts = pickle.loads(row["graph"])
        self.graph, self.beam = hnsw.restored(*parts), row["beam"]
        self.name = {k: row[k] for k in ("label", "width", "shard")}
        self.first = row["chunk"] == 0


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Index, pa.RecordBatch | None]]:
    """Every graph, then with it the stretches of vectors that follow it."""
    index = None
    for batch in batches:
        heads = np.flatnonzero(batch["graph"].is_valid().to_numpy(zero_copy_only=False)).tolist()
        starts = sorted({0, *heads, *(h + 1 for h in heads)})
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            if start in heads:
                index = _Index(batch.slice(start, 1).to_pylist()[0])
                yield index, None
            elif start < end:
                yield index, batch.slice(start, end - start)


def _audit(batches):
    def beam_of(index: _Index, vectors: list[np.ndarray]) -> pa.RecordBatch:
        width = index.graph.vectors.shape[1]
        beam, found, real = audited_beam(index.graph, np.concatenate([np.zeros((0, width)), *vectors]))
        return pa.RecordBatch.from_pylist([index.name | {"beam": beam, "found": found, "links": real}], _AUDIT)

    last, vectors = None, []
    for index, stretch in _streams(batches):
        if stretch is not None:
            vectors.append(_unit(stretch["vector"], index.name["width"]))
            continue
        if last:
            yield beam_of(last, vectors)
        last, vectors = index, []
    if last:
        yield beam_of(last, vectors)


_AUDIT = pa.schema(
    [("label", pa.string()), ("width", pa.int32()), ("shard", pa.int32()), ("beam", pa.int32()), ("found", pa.int64()), ("links", pa.int64())]
)


def _walk(batches):
    for index, stretch in _streams(batches):
        walked, rows, copies = index.graph, index.rows, index.copies
        if stretch is not None:
            vectors = _unit(stretch["vector"], index.name["width"])
            hits = (walked.similar(v, LEAST, index.beam) for v in vectors)
            yield from _counts_and_forest(stretch["row"].to_numpy(), rows, stretch["copies"].to_numpy(), copies, hits)
        elif index.first:  # its own vectors
            met = links_inside(walked, index.beam)
            hits = (i + 1 + np.flatnonzero(met[i, i + 1 :]) for i in range(len(rows)))
            yield from _counts_and_forest(rows, rows, copies, copies, hits)


def _with_graphs(graphs: DataFrame, asking: DataFrame) -> DataFrame:
    """Rows of ``asking`` behind the graph of their ``_KEYS``, in one partition; those without a graph left out."""
    asking = asking.join(graphs.select(*_KEYS), list(_KEYS), "left_semi")
    blank = {"row": F.lit(-1).cast("long"), "copies": F.lit(0).cast("long"), "vector": F.lit(None).cast("array<double>")}
    heads = graphs.withColumns(blank)
    vectors = asking.withColumns({"graph": F.lit(None).cast("binary"), "beam": F.lit(0)})
    partitions = max(1, graphs.count())
    return heads.unionByName(vectors).repartition(partitions, *_KEYS).sortWithinPartitions(*_KEYS, "row")


def audit(graphs: DataFrame, dealt: DataFrame) -> DataFrame:
    """Per graph the ``beam`` it asks for, and how many of the sample's ``links`` are ``found`` with it.

    ``dealt`` holds the vectors, with the ``vectors`` and ``shards`` of their label.
    """
    chosen = F.pmod(F.xxhash64(F.lit("audit"), "row"), F.greatest("vectors", F.lit(AUDITED))) < AUDITED
    sample = dealt.where(chosen).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    sample = sample.select("label", "width", F.col("shard").cast("int"), F.lit(0).alias("chunk"), "row", "copies", "vector")
    heads = graphs.withColumns({"chunk": F.lit(0), "beam": F.lit(0)})
    schema = "label string, width int, shard int, beam int, found long, links long"
    return _with_graphs(heads, sample).mapInArrow(_audit, schema)


def walks(graphs: DataFrame, dealt: DataFrame, beams: DataFrame) -> DataFrame:
    """``row``, ``root``, ``links``: counts of links (root -1), and edges of forests, of all walks.

    The vectors of a shard ask the next half of the shards, in a circle, so that every two shards meet once and
    every graph is asked as much. ``beams`` holds the ``beam`` and the ``shards`` of a label.
    """
    step, shards = F.col("step"), F.col("shards")
    steps = F.explode(F.sequence(F.lit(0), F.floor(shards / 2).cast("int"))).alias("step")
    meeting = (step > 0) & ((2 * step < shards) | (F.col("shard") < step))
    asking = dealt.select("*", steps).where(meeting).select(
        "label", "width", F.pmod(F.col("shard") + step, shards).cast("int").alias("shard"),
        F.floor(step / ASKING).cast("int").alias("chunk"), "row", "copies", "vector",
    )
    known = graphs.join(beams, ["label", "width"])
    chunks = F.explode(F.sequence(F.lit(0), F.floor(shards / 2 / ASKING).cast("int"))).alias("chunk")
    heads = known.select("label", "width", "shard", chunks, "graph", F.col("beam").cast("int"))
    return _with_graphs(heads, asking).mapInArrow(_walk, "row long, root long, links long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    numbers = F.col("embedding").cast("array<double>")
    usable = (
        F.col("label").isNotNull()
        & F.coalesce(F.size(numbers) > 0, F.lit(False))
        & F.forall(numbers, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists(numbers, lambda x: x != 0)
    )
    rows = written(
        vectors.select(
            "vec_id", F.col("label").cast("string").alias("label"), F.size("embedding").alias("width"),
            F.when(F.coalesce(usable, F.lit(False)), numbers).alias("vector"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    same = ["label", "width", "vector"]
    distinct = written(
        rows.where("vector is not null").groupBy(*same)
        .agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    )
    sizes = distinct.groupBy("label", "width").agg(F.count("*").alias("vectors"))
    sizes = sizes.withColumn("shards", F.ceil(F.col("vectors") / SHARD_VECTORS))
    shard = F.pmod(F.xxhash64("row"), F.col("shards")).cast("int").alias("shard")
    dealt = written(distinct.join(sizes, ["label", "width"]).select(*same, shard, "row", "copies", "vectors", "shards"))
    graphs = written(
        dealt.select(*same, "shard", "row", "copies").groupBy("label", "width", "shard")
        .applyInArrow(_build, "label string, width int, shard int, graph binary")
    )
    audited = written(audit(graphs, dealt))
    beams = audited.groupBy("label", "width").agg(F.max("beam").alias("beam")).join(sizes, ["label", "width"])
    met = written(walks(graphs, dealt, beams))
    counts = met.where("root < 0").groupBy("row").agg(F.sum("links").alias("links"))
    parts = graph.components(met.where("root >= 0").select(F.col("row").alias("a"), F.col("root").alias("b")))
    placed = distinct.join(counts, "row", "left").join(parts.withColumnRenamed("node", "row"), "row", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least", F.coalesce("component", "row").alias("part")
    )
    # Among distinct vectors; copies follow theirs.
    least = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    found = placed.join(least, "part").select(*same, "n_links", "component_id")
    alone = F.col("vector").isNull()
    return rows.join(found, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(alone, F.col("vec_id").isNotNull()).otherwise(F.col("vec_id") == F.col("component_id")), F.lit(False)).alias("kept"),
    )
