import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import embeddings, hnsw, queries

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def brute_force(rows):
    """Per vec_id: links and smallest number reachable."""
    units = []
    for _, vector, label in rows:
        good = vector and label is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        own = np.array(vector, np.float32).astype(float) if good else None
        units.append((label, own / np.linalg.norm(own)) if good else None)
    links = [[] for _ in rows]
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a and b and a[0] == b[0] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= 0.98:
                links[i].append(j)
    out = []
    for i in range(len(rows)):
        seen, ahead = {i}, [i]
        while ahead:
            new = set(links[ahead.pop()]) - seen
            seen |= new
            ahead += new
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=repr)


def result(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)


def clustered(draw, clusters=25, width=16):
    rows = []
    for _ in range(clusters):
        centre, label = draw.normal(size=width), int(draw.integers(0, 3))
        for _ in range(int(draw.integers(1, 40))):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + draw.normal(size=width) * 0.08], label))
    return rows


@pytest.mark.parametrize("shard", [8192, 60])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(embeddings, "SHARD_VECTORS", shard)
    rows = clustered(np.random.default_rng(8))
    expected, got = brute_force(rows), result(spark, rows)
    wanted, found = sum(r[1] for r in expected), sum(r[1] for r in got)
    assert wanted > 1000 and 0.98 * wanted <= found <= wanted
    assert [r[::2] for r in got] == [r[::2] for r in expected]


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, nan], 1), (5, [1.0, inf], 1), (6, [1.0, None], 1),
        (7, [1.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1),
        (12, [1e-30, 0.0], 1), (13, [3e38, 0.0], 1), (7, [1.0, 0.0], 1), (None, [1.0, 0.0], 2), (14, [-1.0, 0.0], 1),
    ]
    assert result(spark, rows) == brute_force(rows)
    assert result(spark, []) == []
    wide = [(1, [1.0], 1, 5, "x"), (2, [1.0], 1, 5, "x")]
    assert result(spark, wide, SCHEMA + ", row INT, part STRING") == [(1, 1, 1, True), (2, 1, 1, False)]


def test_the_beam_widens_until_the_audit_passes():
    draw = np.random.default_rng(9)
    vectors = np.repeat(draw.normal(size=(60, 12)), 10, 0) + draw.normal(size=(600, 12)) * 0.03
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = hnsw.Graph(vectors)
    beam, found, real = embeddings.audited_beam(index, vectors[::10])
    similar = vectors @ vectors.T >= 0.98
    assert real == similar[::10].sum() and found >= embeddings.RECALL * real
    np.fill_diagonal(similar, False)
    met = embeddings.links_inside(index, beam)
    assert met.sum() >= 0.99 * similar.sum() and not (met & ~similar).any() and (met == met.T).all()


class Poor:
    """A graph whose beams find everything only from 96 on; narrower ones lose what ``lost`` says."""

    def __init__(self, vectors, lost):
        self.vectors, self.lost = vectors, lost

    def similar(self, query, least, beam, known=None):
        every = np.flatnonzero(self.vectors @ query >= least)
        if beam < 96 and self.lost(every):
            return every[:0] if known is None else np.array([known])
        return every


def units(draw, n, width):
    vectors = draw.normal(size=(n, width))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def test_an_audit_without_links_is_passed_by_vectors_that_find_themselves():
    draw = np.random.default_rng(10)
    vectors, queries_ = units(draw, 1500, 48), units(draw, 64, 48)
    assert embeddings.audited_beam(Poor(vectors, lambda every: False), queries_) == (embeddings.BEAM, 0, 0)
    assert embeddings.audited_beam(Poor(vectors, lambda every: True), queries_) == (96, 0, 0)
    assert embeddings.audited_beam(hnsw.Graph(vectors[:1]), queries_[:0])[1:] == (0, 0)


def test_easy_hits_do_not_pass_the_audit():
    """One large group is found, but of the other vectors' links only a part."""
    draw = np.random.default_rng(11)
    vectors = np.concatenate([np.tile(units(draw, 1, 16), (700, 1)), np.repeat(units(draw, 300, 16), 2, 0)])
    poor = Poor(vectors, lambda every: len(every) == 2 and every[0] % 4 == 0)
    beam, found, real = embeddings.audited_beam(poor, vectors[::10])
    assert beam == 96 and found == real == (vectors[::10] @ vectors.T >= 0.98).sum()


def test_links_are_those_of_the_walks(spark, monkeypatch):
    """Graphs that find nothing leave only copies linked: no brute force answers for them."""
    rows = clustered(np.random.default_rng(12), 10)
    rows.append((len(rows), *rows[0][1:]))
    monkeypatch.setattr(hnsw.Graph, "similar", lambda self, query, least, beam, known=None: np.zeros(0, np.int64))
    got = result(spark, rows)
    assert [r[0] for r in got if r[1]] == sorted([0, len(rows) - 1]) and all(r[1] <= 1 for r in got)
    assert sum(r[2] != r[0] for r in got) == 1


def test_shards_meet_once(spark, monkeypatch):
    """Few vectors of many shards, one to seven of them by label, some of them empty."""
    monkeypatch.setattr(embeddings, "SHARD_VECTORS", 3)
    monkeypatch.setattr(embeddings, "ASKING", 2)
    draw = np.random.default_rng(13)
    rows = []
    for label, n in enumerate([1, 3, 5, 8, 10, 14, 17, 20]):
        centre = draw.normal(size=8)
        for _ in range(n):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + draw.normal(size=8) * 0.1], label))
            if len(rows) % 3 == 0:
                rows.append((len(rows), *rows[-1][1:]))
    expected = brute_force(rows)
    assert sum(r[1] for r in expected) > 50 and result(spark, rows) == expected


def test_many_copies_count_each_other(spark):
    rows = [(i, [1.0, 0.5], 1) for i in range(3000)] + [(5000, [1.0, 0.51], 1), (5001, [-1.0, 0.5], 1), (None, [1.0, 0.5], 1)]
    got = {r[0]: r[1:] for r in result(spark, rows)}
    assert len(got) == 3003
    assert got[0] == (3001, 0, True) and got[2999] == (3001, 0, False) and got[None] == (3001, 0, False)
    assert got[5000] == (3001, 0, False) and got[5001] == (0, 5001, True)


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected = brute_force(rows)
    got = sorted((tuple(r) for r in queries.op7_vectors(spark, folder).collect()), key=repr)
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert all(g[1] <= e[1] for g, e in zip(got, expected))
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in expected)


def test_recall_over_several_shards(spark, monkeypatch):
    """The table's vectors, which have no links of their own, as one label, each with one or two near copies."""
    monkeypatch.setattr(embeddings, "SHARD_VECTORS", 1000)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    vectors = np.array([r[0] for r in table], np.float32)
    draw = np.random.default_rng(14)
    size = np.abs(vectors).mean() * 0.12
    near = [vectors, vectors + draw.normal(size=vectors.shape) * size, (vectors + draw.normal(size=vectors.shape) * size)[::2]]
    vectors = np.concatenate(near).astype(np.float32)
    units_ = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    similar = units_ @ units_.T >= 0.98
    np.fill_diagonal(similar, False)
    frame = spark.createDataFrame([(i, x, 1) for i, x in enumerate(vectors.tolist())], SCHEMA)
    got = embeddings.near_duplicates(frame).agg(F.sum("n_links")).first()[0]
    print("links", similar.sum(), "found", got)
    assert similar.sum() > 2000 and 0.99 * similar.sum() <= got <= similar.sum()
