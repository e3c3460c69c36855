import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidegauge.llm import quality, queries

SCHEMA = "doc_id LONG, text STRING"


def test_pairs_are_scored_in_linear_time():
    draw = np.random.default_rng(1)
    width = (1 << quality.WORD_BITS) + quality.STATS
    machine = quality.Machine(
        0.3, draw.normal(size=width), draw.normal(size=(width, quality.FACTORS)) * 0.2,
        np.zeros(quality.STATS), np.ones(quality.STATS),
    )
    ids, x = draw.choice(width, 30, replace=False), draw.normal(size=30)
    margin = 0.3 + machine.linear[ids] @ x
    for i in range(30):
        for j in range(i):
            margin += machine.latent[ids[i]] @ machine.latent[ids[j]] * x[i] * x[j]
    assert abs(machine.score(ids, x) - 1 / (1 + np.exp(-margin))) < 1e-9


def test_interactions_are_learned():
    """Labels that only a pair of words tells: one of two words, but not both."""
    draw = np.random.default_rng(2)
    texts, labels = [], []
    for _ in range(1500):
        a, b = draw.integers(0, 2, 2)
        texts.append(" ".join(["alpha" if a else "beta", "gamma" if b else "delta"] + ["filler"] * 3))
        labels.append(int(a != b))
    rows = list(quality.features(pa.array(texts)))
    machine = quality.fit(rows, np.array(labels, float))
    right = [(machine.score(*machine.vector(*r)) >= 0.5) == y for r, y in zip(rows, labels)]
    assert np.mean(right) > 0.95


def scores(spark, docs, labels, schema=SCHEMA):
    df = spark.createDataFrame(docs, schema)
    machine = quality.train(df, spark.createDataFrame(labels, "doc_id LONG, quality INT"))
    return quality.scored(df, machine).collect()


def test_defined_cases(spark):
    docs = [(i, "GOOD WORDS!! " * 5 if i % 2 else "plain words here. " * 5) for i in range(60)]
    docs += [(100, None), (101, ""), (None, "x"), (102, "w " * 300_000), (3, docs[3][1])]
    labels = [(i, 1 - i % 2) for i in range(60)] + [(1, 0), (2, None), (None, 1), (5, 7)]
    got = scores(spark, docs, labels)
    assert len(got) == len(docs)
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[100] == by[101] and by[10] > 0.5 > by[11]
    assert {r.score for r in scores(spark, docs[:4], [])} == {0.5}
    assert {r.score for r in scores(spark, docs[:4], [(0, 1), (1, 1)])} == {0.5}
    assert scores(spark, [], [(0, 1)]) == []


def test_one_row_a_number_reaches_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(500)] + [(i, "good words") for i in range(2, 12)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id LONG, quality INT")
    collected, to_pandas = [], type(docs).toPandas

    def counted(df):
        collected.append(to_pandas(df))
        return collected[-1]

    monkeypatch.setattr(type(docs), "toPandas", counted)
    quality.train(docs, labels)
    assert [sorted(got["doc_id"]) for got in collected] == [list(range(1, 12))]


def test_other_columns_are_kept(spark):
    df = spark.createDataFrame([(1, "a", "b", 2.0)], SCHEMA + ", _score STRING, score DOUBLE")
    labels = spark.createDataFrame([], "doc_id LONG, quality INT")
    assert [tuple(r) for r in quality.kept(df, labels).collect()] == [(1, "a", "b", 2.0)]


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op9_quality(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())
    right = [got[x.doc_id].predicted == x.quality for x in labels if got[x.doc_id].held_out]
    assert len(right) > 500 and np.mean(right) > 0.97


def test_the_sample_is_bounded_in_bytes(spark):
    row = lambda i, n: (i, 1, bytes(n), bytes(n), bytes(2))
    featured = spark.createDataFrame([row(i, 49) for i in range(50)], "doc_id LONG, quality INT, ids BINARY, values BINARY, stats BINARY")
    order = [r.doc_id for r in featured.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    got = {r.doc_id for r in quality.sample_features(featured, 1234).collect()}
    assert got == set(order[:12])
    assert quality.sample_features(featured, 10**9).count() == 50
    # 8,000 texts of every word there is would take 2 GB.
    assert quality.TRAIN_BYTES + (1 << quality.WORD_BITS) * 8 < 8000 * (1 << quality.WORD_BITS) * 8 / 15


def test_query_scores_equal_the_naive_sum_of_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    machine = quality.train(docs, queries.training_labels(spark, folder))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in queries.op9_quality(spark, folder).collect()}
    assert got.keys() == texts.keys()
    for doc_id, row in zip(texts, quality.features(pa.array(texts.values(), pa.string()))):
        ids, x = machine.vector(*row)
        products = (machine.latent[ids].astype(float) @ machine.latent[ids].astype(float).T) * np.outer(x, x)
        margin = machine.bias + float(machine.linear[ids] @ x) + np.triu(products, 1).sum()
        score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        assert abs(got[doc_id].score - score) < 1e-4
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert got[doc_id].predicted == int(got[doc_id].score >= 0.3)
