"""Quality classifier: a factorisation machine over hashed words and the structure of a text.

A text becomes a sparse vector of hashed word counts (damped, unit length) and standardised
structure statistics. The machine adds to a linear score the pairwise interactions of all features
through ``FACTORS`` latent values each, computed in linear time as
``0.5 * sum_f((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``, and is trained with Adam on log loss.

Training uses a bounded sample of labelled rows (``TRAIN_ROWS``, taken by hash of the document
number, and of these, in the same order, as many as have ``TRAIN_BYTES`` of features together); scoring covers every whole text.

Defined cases: null and empty texts are scored as texts without words; a null label is no label; a
document with several labels counts once, with the lowest; of several texts under one labelled number
the smallest is learned from; without labels of both kinds every score
is 0.5; extra columns are kept and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import textops
from tidegauge.session import written

WORD_BITS = 15
FACTORS = 8
TRAIN_ROWS = 8000
#: What the features of the sample may take on the driver; a long text has up to 256 KB.
TRAIN_BYTES = 96 << 20
EPOCHS = 8
BATCH = 128
#: Steps at least, also where few rows are labelled.
LEAST_STEPS = 400
RATE = 0.01
DECAY = 1e-5
KEEP_SCORE = 0.3

#: Byte classes: upper, lower, digit, space, line end, sentence end, comma, bar, other marks, beyond ASCII.
_CLASSES = 10
_CLASS = np.full(256, 8, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12]], _CLASS[[10, 13]], _CLASS[46], _CLASS[44], _CLASS[124] = 3, 4, 5, 6, 7
_CLASS[128:] = 9
STATS = _CLASSES + 5


def features(texts: pa.Array):
    """Per row: feature numbers (ascending), their values, and the structure statistics."""
    for start, end, words, rows in textops.rows_of_words(texts):
        data, at = textops.text_bytes(texts.slice(start, end - start))
        kinds = _CLASS[data]
        numbers = (words & np.uint64((1 << WORD_BITS) - 1)).astype(np.int32)
        for i in range(end - start):
            own = numbers[rows[i] : rows[i + 1]]
            ids, counts = np.unique(own, return_counts=True)
            values = np.log1p(counts)
            values /= np.sqrt((values**2).sum()) or 1.0
            size = max(1, at[i + 1] - at[i])
            share = np.bincount(kinds[at[i] : at[i + 1]], minlength=_CLASSES) / size
            n = max(1, len(own))
            stats = [
                *np.sqrt(share),
                np.log1p(len(own)),
                len(ids) / n,
                counts.max(initial=0) / n,
                size / n / 10,
                np.log1p(size) / max(1.0, np.log1p(len(own))),
            ]
            yield ids.astype(np.int32), values.astype(np.float32), np.array(stats, np.float32)


@dataclass
class Machine:
    """Weights by feature: hashed words first, then the structure statistics."""

    bias: float
    linear: np.ndarray
    latent: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def vector(self, ids, values, stats):
        own = np.clip((stats - self.mean) / self.scale, -5, 5) / 4
        places = np.arange(1 << WORD_BITS, (1 << WORD_BITS) + STATS, dtype=np.int32)
        return np.concatenate([ids, places]), np.concatenate([values, own]).astype(np.float32)

    def score(self, ids, x) -> float:
        """Probability of label 1, linear in the number of features of the row."""
        v = self.latent[ids] * x[:, None]
        pairs = 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
        margin = self.bias + float(self.linear[ids] @ x) + float(pairs)
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 9) -> Machine:
    """Train on featurised rows; ``labels`` are 0 or 1."""
    width = (1 << WORD_BITS) + STATS
    rng = np.random.default_rng(seed)
    machine = Machine(
        0.0, np.zeros(width, np.float32), np.zeros((width, FACTORS), np.float32),
        np.zeros(STATS, np.float32), np.ones(STATS, np.float32),
    )
    if not len(labels) or labels.min() == labels.max():
        return machine
    table = np.stack([stats for _, _, stats in rows])
    machine.mean, machine.scale = table.mean(0), table.std(0) + 1e-3
    machine.latent = rng.normal(0, 0.02, (width, FACTORS)).astype(np.float32)
    vectors = [machine.vector(*row) for row in rows]
    weights = np.concatenate([machine.linear[:, None], machine.latent], 1)
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    bias = float(np.log(labels.mean() / (1 - labels.mean())))
    batches = -(-len(labels) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    for step in range(epochs):
        rate = RATE * (1 - step / epochs)
        for chosen in np.array_split(rng.permutation(len(labels)), batches):
            ids = np.concatenate([vectors[i][0] for i in chosen])
            x = np.concatenate([vectors[i][1] for i in chosen])[:, None]
            sizes = [len(vectors[i][0]) for i in chosen]
            starts = np.cumsum([0, *sizes[:-1]])
            v = weights[ids, 1:] * x
            sums = np.add.reduceat(v, starts)
            pairs = 0.5 * ((sums**2).sum(1) - np.add.reduceat((v**2).sum(1), starts))
            margin = bias + np.add.reduceat(weights[ids, 0] * x[:, 0], starts) + pairs
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            bias -= 10 * rate * float(error.sum())
            spread = np.repeat(error, sizes)[:, None].astype(np.float32)
            each = np.concatenate([spread * x, spread * x * (np.repeat(sums, sizes, 0) - v)], 1)
            order = np.argsort(ids, kind="stable")
            used, first = np.unique(ids[order], return_index=True)
            gradient = np.add.reduceat(each[order], first) + DECAY * weights[used]
            moment[used] = 0.9 * moment[used] + 0.1 * gradient
            square[used] = 0.99 * square[used] + 0.01 * gradient**2
            weights[used] -= rate * moment[used] / (np.sqrt(square[used]) + 1e-6)
    machine.bias, machine.linear, machine.latent = bias, weights[:, 0].copy(), weights[:, 1:].copy()
    return machine


def sample_features(featured: DataFrame, size: int) -> DataFrame:
    """Of the sample's features, in the order of the sample, the rows that have ``size`` bytes together."""
    own = featured.select("doc_id", F.expr("octet_length(ids) + octet_length(values) + octet_length(stats)").alias("bytes"))
    # One task, but of two numbers a row and no more rows than the sample has.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fitting = own.withColumn("so_far", F.sum("bytes").over(order)).where(F.col("so_far") <= size)
    return featured.join(F.broadcast(fitting.select("doc_id")), "doc_id", "left_semi")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Machine:
    """Fit on at most ``rows`` documents labelled in ``labels`` (doc_id, quality), with ``size`` bytes of features."""
    textops.small_batches(docs.sparkSession)
    one = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    one = one.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # The sample is bounded, so it may be broadcast and its features collected.
    sample = F.broadcast(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))

    def featurise(batches):
        for batch in batches:
            found = list(features(batch["text"]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["quality"],
                    *[pa.array([row[k].tobytes() for row in found], pa.binary()) for k in range(3)],
                ],
                names=["doc_id", "quality", "ids", "values", "stats"],
            )

    schema = "doc_id long, quality int, ids binary, values binary, stats binary"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # One text a number before anything is sent on, however often a number is there.
    labelled = texts.join(sample, "doc_id").groupBy("doc_id", F.col("quality").cast("int").alias("quality"))
    one_text = labelled.agg(F.min("text").alias("text"))
    got = sample_features(written(one_text.mapInArrow(featurise, schema)), size).toPandas().sort_values("doc_id")
    kinds = (np.int32, np.float32, np.float32)
    rows_ = [tuple(np.frombuffer(b, k) for b, k in zip(r, kinds)) for r in zip(got["ids"], got["values"], got["stats"])]
    return fit(rows_, got["quality"].to_numpy(np.float64))


def scorer(docs: DataFrame, machine: Machine):
    """A column function: text to score."""
    shared = textops.small_batches(docs.sparkSession).sparkContext.broadcast(machine)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array([model.score(*model.vector(*row)) for row in features(texts)], pa.float64())

    return score


def scored(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the score of every text in column ``name``."""
    text: Column = F.col("text").cast("string")
    return docs.withColumn(name, scorer(docs, machine)(text))


def kept(docs: DataFrame, labels: DataFrame, least: float = KEEP_SCORE) -> DataFrame:
    """The documents the classifier does not reject, all columns kept."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return scored(docs, train(docs, labels), name).where(F.col(name) >= least).drop(name)
