"""Ranked lexical search of all documents for a set of query items, term at a time with limited accumulators.

A term is a run of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased. The score of a document for an
item adds ``weight * ((SCALE * tf) div (1000 * tf + 8 * m))`` over the item's terms, repeats included; a term in few
documents weighs more, and ``m`` grows with the length of the document.

One pass over the texts writes, for every document, how often it has each term of the items; the numbers of documents and terms
come from that table. Tasks then take documents block by block and hold a block as an inverted index. For an item they
go through its terms from the rarest on and add to one accumulator a document. New ones are made only
while the largest sum that the terms left can still give reaches the k-th partial score (of the block or, from blocks before, of
the task); after that only documents that have one are looked up, and their scores are completed exactly.
A task gives its best k for each item, and the best of these are the result.

Items are searched in blocks of at most ``ITEM_BYTES`` of text, which is what a task holds of them; a larger item is a block of
its own. Memory beyond that follows ``BLOCK_POSTINGS``, the longest document, and k rows for each item.

Defined cases: null and empty texts, and texts without a term, are not counted as documents and found by no item; items
without terms, or whose terms no document has, give no rows; rows of one ``item_id`` (null too) are one item with the
terms of all; rows of one ``doc_id`` are documents of their own and may both be found; equal scores are ordered by ``doc_id``, null last;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm import textops
from tidegauge.session import written

SCALE = 1_000_000_000
#: Share of a document's length in ``m``, in hundredths.
LENGTH_SHARE = 75
FOUND = 10
#: Text of the items that are searched together.
ITEM_BYTES = 8 << 20
#: Terms of documents in a block, unless one document has more.
BLOCK_POSTINGS = 2_000_000
#: Bytes of a text that are split at a time.
PART_BYTES = 1 << 20

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def count_terms(text: bytes) -> Counter:
    """How often each term occurs."""
    counts: Counter = Counter()
    text = text.translate(_LOWER)
    start = 0
    while start < len(text):
        cut = _BREAK.search(text, start + PART_BYTES)
        end = cut.start() if cut else len(text)
        counts.update(_TERM.findall(text, start, end))
        start = end
    return counts


def _bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return batch["text"].fill_null("").cast(pa.large_binary()).to_pylist()


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id``, ``term``, ``repeats`` of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(_bytes_of(batch)):
                counts = count_terms(text)
                if counts:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["item_id"].take(pa.array([i] * len(counts))),
                            pa.array(list(counts), pa.binary()),
                            pa.array(list(counts.values()), pa.int64()),
                        ],
                        names=["item_id", "term", "repeats"],
                    )

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"item_id {kind}, term binary, repeats long"
    )
    return found.groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


def item_blocks(items: DataFrame, limit: int = ITEM_BYTES) -> DataFrame:
    """``item_terms`` with ``block``: no block holds more than ``limit`` bytes of terms, but for an item that does alone."""
    terms = written(item_terms(items))
    size = F.sum(F.octet_length("term") + 16)
    blocks = 1
    while True:
        placed = terms.withColumn("block", F.pmod(F.xxhash64("item_id", F.lit(blocks)), F.lit(blocks)))
        sizes = placed.groupBy("block", "item_id").agg(size.alias("size"))
        held = sizes.groupBy("block").agg(F.sum("size").alias("size"), F.count("*").alias("items"))
        if held.where((F.col("size") > limit) & (F.col("items") > 1)).isEmpty():
            return placed
        blocks *= 2


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, ``n`` (its terms with repeats), ``terms`` (places in ``vocabulary``) and ``times`` of documents with terms."""
    number = docs.sparkSession.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            rows, n, terms, times = [], [], [], []
            for i, text in enumerate(_bytes_of(batch)):
                counts = count_terms(text)
                if not counts:
                    continue
                own = [(known[t], c) for t, c in counts.items() if t in known]
                rows.append(i)
                n.append(counts.total())
                terms.append([t for t, _ in own])
                times.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(rows, pa.int64())),
                    pa.array(n, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, times array<long>")


class Block:
    """An inverted index of some documents: ``units`` of a term and document without weight and repeats."""

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, terms: int):
        order = np.argsort(term, kind="stable")  # documents of a term stay in order
        self.size = len(m)
        self.doc = doc[order]
        self.units = (SCALE * times[order]) // (1000 * times[order] + 8 * m[self.doc])
        self.starts = np.searchsorted(term[order], np.arange(terms + 1))
        self.most = np.zeros(terms, np.int64)
        full = np.flatnonzero(np.diff(self.starts))
        if len(full):
            self.most[full] = np.maximum.reduceat(self.units, self.starts[full])

    def best(self, terms: np.ndarray, factors: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and their exact scores, of which no other reaches the best k or ``floor``.

        ``terms`` come rarest first, with ``factors`` of weight times repeats. ``floor`` is a score that k
        documents elsewhere have already.
        """
        bounds = factors * self.most[terms]
        left = np.cumsum(bounds[::-1])[::-1]
        scores = np.zeros(self.size, np.int64)
        made = np.zeros(self.size, bool)
        survivors, creating = None, True
        for i, (term, factor) in enumerate(zip(terms.tolist(), factors.tolist())):
            if creating:
                kth = floor
                if np.count_nonzero(made) >= k:
                    kth = max(kth, int(np.partition(scores, -k)[-k]))
                if left[i] < kth:
                    creating = False
                    # Who cannot reach the k-th score any more need not be completed.
                    survivors = np.flatnonzero(made & (scores + left[i] >= kth))
            start, end = self.starts[term], self.starts[term + 1]
            doc = self.doc[start:end]
            if creating:
                scores[doc] += factor * self.units[start:end]
                made[doc] = True
            elif len(survivors) and end > start:
                at = np.minimum(np.searchsorted(doc, survivors), len(doc) - 1)
                holds = doc[at] == survivors
                scores[survivors[holds]] += factor * self.units[start + at[holds]]
        docs = np.flatnonzero(made) if survivors is None else survivors
        docs = docs[scores[docs] > 0]
        return docs, scores[docs]


def _top(found: list[tuple], k: int) -> list[tuple]:
    """The k best of (score, doc_id): highest first, then smallest number, null last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]


def _search(items: list[tuple[object, np.ndarray, np.ndarray]], terms: int, k: int):
    """The function that gives each task's best k rows (item_id, doc_id, score) of its postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        held: list[pa.RecordBatch] = []
        kinds = None

        def work() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            lists = table["terms"].combine_chunks()
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            block = Block(
                table["m"].to_numpy(),
                np.repeat(np.arange(len(counts)), counts),
                lists.flatten().to_numpy(),
                table["times"].combine_chunks().flatten().to_numpy(),
                terms,
            )
            numbers = table["doc_id"]
            for i, (_, own, factors) in enumerate(items):
                floor = best[i][-1][0] if len(best[i]) == k else 0
                docs, scores = block.best(own, factors, k, floor)
                if len(docs) > k:
                    docs, scores = (x[scores >= np.partition(scores, -k)[-k]] for x in (docs, scores))
                if len(docs):
                    ids = numbers.take(pa.array(docs)).to_pylist()
                    best[i] = _top(best[i] + list(zip(scores.tolist(), ids)), k)

        size = 0
        for batch in batches:
            kinds = batch.schema
            if not batch.num_rows:
                continue
            more = len(batch["terms"].flatten())
            if held and size + more > BLOCK_POSTINGS:
                work()
                size = 0
            held.append(batch)
            size += more
        if held:
            work()
        rows = [(item, number, score) for (item, _, _), found in zip(items, best) for score, number in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows]),
                    pa.array([r[1] for r in rows], kinds.field("doc_id").type),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                names=["item", "doc_id", "score"],
            )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = FOUND, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the k documents of the highest score above 0 for each item."""
    spark = textops.small_batches(docs.sparkSession)
    placed = item_blocks(items, item_bytes)
    names = written(placed.select("item_id", "block").distinct().withColumn("item", F.monotonically_increasing_id()))
    results = []
    for (block,) in placed.select("block").distinct().orderBy("block").collect():
        # Bounded by the size of a block.
        own = names.where(F.col("block") == block).select("item_id", "item")
        terms = (
            placed.where(F.col("block") == block)
            .withColumnRenamed("item_id", "of")
            .join(own, F.col("of").eqNullSafe(F.col("item_id")))
            .select("item", "term", "repeats")
        )
        terms = written(terms)
        vocabulary = sorted(bytes(r["term"]) for r in terms.select("term").distinct().collect())
        index = written(postings(docs, vocabulary))
        total = index.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        n, length = total["docs"], total["terms"]
        if not n:
            continue
        holding = index.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.ln((2 * F.lit(n) + 2) / (2 * F.col("df") + 1)))
        weights = np.zeros(len(vocabulary), np.int64)
        seldom = np.zeros(len(vocabulary), np.int64)
        for row in holding.select("number", "df", weight.alias("weight")).collect():
            weights[row["number"]], seldom[row["number"]] = row["weight"], row["df"]
        number = {term: i for i, term in enumerate(vocabulary)}
        wanted: dict[int, list[tuple[int, int]]] = {}
        for row in terms.collect():
            wanted.setdefault(row["item"], []).append((number[bytes(row["term"])], row["repeats"]))
        searched = []
        for item, own in sorted(wanted.items()):
            held = sorted((int(seldom[t]), t, r) for t, r in own if seldom[t])
            at = np.array([t for _, t, _ in held], np.int64)
            searched.append((item, at, weights[at] * np.array([r for _, _, r in held], np.int64)))
        # m = 100 - share + (share * n * N) div L
        m = F.lit(100 - LENGTH_SHARE) + F.call_function("div", F.lit(LENGTH_SHARE) * F.col("n") * F.lit(n), F.lit(length))
        kind = docs.schema["doc_id"].dataType.simpleString()
        found = index.select("doc_id", m.cast("long").alias("m"), "terms", "times").mapInArrow(
            _search(searched, len(vocabulary), k), f"item long, doc_id {kind}, score long"
        )
        results.append(written(_ranked(found, k)))
    kinds = {c: t.schema[c].dataType.simpleString() for c, t in (("item_id", items), ("doc_id", docs))}
    if not results:
        return spark.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score long")
    everything = results[0]
    for more in results[1:]:
        everything = everything.unionByName(more)
    return everything.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
