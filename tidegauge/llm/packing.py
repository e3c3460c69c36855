"""Packing of documents into sequences of at most 2048 tokens, in their order.

Every partition's documents form one stream of tokens. A dynamic program chooses where sequences end,
at ends of documents or of sentences, so that padding and penalties for cutting a document are
smallest. A sequence is padded to the full length unless its length is a power of two. The best start
for an end ``j`` minimises ``cost[i] + start[i]`` over the last 2048 tokens, which a monotone queue
yields in constant time; power-of-two lengths are looked up beside it. The stream is worked through
in stretches, whose last sequences wait for the next stretch.

Within a sentence of more than 128 tokens every 128th may be an end, at a higher penalty. What remains at the end
of a partition is cut into powers of two, so it needs no padding either.

Defined cases: a null or empty text is the closing id alone; repeated rows are packed once each; a
null document number is kept; an empty table gives no rows; other columns are ignored. Partitions
share nothing, so no document, however long or often repeated, meets others in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import textops, tokens

LENGTH = 2048
CLOSING_ID = 1
#: Cost in tokens of padding of each sequence, and of ending one within a document or a sentence.
SEQUENCE_COST, SENTENCE_COST, WORD_COST = 1, 4, 16
#: Where no sentence ends for so many tokens, a sequence may end within it.
LONG_SENTENCE = 128
#: Lengths other than the full one that need no padding and are worth a sequence.
SHORT_LENGTHS = (1024, 512, 256, 128)
STRETCH = 1 << 18


def cuts(ends: np.ndarray, costs: np.ndarray, length: int = LENGTH, short=SHORT_LENGTHS) -> list[int]:
    """Where sequences end: the cheapest choice among ``ends`` (ascending; the last is the stream's end).

    ``costs`` are the penalties of the ends. No two ends may lie more than ``length`` apart.
    """
    places = np.concatenate([[0], ends])
    # The first place within reach of each, and the pairs (end, start) that lie a short length apart.
    reach = np.searchsorted(places, places - length).tolist()
    pairs = []
    for size in short:
        start = np.searchsorted(places, places - size)
        hit = np.flatnonzero(places[start] == places - size)
        pairs.append(np.stack([hit, start[hit], np.full(len(hit), size)]))
    pairs = np.concatenate(pairs, axis=1)
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    paired, starts, sizes = [*pairs[0].tolist(), -1], pairs[1].tolist(), pairs[2].tolist()
    pair = 0
    # Key of a place: its least cost and itself, so that a padded sequence adds ``length`` to its start's key.
    key, back = [0], [0]
    # The queue: starts within reach, their keys ascending from ``head`` on.
    queued, head = [0], 0
    for j, cost in enumerate((costs + SEQUENCE_COST).tolist(), 1):
        low = reach[j]
        while queued[head] < low:
            head += 1
        i = queued[head]
        least = key[i] + length
        while paired[pair] == j:
            k = starts[pair]
            if key[k] + sizes[pair] < least:
                i = k
                least = key[k] + sizes[pair]
            pair += 1
        least += cost
        key.append(least)
        back.append(i)
        while len(queued) > head and key[queued[-1]] >= least:
            queued.pop()
        queued.append(j)
    out, j = [], len(places) - 1
    while j:
        out.append(int(places[j]))
        j = back[j]
    return out[::-1]


def _merged(*parts: np.ndarray) -> np.ndarray:
    """The distinct numbers of sorted parts, in order."""
    every = np.sort(np.concatenate(parts), kind="stable")
    return every[np.diff(every, prepend=-1) > 0]


def candidate_ends(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int, step: int = LONG_SENTENCE):
    """Possible ends in ``(0, total]`` with their penalties, none more than ``step`` apart."""
    docs, sentences = (x[(x > 0) & (x <= total)] for x in (doc_ends, sentence_ends))
    ends = _merged(docs, sentences, np.array([total]))
    gaps = np.diff(ends, prepend=0)
    if (gaps > step).any():
        extra = [np.arange(e - g + step, e, step) for e, g in zip(ends[gaps > step], gaps[gaps > step])]
        ends = _merged(ends, np.concatenate(extra))
    costs = np.full(len(ends), WORD_COST, np.int64)
    costs[np.searchsorted(ends, sentences)] = SENTENCE_COST
    costs[np.searchsorted(ends, docs)] = 0
    costs[-1] = 0
    return ends, costs


class _Packer:
    """The stream of one partition."""

    def __init__(self, doc_type: pa.DataType, partition: int):
        self.doc_type, self.sequence = doc_type, partition << 32
        self.ids: list[np.ndarray] = []
        self.sentences: list[np.ndarray] = []
        self.docs: list = []  # numbers of the documents in the buffer
        self.doc_ends: list[int] = []  # where they end in the buffer
        self.doc_sizes: list[int] = []
        self.size = 0

    def add(self, doc_ids: list, ids: np.ndarray, at: np.ndarray, sentences: np.ndarray) -> None:
        """Documents with their ids one after another, each to be closed by the closing id."""
        self.ids.append(np.insert(ids, at[1:], CLOSING_ID).astype(np.int32))
        # A document's ids are moved by the closing ids before it.
        moved = np.searchsorted(at, sentences, "left") - 1
        self.sentences.append(sentences + moved + self.size)
        sizes = np.diff(at) + 1
        self.docs += doc_ids
        self.doc_sizes += sizes.tolist()
        self.doc_ends += (self.size + np.cumsum(sizes)).tolist()
        self.size += int(sizes.sum())

    def pack(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        doc_ends, sentences = np.array(self.doc_ends, np.int64), np.concatenate(self.sentences)
        chosen = cuts(*candidate_ends(doc_ends, sentences, self.size))
        if last:
            start, rest = (chosen[-2] if len(chosen) > 1 else 0), []
            at = self.size
            while at > start:
                rest.append(at)
                at -= (at - start) & -(at - start)
            chosen = [*chosen[:-1], *rest[::-1]]
        else:
            chosen = [c for c in chosen if c <= self.size - 2 * LENGTH]
        if not chosen:
            return
        done, ids = chosen[-1], np.concatenate(self.ids)
        windows = np.array([0, *chosen], np.int64)
        edges = _merged(windows, doc_ends[doc_ends < done])
        begin, end = edges[:-1], edges[1:]
        doc, window = np.searchsorted(doc_ends, begin, "right"), np.searchsorted(windows, begin, "right") - 1
        sizes = np.array(self.doc_sizes, np.int64)
        start = begin - (doc_ends - sizes)[doc]
        numbers = pa.array(self.docs, self.doc_type).take(pa.array(doc))
        data = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(edges * 4), pa.py_buffer(ids[:done].astype("<u4").tobytes())]
        )
        columns = [
            numbers, start, end - begin, data.cast(pa.binary()), sizes[doc], self.sequence + window, begin - windows[window],
        ]
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        self.sequence += len(chosen)
        first = int(np.searchsorted(doc_ends, done, "right"))
        self.ids, self.sentences = [ids[done:]], [sentences[sentences > done] - done]
        self.docs, self.doc_sizes = self.docs[first:], self.doc_sizes[first:]
        self.doc_ends = (doc_ends[first:] - done).tolist()
        self.size -= done


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds a piece's token ids as little-endian unsigned 32-bit numbers. ``docs`` has doc_id and text.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers outlive their tasks: also what the tasks before took and do not use any more goes back.
        textops.give_back()
        words = tokens.words_of(tokenizer_path)
        packer = None
        for batch in batches:
            packer = packer or _Packer(batch["doc_id"].type, TaskContext.get().partitionId())
            for start, end in textops.slices(batch["text"]):
                texts = [t or "" for t in batch["text"].slice(start, end - start).to_pylist()]
                packer.add(batch["doc_id"].slice(start, end - start).to_pylist(), *words.encode(texts))
                if packer.size >= STRETCH:
                    yield from packer.pack(last=False)
                    textops.give_back()
        if packer:
            yield from packer.pack(last=True)
        textops.give_back()

    textops.small_batches(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {doc_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(packed, schema)
