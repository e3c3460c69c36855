"""Words and shingles of Arrow text columns as 64-bit hashes, computed with numpy inside tasks.

A word is a run of bytes other than space and the five ASCII control spaces, with A-Z lower-cased.
Null texts count as empty. Texts are worked through in blocks, so that memory does not follow the
length of a text but for eight bytes per word.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 20
SHINGLE = 5

#: Rows sent to a Python worker at a time; texts are long.
BATCH_ROWS = 1000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE_HASH = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_HASH[65:91] = _BYTE_HASH[97:123]
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)
_PLACES = np.random.default_rng(12).integers(1, 2**63, 2 * SHINGLE, dtype=np.uint64) | np.uint64(1)


@functools.cache
def _trim():
    """The C library's call that gives unused memory back to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Give memory that this worker does not use any more back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def small_batches(spark: SparkSession) -> SparkSession:
    """Let this session send rows to Python workers in batches of at most ``BATCH_ROWS``."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting, "0")) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def slices(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
        yield start, end
        start = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row starts (one more entry at the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


class _Powers:
    """Powers of the factor and of its inverse, as long as a block needs."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def to(self, n: int) -> _Powers:
        if len(self.up) < n:
            self.up, self.down = _powers(_FACTOR, n), _powers(_INVERSE, n)
        return self


def word_hashes(data: np.ndarray, at: np.ndarray, powers: _Powers | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the number of words before each row (one more at the end)."""
    powers = powers or _Powers()
    hashes, starts = [], []
    begin = 0
    while begin < len(data):
        size = BLOCK_BYTES
        while True:
            end = min(begin + size, len(data))
            if end == len(data):
                break
            spaces = np.flatnonzero(_SPACE[data[begin:end]])
            if len(spaces):
                end = begin + int(spaces[-1]) + 1
                break
            size *= 2
        block = data[begin:end]
        word = ~_SPACE[block]
        edges = np.zeros(len(block) + 1, bool)  # a row starts here
        edges[at[np.searchsorted(at, begin) : np.searchsorted(at, end, "right")] - begin] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edges[1:-1]
        last = word.copy()
        last[:-1] &= ~word[1:] | edges[1:-1]
        first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
        p = powers.to(len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_BYTE_HASH[block] * p.up[: len(block)], out=sums[1:])
        raw = (sums[last] - sums[first]) * p.down[first]
        hashes.append(mix(raw + (last - first).astype(np.uint64)))
        starts.append(first + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), at)


def shingle_hashes(words: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its five-word shingles.

    A row of fewer words has one shingle, the whole row; a row without words has none.
    """
    n = len(words)
    hashes = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for i in range(SHINGLE):
        hashes += words[i : i + len(hashes)] * _PLACES[i]
    hashes = mix(hashes)
    for start, end in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if end - start >= SHINGLE:
            yield np.unique(hashes[start : end - SHINGLE + 1])
        elif end > start:
            few = words[start:end] * _PLACES[SHINGLE : SHINGLE + end - start]
            yield mix(few.sum(keepdims=True) + np.uint64(end - start))
        else:
            yield hashes[:0]


def rows_of_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, word hashes and row starts of a text column, block by block."""
    powers = _Powers()
    for start, end in slices(texts):
        data, at = text_bytes(texts.slice(start, end - start))
        yield (start, end, *word_hashes(data, at, powers))
