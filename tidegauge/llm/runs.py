"""Runs of repeated words in each text, found on a Re-Pair grammar of its word numbers.

Words are what white space of ASCII separates, as they are. A run is a stretch of consecutive words with smallest
period q (words q apart are equal) of at least ``EXPONENT`` periods and ``LEAST`` words that neither neighbour extends.

Re-Pair replaces the pairs that occur most often in a text by new symbols until no pair occurs twice. It works
in rounds over many texts at once: a round replaces every repeated pair that no overlapping pair outranks, which is the
order of Re-Pair for all pairs that touch each other. What is left of a text is halved into a balanced tree.

A run lies whole in some symbol or node whose two halves it touches both, so it is enough to look at
each boundary: once for a symbol, whatever the number of its occurrences. A run of four periods has two whole periods on one
side of the boundary, so only periods are tried whose words there are equal. Runs are carried from a symbol to all places
it was derived at, and pieces of one run are merged to the longest interval.

Memory follows ``BLOCK_BYTES`` of text or the longest text. Defined cases: null and empty texts, and texts of white space,
have no run; repeated rows and numbers keep their rows; nothing is compared between texts, so no ties
arise; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import textops

#: Least length of a run, in periods and in words.
EXPONENT, LEAST = 4, 6
#: Text that is worked on at a time, unless one text is longer.
BLOCK_BYTES = 2 << 20
#: Pairs of boundary and period that are compared at a time.
TRIED = 1 << 21
#: Words compared for all of these pairs before the rest is compared one by one.
AHEAD = 8

Run = tuple[int, int, int]


class Nodes:
    """Boundaries to look at: the words ``[x, y)`` halved at ``b``; a symbol has its places, a tree node its own."""

    def __init__(self, x, b, y, places=None):
        self.x, self.b, self.y = x, b, y
        self.places: list[np.ndarray] | None = places


def repair(ids: np.ndarray, text_of: np.ndarray, ends: np.ndarray) -> tuple[list[Nodes], np.ndarray]:
    """The symbols of every round, and where the symbols that are left begin.

    ``ids`` are word numbers no two texts share, ``text_of`` the text of each, ``ends`` where texts end.
    """
    found: list[Nodes] = []
    n = len(ids)
    symbol, at = ids.astype(np.int64), np.arange(n)
    following = int(ids.max()) + 1 if n else 0
    live = np.ones(max(0, n - 1), bool)
    live &= text_of[1:] == text_of[:-1]
    while True:
        where = np.flatnonzero(live)
        if not len(where):
            break
        key = (symbol[where] << 32) | symbol[where + 1]
        # Of equal pairs in a row, aaaa, every second one counts.
        stretch = np.zeros(len(where), bool)
        stretch[1:] = (np.diff(where) == 1) & (key[1:] == key[:-1])
        begins = np.maximum.accumulate(np.where(stretch, 0, np.arange(len(where))))
        counted = (np.arange(len(where)) - begins) % 2 == 0
        distinct, kind = np.unique(key, return_inverse=True)
        times = np.bincount(kind[counted], minlength=len(distinct))
        repeated = times[kind] >= 2
        live[where[~repeated]] = False
        where, kind, counted = where[repeated], kind[repeated], counted[repeated]
        if not len(where):
            break
        rank = np.zeros(len(symbol) + 1, np.int64)  # of the pair at each place, one place on
        # Pairs as frequent as each other are ranked at random, or a repeated passage would take a round for each word.
        rank[where + 1] = (times[kind] << 32) + 1 + np.random.default_rng(1).permutation(len(distinct))[kind]
        own = rank[where + 1]
        before, after = rank[where], np.append(rank, 0)[where + 2]
        chosen = counted & (own >= before) & (own >= after)
        # A pair left with one place would be no repetition.
        places = np.bincount(kind[chosen], minlength=len(distinct))
        chosen &= places[kind] >= 2
        left, kind = where[chosen], kind[chosen]
        order = np.argsort(kind, kind="stable")
        sorted_kind, sorted_left = kind[order], left[order]
        edges = np.flatnonzero(np.diff(sorted_kind, prepend=-1))
        bounds = np.append(at, n)
        stop = np.minimum(bounds[np.minimum(sorted_left + 2, len(at))], ends[text_of[at[sorted_left]]])
        first = sorted_left[edges]
        size = stop[edges] - at[first]
        long = size >= LEAST  # shorter ones hold no run
        places_of = np.split(at[sorted_left], edges[1:])
        if long.any():
            found.append(
                Nodes(
                    at[first][long], at[first + 1][long], stop[edges][long],
                    [p for p, keep in zip(places_of, long.tolist()) if keep],
                )
            )
        new = np.zeros(len(distinct), np.int64)
        new[sorted_kind[edges]] = following + np.arange(len(edges))
        following += len(edges)
        symbol[left] = new[kind]
        touched = np.zeros(len(symbol) + 1, bool)
        touched[left] = True
        keep = np.ones(len(symbol), bool)
        keep[left + 1] = False
        joint = np.append(live, False)
        joint[left] = joint[left + 1]  # what follows the new symbol
        symbol, at, touched, joint = symbol[keep], at[keep], touched[:-1][keep], joint[keep]
        same = text_of[at[1:]] == text_of[at[:-1]]
        live = (joint[:-1] | touched[:-1] | touched[1:]) & same
    return found, at


def halves(at: np.ndarray, text_of: np.ndarray, ends: np.ndarray) -> list[Nodes]:
    """The nodes of a balanced tree over the symbols of each text."""
    found = []
    while True:
        text = text_of[at]
        first = np.flatnonzero(np.diff(text, prepend=-1))
        number = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        left = np.flatnonzero(number % 2 == 0)
        left = left[left + 1 < len(at)]
        left = left[text[left + 1] == text[left]]
        if not len(left):
            return found
        beyond = np.append(at, ends[-1])[np.minimum(left + 2, len(at))]
        stop = np.minimum(beyond, ends[text[left]])
        long = stop - at[left] >= LEAST
        found.append(Nodes(at[left][long], at[left + 1][long], stop[long]))
        keep = np.ones(len(at), bool)
        keep[left + 1] = False
        at = at[keep]


def _equal_squares(ids: np.ndarray, nodes: Nodes) -> Iterator[tuple[int, int, int]]:
    """(node, side, period) where the words next to the boundary may be equal on that side (0 left, 1 right)."""
    size = (nodes.y - nodes.x) // EXPONENT
    for side in (0, 1):
        half = nodes.b - nodes.x if side == 0 else nodes.y - nodes.b
        most = np.minimum(size, half // 2)
        total = np.cumsum(most)
        begin = 0
        while begin < len(most):
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + TRIED, "right")))
            count = most[begin:end]
            node = np.repeat(np.arange(begin, end), count)
            period = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count) + 1
            at = nodes.b[node]
            # The word nearest to the boundary first; most periods end there.
            for ahead in range(AHEAD):
                step = np.minimum(ahead, period - 1)  # a shorter period is compared already
                place = at - 1 - step if side == 0 else at + step
                fits = ids[place] == ids[place - period if side == 0 else place + period]
                node, period, at = node[fits], period[fits], at[fits]
            yield from zip(node.tolist(), [side] * len(node), period.tolist())
            begin = end


def _runs_of_node(ids: np.ndarray, x: int, b: int, y: int, tried: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Runs in the words ``[x, y)`` that have two periods on one side of ``b``, as (start, end, period)."""
    found = []
    for side in (0, 1):
        periods = sorted(q for s, q in tried if s == side)
        k = 0
        while k < len(periods):
            q = periods[k]
            k += 1
            low = b - 2 * q if side == 0 else b
            if not np.array_equal(ids[low : low + q], ids[low + q : low + 2 * q]):
                continue
            differs = np.flatnonzero(ids[x : y - q] != ids[x + q : y]) + x
            after = int(np.searchsorted(differs, low))
            start = int(differs[after - 1]) + 1 if after else x
            end = (int(differs[after]) if after < len(differs) else y - q) + q
            if end - start >= max(LEAST, EXPONENT * q):
                found.append((start, end, q))
            # Squares within this run have no smallest period of their own.
            reach = (b - start if side == 0 else end - b) // 2
            while k < len(periods) and periods[k] <= reach:
                k += 1
    return found


def _merged(pieces: list[tuple[int, int, int]]) -> list[Run]:
    """Pieces (start, end, period) of one text as whole runs (start, length, period), by start, then period."""
    whole: list[list[int]] = []
    for start, end, q in sorted(set(pieces), key=lambda r: (r[2], r[0], r[1])):
        last = whole[-1] if whole else None
        if last and last[2] == q and start <= last[1] - q:
            last[1] = max(last[1], end)
        else:
            whole.append([start, end, q])
    least: dict[tuple[int, int], int] = {}
    for start, end, q in whole:
        least[start, end] = min(q, least.get((start, end), q))
    return sorted((start, end - start, q) for (start, end), q in least.items())


def find_runs(ids: np.ndarray, starts: np.ndarray) -> list[list[Run]]:
    """The runs of every text. ``ids`` are word numbers no two texts share; text i begins at ``starts[i]``."""
    out: list[list[Run]] = [[] for _ in starts[:-1]]
    if not len(ids):
        return out
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ends = starts[1:]
    symbols, left = repair(ids, text_of, ends)
    pieces: dict[int, list[tuple[int, int, int]]] = {}
    for nodes in symbols + halves(left, text_of, ends):
        tried: dict[int, list[tuple[int, int]]] = {}
        for node, side, q in _equal_squares(ids, nodes):
            tried.setdefault(node, []).append((side, q))
        for node, squares in tried.items():
            x = int(nodes.x[node])
            for start, end, q in _runs_of_node(ids, x, int(nodes.b[node]), int(nodes.y[node]), squares):
                text = int(text_of[x])
                base = int(starts[text])
                places = nodes.places[node].tolist() if nodes.places else [x]
                pieces.setdefault(text, []).extend(
                    (start - x + place - base, end - x + place - base, q) for place in places
                )
    for text, found in pieces.items():
        out[text] = _merged(found)
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run is cut to its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        steps[start + q] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


def _texts_with_runs(texts: pa.Array) -> tuple[list[list[Run]], list[bytes]]:
    """Runs and collapsed text of every row."""
    words = [t.split() for t in texts.fill_null("").cast(pa.large_binary()).to_pylist()]
    ids: list[int] = []
    for own in words:
        number: dict[bytes, int] = {}
        before = len(ids)
        ids.extend([before + number.setdefault(w, len(number)) for w in own])
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=starts[1:])
    found = find_runs(np.array(ids, np.int64), starts)
    collapsed = []
    for own, runs in zip(words, found):
        if runs:
            own = [own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()]
        collapsed.append(b" ".join(own))
    return found, collapsed


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def with_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period; by start, then period) and ``collapsed`` for every row of ``docs``.

    ``collapsed`` has the words that no run holds after its first period, with single spaces between.
    """
    textops.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"]
            for start, end in textops.slices(texts, BLOCK_BYTES):
                found, collapsed = _texts_with_runs(texts.slice(start, end - start))
                runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in found], pa.list_(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(start, end - start), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def longest(runs):
    """Of a column of runs the one of greatest length, then smallest start, then period; null without runs."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    first = F.array_min(order)
    return F.struct(first["start"].alias("start"), (-first["less"]).alias("length"), first["period"].alias("period"))
