"""Fingerprints of texts by a randomised edit embedding.

A text is walked over character by character with random bits that all texts share: in step j the embedding shows the text
at the walk's place, and the walk moves on if the bit of step j and of the character there is set. Walks over two texts
that meet at equal characters stay together up to the next edit, and after an edit soon meet again, so that texts of small
edit distance have embeddings of small Hamming distance. What is shown is a hash of four bits of the ``GRAM`` characters
from the place on; the walk, some two steps a character, ends with the text.

A fingerprint is a sample of the embedding, one hexadecimal digit a sample: all of the first ``SAMPLES`` steps, then as many
of as many further steps, of twice as many, and so on, one of each of ``SAMPLES`` equal parts. So it covers a text of any
length whole and grows with the logarithm of it. The likeness of two fingerprints is the estimated share of the longer
embedding in which both show the same, less what chance gives.

:func:`matches` finds similar texts: bands are made of bits sampled from a fingerprint, texts that share a band are candidates,
and the likeness of their fingerprints decides.

Defined cases: null texts are empty; empty texts have the empty fingerprint, which is like itself only;
equal texts have equal fingerprints and likeness 1; repeated rows and numbers keep their rows; texts are read whole, in
parts of ``PART`` characters; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import textops
from tidegauge.session import written

SEED = 29
#: Characters of one kind share their bits, which repeat after PERIOD steps.
KINDS, PERIOD = 64, 4096
#: Samples of a level; level k > 0 has those of the steps from SAMPLES * 2^(k-1) to SAMPLES * 2^k.
SAMPLES, LEVELS = 32, 36
GRAM = 4
#: Chance that two different grams show the same digit.
CHANCE = 1 / 16
PART = 1 << 16
#: Likeness from which texts match.
LEAST = 0.8
#: Bands of a level, and the samples in each.
BANDS, BAND_SAMPLES = 24, 6

_draw = np.random.default_rng(SEED)


def _moves() -> list[list[int]]:
    """For each kind of character and step (modulo PERIOD) the step after the walk has moved on."""
    out = []
    steps = list(range(PERIOD))  # one number object for all tables
    for _ in range(KINDS):
        bits = _draw.integers(0, 2, PERIOD, dtype=np.int8)
        bits[0] = 1
        after = np.flatnonzero(np.concatenate([bits, bits]))
        following = after[np.searchsorted(after, np.arange(PERIOD))] + 1
        out.append([steps[j] for j in (following % PERIOD).tolist()])
    return out


_MOVES = _moves()
_FACTORS = _draw.integers(1, 2**63, GRAM, dtype=np.uint64) | np.uint64(1)


def _sampled() -> tuple[np.ndarray, np.ndarray]:
    """The sampled steps, ascending, and how many steps each stands for."""
    steps, weights = [np.arange(SAMPLES)], [np.ones(SAMPLES, np.int64)]
    for level in range(1, LEVELS):
        width = 1 << (level - 1)
        steps.append(SAMPLES * width + np.arange(SAMPLES) * width + _draw.integers(0, width, SAMPLES))
        weights.append(np.full(SAMPLES, width))
    return np.concatenate(steps), np.concatenate(weights).astype(float)


_STEPS, _WEIGHTS = _sampled()
_BAND_PLACES = [[_draw.permutation(SAMPLES)[:BAND_SAMPLES].tolist() for _ in range(BANDS)] for _ in range(LEVELS)]
_PLACES = np.array(_BAND_PLACES)


class _ByCharacter(dict):
    """The moves of a character, by the character."""

    def __missing__(self, character: str) -> list[int]:
        kind = (ord(character) * 0x9E3779B1 >> 8) % KINDS
        return self.setdefault(character, _MOVES[kind])


class Walker:
    """Walks over texts; remembers the moves of the characters met."""

    def __init__(self):
        self.moves = _ByCharacter()

    def walk(self, text: str, step: int = 0) -> tuple[np.ndarray, int]:
        """The characters shown in the sampled steps of a walk over ``text`` from ``step`` on, and the step after it."""
        moves, places = self.moves, [np.zeros(0, np.int64)]
        for start in range(0, len(text), PART):
            at = first = step % PERIOD
            ends = np.array([at := moves[c][at] for c in text[start : start + PART]], np.int64)
            stays = np.diff(ends, prepend=first)
            stays[stays <= 0] += PERIOD
            after = step + np.cumsum(stays)
            low, high = np.searchsorted(_STEPS, (step, after[-1]))
            places.append(start + np.searchsorted(after, _STEPS[low:high], "right"))
            step = int(after[-1])
        return np.concatenate(places), step


def _digits(text: str, places: np.ndarray) -> str:
    """What the walk shows at ``places`` of ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    shown = np.zeros(len(places), np.uint64)
    for i in range(GRAM):
        at = places + i
        inside = at < len(codes)
        shown += np.where(inside, codes[np.where(inside, at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0)) * _FACTORS[i]
    digits = (textops.mix(shown) >> np.uint64(60)).astype(np.uint8)
    return np.frombuffer(b"0123456789abcdef", np.uint8)[digits].tobytes().decode()


def fingerprint(text: str, walker: Walker | None = None) -> str:
    if not text:
        return ""
    places, _ = (walker or Walker()).walk(text)
    return _digits(text, places)


def likeness(a: str, b: str) -> float:
    """Estimated share of the longer embedding in which both show the same, from 0 to 1."""
    if a == b:
        return 1.0
    shared, total = min(len(a), len(b)), _WEIGHTS[: max(len(a), len(b))].sum()
    if not shared:
        return 0.0
    weights = _WEIGHTS[:shared]
    same = np.frombuffer(a[:shared].encode(), np.uint8) == np.frombuffer(b[:shared].encode(), np.uint8)
    matched = (weights[same].sum() - CHANCE * weights.sum()) / (1 - CHANCE)
    return float(min(1.0, max(0.0, matched / total)))


def bands(print_: str) -> list[str]:
    """Keys of the bands of a fingerprint: sampled bits of each of its last two whole levels, and the level.

    Only the long levels tell texts apart; a fingerprint of less than one level is a band by itself.
    """
    levels = len(print_) // SAMPLES
    if not levels:
        return [f"short:{print_}"] if print_ else []
    keys = []
    for level in range(max(0, levels - 2), levels):
        own = print_[level * SAMPLES : (level + 1) * SAMPLES]
        keys += [f"{level}:{k}:" + "".join(own[i] for i in places) for k, places in enumerate(_BAND_PLACES[level])]
    return keys


def shared_bands(a: str, b: str) -> int:
    """How many bands two fingerprints share."""
    levels = [len(x) // SAMPLES for x in (a, b)]
    if not all(levels):
        return len(set(bands(a)) & set(bands(b)))
    low, high = max(0, max(levels) - 2), min(levels)
    if low >= high:
        return 0
    x, y = (np.frombuffer(p[: high * SAMPLES].encode(), np.uint8) for p in (a, b))
    same = x == y
    return sum(int(same[level * SAMPLES + _PLACES[level]].all(1).sum()) for level in range(low, high))


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return batch[name].fill_null("").to_pylist()


def _output(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[name for name, _ in kinds]
    )


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars`` (code points) and ``fingerprint`` of every row of ``docs``."""
    textops.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker()
        for batch in batches:
            texts = _texts(batch, "text")
            prints = [fingerprint(t, walker) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def matches(queries: DataFrame, docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``query_id``, ``doc_id``, ``likeness`` of the rows of ``docs`` that match a row of ``queries`` (doc_id, text).

    A join of a stated set of queries with all documents: equal fingerprints are one class on either side, and
    classes that share a band are compared once. A match is missed if all bands differ: each of 48 holds six samples, so
    that differences spread over two texts of likeness 0.8 hide them about once in ten million pairs.
    """

    def classes(side: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = written(fingerprinted(side))
        return rows, rows.where("fingerprint != ''").select("fingerprint").distinct()

    def banded(prints: DataFrame, name: str) -> DataFrame:
        def run(batches):
            for batch in batches:
                own = batch["fingerprint"].to_pylist()
                pairs = [(p, key) for p in own for key in bands(p)]
                yield _output(pairs, [(name, pa.string()), ("band", pa.string())])

        return prints.mapInArrow(run, f"{name} string, band string")

    def verify(batches):
        for batch in batches:
            pairs = zip(batch["wanted"].to_pylist(), batch["met"].to_pylist())
            found = [(a, b, x) for a, b in pairs if (x := likeness(a, b)) >= least]
            yield _output(found, [("wanted", pa.string()), ("met", pa.string()), ("likeness", pa.float64())])

    asked, wanted = classes(queries)
    rows, met = classes(docs)
    candidates = banded(wanted, "wanted").join(banded(met, "met"), "band").select("wanted", "met").distinct()
    found = candidates.mapInArrow(verify, "wanted string, met string, likeness double")
    empty = asked.where("fingerprint = ''").select("fingerprint").limit(1)
    found = found.unionByName(
        empty.select(F.lit("").alias("wanted"), F.lit("").alias("met"), F.lit(1.0).alias("likeness"))
    )
    by_query = asked.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("wanted"))
    by_doc = rows.select("doc_id", F.col("fingerprint").alias("met"))
    return by_query.join(found, "wanted").join(by_doc, "met").select("query_id", "doc_id", "likeness")


_ROW = [
    ("doc_id", None), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("bands_edited", pa.int64()), ("bands_next", pa.int64()),
]


def _compared(number, text: str, places: np.ndarray, step: int, own: str, following: str, next_print: str, walker: Walker):
    """One result row: a text against itself with its last half replaced from the following text, and against that.

    ``places`` and ``step`` are the walk's over the half that stays.
    """
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    more, _ = walker.walk(following[:half], step)
    edited_print = _digits(edited, np.concatenate([places, len(text) - half + more])) if edited else ""
    return (
        number, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, edited_print,
        likeness(own, edited_print), likeness(own, next_print),
        shared_bands(own, edited_print), shared_bands(own, next_print),
    )


def against_neighbours(docs: DataFrame) -> DataFrame:
    """Every text against its edited form and the next text, by descending ``doc_id`` (after the last the first).

    The edited form has the last ``n_chars div 2`` code points replaced by the first as many of the next text. Null numbers
    come last; rows of one number follow each other by a hash of their texts. Further columns: how many bands are shared.

    Documents are sorted once over the cluster. Within a part of the sorted rows each row waits for the following one; the first and the last of a part, two rows
    whatever its size, are written with their texts and meet in a second step.
    """
    spark = textops.small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Rows equal in both are spread by a third key; which of them comes first makes no difference.
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash"), F.col("row")]
    keyed = texts.withColumns({"hash": F.xxhash64("text"), "row": F.xxhash64(F.monotonically_increasing_id())})
    parts = keyed.orderBy(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, held = Walker(), None
        columns = None
        for batch in batches:
            columns = columns or [(n, t or batch.schema.field("doc_id").type) for n, t in _ROW] + [
                ("part", pa.int32()), ("opens", pa.bool_()), ("text", pa.string())
            ]
            rows = []
            for number, text, part in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["part"].to_pylist()):
                kept = len(text) - len(text) // 2
                places, step = walker.walk(text[:kept])
                rest, _ = walker.walk(text[kept:], step)
                own = _digits(text, np.concatenate([places, kept + rest])) if text else ""
                if held is None:
                    rows.append((None, None, None, own, None, None, None, None, None, part, True, text))
                else:
                    rows.append((*_compared(*held[:5], text, own, walker), part, None, None))
                held = (number, text, places, step, own, part)
            yield _output(rows, columns)
        if held is not None:
            number, text, _, _, own, part = held
            yield _output([(number, None, None, own, None, None, None, None, None, part, False, text)], columns)

    result = f"""doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
        near_edited double, near_next double, bands_edited long, bands_next long"""
    done = written(parts.mapInArrow(run, result + ", part int, opens boolean, text string"), compression="zstd")
    names = [name for name, _ in _ROW]
    inner = done.where("opens is null").select(*names)

    # Each part that has rows with the part after it, in a circle: as many numbers as parts.
    having = [r["part"] for r in done.where("opens").select("part").orderBy("part").collect()]
    following = spark.createDataFrame(list(zip(having, having[1:] + having[:1])), "part int, next_part int")
    last = done.where("not opens").select("part", "doc_id", "text", "fingerprint")
    first = done.where("opens").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    edges = last.join(F.broadcast(following), "part").join(first.hint("merge"), "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker()
        for batch in batches:
            columns = [(n, t or batch.schema.field("doc_id").type) for n, t in _ROW]
            rows = []
            for row in batch.to_pylist():
                text = row["text"]
                places, step = walker.walk(text[: len(text) - len(text) // 2])
                rows.append(
                    _compared(
                        row["doc_id"], text, places, step, row["fingerprint"], row["next_text"], row["next_fingerprint"], walker
                    )
                )
            yield _output(rows, columns)

    outer = edges.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(close, result)
    return inner.unionByName(outer)
