"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Texts become words (runs of letters and digits, lower-cased) and words become hashes. A mask picks
six of ten neighbouring words and ignores the others; the hashes of all masks at all places of a
document are joined to those of the benchmark, so that a passage is found although words in it were
replaced. Around every hit the two texts are laid side by side, and a document is contaminated by an
item if in some ``WINDOW`` words in a row, the seed among them, at least ``SHARE`` are equal (of an
item shorter than the window: of its words). An item of fewer than ten words has one seed over all of them
and contaminates where they stand in a row unchanged; one of fewer than ``ALONE`` words, which ordinary text
holds too, only a document that has no other words.

The benchmark's seeds are broadcast, in blocks of ``BLOCK_SEEDS``, each against all documents. What
leaves a document's task are verified hits, added up there first.

Defined cases: null and empty texts have no words, and contaminate or are contaminated by nothing; repeated items each report; rows of one document number report together, null
numbers too; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import written

#: Word places that count, of ten. No two masks miss the same substitutions.
MASKS = [(0, 1, 3, 4, 7, 9), (0, 2, 3, 5, 8, 9), (0, 1, 2, 5, 7, 9)]
SPAN = 10
#: Items of fewer words contaminate only documents that are nothing else.
ALONE = 5
WINDOW = 16
SHARE = 0.68
#: A seed takes about 250 bytes.
BLOCK_SEEDS = 100_000
#: Contaminated document numbers are broadcast to the removal up to this number.
BROADCAST_DOCS = 500_000

_BEFORE = WINDOW - SPAN


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(words: Column, at: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in mask]) for k, mask in enumerate(MASKS)]


def _whole_seed(words: Column, at: Column, length: int) -> Column:
    """The seed of ``length`` words in a row, as an item of that many words has it."""
    return F.xxhash64(F.lit(-length), *[F.get(words, at + i) for i in range(length)])


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """Seeds of ``item_id`` and ``text``: ``seed``, ``item_id``, the words around it, the equal words needed, and
    the number of words of an item that has one seed only.

    Seeds of one item with the same surroundings are one.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words"))
    size = F.size("words")
    at = F.explode(F.sequence(F.lit(0), F.greatest(size - SPAN, F.lit(0)))).alias("at")
    placed = items.where(size > 0).select("item_id", "words", at)
    # Places before the first word and after the last are null.
    around = F.transform(F.sequence(F.col("at") - _BEFORE, F.col("at") + WINDOW - 1), lambda i: F.get("words", i))
    short = F.when(size < SPAN, size)
    needed = F.coalesce(short, F.ceil(F.lit(SHARE) * F.least(F.lit(WINDOW), size)).cast("int"))
    words, place = F.col("words"), F.col("at")
    own = F.array(*_seeds(words, place))
    for length in range(1, SPAN):
        own = F.when(size == length, F.array(_whole_seed(words, place, length))).otherwise(own)
    seed = F.explode(own).alias("seed")
    return placed.select(
        seed, "item_id", around.alias("around"), needed.alias("needed"), short.alias("short")
    ).distinct()


def _hits(docs: DataFrame, seeds: DataFrame, lengths: list[int] = ()) -> DataFrame:
    """Per seed met: how many words are equal in the best window around it.

    ``lengths`` are those of the items that have one seed only.

    The word array never leaves the generated code that walks along it; a hit takes its surroundings
    with it. They are compared outside, lest that code grow beyond what the JVM compiles.
    """
    words = docs.select("doc_id", word_hashes(F.col("text")).alias("words"))
    # Outer, lest the optimizer adds a filter that would divide each text into words a second time.
    placed = words.select("doc_id", "words", F.posexplode_outer("words").alias("at", "word"))
    place = F.col("at")
    own = _seeds(F.col("words"), place)
    for length in lengths:
        fits = (place == 0) & (F.size("words") == length) if length < ALONE else place >= 0
        own.append(F.when(fits, _whole_seed(F.col("words"), place, length)))
    seeded = placed.select("doc_id", "words", "at", F.stack(F.lit(len(own)), *own).alias("seed"))
    met = seeded.join(F.broadcast(seeds), "seed")

    # From the place before which a window can begin, or from the first word.
    near = F.slice("words", F.greatest(F.col("at") - _BEFORE, F.lit(0)) + 1, F.lit(_BEFORE + WINDOW)).alias("near")
    taken = met.select("doc_id", "item_id", "at", "needed", "around", near)
    cut = F.greatest(_BEFORE - F.col("at"), F.lit(0))  # places before the first word
    equal = F.filter(
        F.sequence(F.lit(0), F.size("near") - 1), lambda i: F.coalesce(F.get("near", i) == F.get("around", i + cut), F.lit(False))
    )
    compared = taken.select("doc_id", "item_id", "at", "needed", F.transform(equal, lambda i: i + cut).alias("equal"))
    windows = F.transform(
        F.sequence(F.lit(0), F.lit(_BEFORE)),
        lambda k: F.size(F.filter("equal", lambda i: (i >= k) & (i < k + WINDOW))),
    )
    return compared.select("doc_id", "item_id", "at", "needed", F.array_max(windows).alias("equal_words"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id`` of verified overlaps, with the most ``equal_words`` of a window, and the
    first and last word place of a verified seed."""
    seeds = written(benchmark_seeds(benchmark))
    blocks = -(-seeds.count() // BLOCK_SEEDS) or 1
    lengths = sorted(r.short for r in seeds.where("short is not null").select("short").distinct().collect())
    seeds = seeds.drop("short")
    parts = [
        _hits(docs, seeds if blocks == 1 else seeds.where(F.pmod("seed", F.lit(blocks)) == k), lengths)
        for k in range(blocks)
    ]
    place = F.when(F.col("equal_words") >= F.col("needed"), F.col("at"))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("doc_id", "item_id", "needed")
        .agg(F.max("equal_words").alias("equal_words"), F.min(place).alias("first_word"), F.max(place).alias("last_word"))
        .where("equal_words >= needed")
        .drop("needed")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    found = written(contaminated(docs, benchmark).select("doc_id").distinct())
    if found.count() <= BROADCAST_DOCS:
        found = F.broadcast(found)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")
