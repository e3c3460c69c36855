"""Join of documents by Jaccard similarity of their five-word shingles, over a prefix tree.

The sets of all documents are put in one global order: rare shingles by hash, then frequent ones
(those of more than ``T`` documents, counted over all of them). Two sets of similarity 0.8 share a
shingle among the first fifth of each; only what shares one is compared.

Candidates of a set are stored in a trie of globally ordered sets, frequent shingles first, so that
copies share long paths. The trie is traversed once per set: the overlap of a shared path is counted
once, and a subtree is pruned where overlap and remaining length cannot reach the similarity.

A group is the sets that share a shingle; two of them are compared if what follows that shingle in both
is long enough for the similarity. Not all pairs of a group are: every set is first compared with the
smallest of its groups, and with ``CHOICES`` sets of a larger group, which are chosen by a hash, the same
in groups of the same sets. This is linear, and it leaves large groups of copies in one
component. The remaining pairs of a group in different components are then compared, all of them.
Equal sets are one class throughout.

Defined cases: null and empty texts have no set and link with nothing; texts of fewer than five
words have one shingle, the whole sequence; repeated rows and numbers keep their rows, and texts under one number
link only if they are similar; rows without a number link like others; texts are
read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import graph, textops
from tidegauge.session import written

#: Similarity as a fraction.
NUMERATOR, DENOMINATOR = 80, 100
#: A shingle is frequent beyond this many documents; the bound is doubled until the list fits.
FREQUENT = 8
LISTED = 1_000_000
#: Shingles a task gathers before it passes them on.
GATHERED = 1 << 20
#: Candidates a trie holds.
TRIE_SETS = 512
#: Numbers of compared documents are broadcast up to this many.
BROADCAST_DOCS = 1_000_000
STEP = 64
#: Sets that a group of more members chooses.
CHOICES = 96
#: Rounds of joining components in between; sets taken to be unconnected only cost comparisons.
ROUNDS = 2


def least_overlap(a: int, b: int) -> int:
    """The smallest overlap with which sets of these sizes are similar."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def prefix_size(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit key of a set, whatever its order; sets of one key are one class."""
    key = textops.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True) + np.uint64(len(hashes))
    return int(textops.mix(key)[0].astype(np.int64))


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and set of every row."""
    for start, end, words, rows in textops.rows_of_words(batch["text"]):
        yield from enumerate(textops.shingle_hashes(words, rows), start)
    textops.give_back()


def overlap_tries(query: np.ndarray, blobs: list[bytes]) -> list[int]:
    """For every set that is similar to ``query``, its place in ``blobs``.

    A blob is a set in the order of the trie, as big-endian numbers, so that sorting the blobs lines
    up the paths of the trie: what a set shares with the one before it is their common path.
    """
    order = sorted(range(len(blobs)), key=blobs.__getitem__)
    inside = np.sort(query)
    n = len(query)
    found: list[int] = []
    path = np.zeros(0, ">u8")
    counts = np.zeros(1, np.int64)  # overlap of the path's first d shingles, as far as it was walked
    for place in order:
        own = np.frombuffer(blobs[place], ">u8")
        m, needed = len(own), least_overlap(n, len(own))
        if min(n, m) < needed:
            continue
        k = min(m, len(path))
        differs = np.flatnonzero(own[:k] != path[:k])
        depth = min(int(differs[0]) if len(differs) else k, len(counts) - 1)
        walked = [counts[: depth + 1]]
        overlap = int(counts[depth])
        while depth < m and overlap + min(n - overlap, m - depth) >= needed:
            step = own[depth : depth + STEP].astype(np.uint64)
            at = np.minimum(np.searchsorted(inside, step), n - 1)
            ahead = overlap + np.cumsum(inside[at] == step)
            walked.append(ahead)
            depth, overlap = depth + len(step), int(ahead[-1])
        path, counts = own, np.concatenate(walked)
        if depth == m and overlap >= needed:
            found.append(place)
    return found


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows (a, set_a, b, set_b) that come ordered by ``a``."""

    def links(a: int, query: bytes, candidates: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
        similar = overlap_tries(np.frombuffer(query, ">u8").astype(np.uint64), [blob for _, blob in candidates])
        return [(a, candidates[k][0]) for k in similar]

    a, query, held = None, b"", []
    for batch in batches:
        found = []
        columns = (batch["a"].to_pylist(), batch["b"].to_pylist(), batch["set_a"], batch["set_b"])
        for i, (x, y) in enumerate(zip(*columns[:2])):
            if x != a or len(held) == TRIE_SETS:
                if held:
                    found += links(a, query, held)
                a, query, held = x, columns[2][i].as_py(), []
            held.append((y, columns[3][i].as_py()))
        yield _pairs(found)
    if held:
        yield _pairs(links(a, query, held))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _split(token: np.ndarray) -> list[tuple[int, slice]]:
    """Buckets of ascending short tokens, with where they lie."""
    bucket = (token >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = [*edges[1:].tolist(), len(bucket)]
    return [(int(bucket[s]), slice(s, e)) for s, e in zip(edges.tolist(), ends)]


def _shortener(bits: int):
    """Bucket (of so many bits) and 32 bits within it; two shingles of one short token only make candidates."""
    return lambda hashes: hashes >> np.uint64(32 - bits)


class Join:
    """The join of one table of texts (doc_id, text)."""

    def __init__(self, docs: DataFrame):
        self.spark = textops.small_batches(docs.sparkSession)
        text = F.col("text").cast("string")
        # A row is told by its number and text; numbers may be null or repeated.
        self.docs = docs.select("doc_id", F.xxhash64(text).alias("hash"), text.alias("text"))
        # So many buckets that a bucket's share of the shingles is small at any size of input.
        self.bits = max(10, math.ceil(math.log2(32 * self.docs.rdd.getNumPartitions())))

    def classes(self) -> DataFrame:
        """``doc_id``, ``hash`` of the text, ``n_shingles``, ``key`` of its set (null without one)."""

        def run(batches):
            for batch in batches:
                sizes, keys = [], []
                for _, own in _sets(batch):
                    sizes.append(len(own))
                    keys.append(set_key(own) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["hash"], pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())],
                    names=["doc_id", "hash", "n_shingles", "key"],
                )

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        return graph.compact(self.docs.mapInArrow(run, f"doc_id {kind}, hash long, n_shingles long, key long"))

    def frequent(self) -> np.ndarray:
        """Short tokens of the frequent shingles, ascending: a list of bounded size."""
        short = _shortener(self.bits)

        def gather(batches):
            held: list[np.ndarray] = []

            def flush():
                token, count = np.unique(np.concatenate(held), return_counts=True)
                rows = [
                    (b, token[s].astype(np.uint32).tobytes(), np.minimum(count[s], 1 << 30).astype(np.uint32))
                    for b, s in _split(token)
                ]
                held.clear()
                counts = [c.tobytes() if (c != 1).any() else b"" for _, _, c in rows]
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.binary()),
                        pa.array(counts, pa.binary()),
                    ],
                    names=["bucket", "tokens", "counts"],
                )

            size = 0
            for batch in batches:
                for _, own in _sets(batch):
                    held.append(short(own))
                    size += len(own)
                    if size >= GATHERED:
                        yield flush()
                        size = 0
            if size:
                yield flush()

        def count(bucket: pa.Table) -> pa.Table:
            tokens = [np.frombuffer(x, np.uint32) for x in bucket["tokens"].to_pylist()]
            counts = [
                np.frombuffer(c, np.uint32) if c else np.ones(len(t), np.uint32)
                for t, c in zip(tokens, bucket["counts"].to_pylist())
            ]
            token, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
            total = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
            many = total > FREQUENT
            textops.give_back()
            number = bucket["bucket"][0].as_py() << 32
            return pa.table({"token": token[many].astype(np.int64) + number, "documents": total[many]})

        gathered = self.docs.select("text").mapInArrow(gather, "bucket int, tokens binary, counts binary")
        counted = graph.compact(gathered.groupBy("bucket").applyInArrow(count, "token long, documents long"))
        least = FREQUENT
        while counted.where(F.col("documents") > least).count() > LISTED:
            least *= 2
        listed = counted.where(F.col("documents") > least).select("token").toPandas()
        return np.sort(listed["token"].to_numpy(np.uint64))

    def incidences(self, frequent) -> DataFrame:
        """``token``, ``key``, ``place``: the classes of the sets that have a token in their prefix, and where.

        Tokens of one class only are left out, if they are rare.
        """
        short, bits = _shortener(self.bits), self.bits

        def gather(batches):
            listed = frequent.value
            # Tokens, key of the set, place of the first token.
            rare: list[tuple[np.ndarray, int, int]] = []
            hot: list[tuple[np.ndarray, int, int]] = []
            flushed = 0

            def flush():
                rows = []
                for kind, held in enumerate((rare, hot)):
                    if not held:
                        continue
                    token, key, place = _first_of_each(
                        np.concatenate([t for t, _, _ in held]),
                        np.repeat(np.array([k for _, k, _ in held], np.int64), [len(t) for t, _, _ in held]),
                        np.concatenate([np.arange(p, p + len(t), dtype=np.uint32) for t, _, p in held]),
                    )
                    if kind:
                        bucket = (1 << bits) + int(key[0]) % (1 << bits)
                        rows.append((bucket, token.tobytes(), key.tobytes(), place.tobytes()))
                    else:
                        rows += [
                            (b, token[s].astype(np.uint32).tobytes(), key[s].tobytes(), place[s].tobytes())
                            for b, s in _split(token)
                        ]
                    held.clear()
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)],
                    ],
                    names=["bucket", "tokens", "keys", "places"],
                )

            for batch in batches:
                for _, own in _sets(batch):
                    if not len(own):
                        continue
                    token = short(own)
                    is_hot = _listed(token, listed)
                    size = prefix_size(len(own))
                    key = set_key(own)
                    first = token[~is_hot][:size]
                    if len(first):
                        rare.append((first, key, 0))
                    if len(first) < size:
                        hot.append((token[is_hot][: size - len(first)], key, len(first)))
                    flushed += size
                    if flushed >= GATHERED:
                        yield flush()
                        flushed = 0
            if flushed:
                yield flush()

        def meet(bucket: pa.Table) -> pa.Table:
            number = bucket["bucket"][0].as_py()
            hot = number >= 1 << bits
            token = np.concatenate(
                [np.frombuffer(x, np.uint64 if hot else np.uint32) for x in bucket["tokens"].to_pylist()]
            ).astype(np.int64)
            key = np.concatenate([np.frombuffer(x, np.int64) for x in bucket["keys"].to_pylist()])
            place = np.concatenate([np.frombuffer(x, np.uint32) for x in bucket["places"].to_pylist()])
            token, key, place = _first_of_each(token, key, place)
            if not hot:
                shared = np.zeros(len(token), bool)
                same = np.diff(token) == 0
                shared[1:] |= same
                shared[:-1] |= same
                token, key, place = token[shared] + (number << 32), key[shared], place[shared]
            met = pa.table({"token": token, "key": key, "place": place.astype(np.int64)})
            textops.give_back()
            return met

        gathered = self.docs.select("text").mapInArrow(gather, "bucket int, tokens binary, keys binary, places binary")
        return gathered.groupBy("bucket").applyInArrow(meet, "token long, key long, place long")

    def sets(self, classes: DataFrame, keys: DataFrame, frequent) -> DataFrame:
        """``key`` and ``set`` of the wanted classes, in the order of the trie.

        Each class is read from one of its texts; rows with the number and text of that one are counted once.
        """
        short = _shortener(self.bits)

        def run(batches):
            seen: set[int] = set()
            for batch in batches:
                keys, blobs = [], []
                for _, own in _sets(batch):
                    key = set_key(own)
                    if key in seen:
                        continue
                    seen.add(key)
                    hot = _listed(short(own), frequent.value)
                    keys.append(key)
                    blobs.append(np.concatenate([own[hot], own[~hot]]).astype(">u8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["key", "set"]
                )

        wanted = classes.join(keys, "key", "left_semi").groupBy("key").agg(F.min(F.struct("hash", "doc_id")).alias("row"))
        wanted = graph.compact(wanted.select(F.col("row.doc_id").alias("wanted_id"), F.col("row.hash").alias("wanted_hash")))
        if wanted.count() <= BROADCAST_DOCS:
            wanted = F.broadcast(wanted)
        same = (F.col("hash") == F.col("wanted_hash")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))
        texts = self.docs.join(wanted, same, "left_semi").select("text")
        sets = texts.mapInArrow(run, "key long, set binary").groupBy("key").agg(F.first("set").alias("set"))
        # Kept by the executors, and read from the documents again where one is lost.
        return sets.persist(StorageLevel.DISK_ONLY)

    def links(self, pairs: DataFrame, classes: DataFrame, frequent) -> DataFrame:
        """The similar ones of ``pairs`` (a, b), as a table."""
        met = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
        sets = self.sets(classes, met, frequent)
        of_b = pairs.join(sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b")
        both = of_b.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a")
        found = graph.compact(both.select("a", "set_a", "b", "set_b").mapInArrow(_compare, "a long, b long"))
        sets.unpersist()
        return found

    def first_pairs(self, incidences: DataFrame) -> DataFrame:
        """Every class with the smallest of each group it is in, and with the ``CHOICES`` of each larger group."""

        def choice(k: int):
            return F.min(_other(F.xxhash64("key", F.lit(k)).alias("order"), "key"))

        groups = incidences.groupBy("token").agg(F.min(_other("key")).alias("other"), F.count("*").alias("members"))
        # A group of few is left to the smallest, and to the pairs that remain.
        large = groups.where(F.col("members") > CHOICES).select("token")
        chosen = incidences.join(large, "token", "left_semi").groupBy("token")
        chosen = chosen.agg(F.array(*[choice(k) for k in range(CHOICES)]).alias("others"))
        chosen = chosen.select("token", F.explode(F.array_distinct(F.transform("others", lambda o: o.dropFields("order")))))
        others = groups.select("token", "other").unionByName(chosen.toDF("token", "other"))
        return _comparable(incidences.join(others, "token").where(F.col("key") != F.col("other.key")))

    def remaining_pairs(self, incidences: DataFrame, parts: DataFrame) -> DataFrame:
        """All pairs of a group in different components."""
        part = F.coalesce("component", "key").alias("part")
        placed = incidences.join(parts.withColumnRenamed("node", "key"), "key", "left")
        placed = placed.select("token", "key", "place", "n", part)
        several = placed.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y")
        mixed = graph.compact(placed.join(several.select("token"), "token", "left_semi"))
        two = mixed.select("token", _other("key", "part").alias("other"))
        met = mixed.join(two, "token").where(
            (F.col("key") < F.col("other.key")) & (F.col("part") != F.col("other.part"))
        )
        return _comparable(met)


def _other(*first):
    return F.struct(*first, "n", "place")


def _comparable(met: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that may be similar if the shingle they meet in is the first they share.

    Every similar pair meets there too, and the overlap is then at most what follows it in either set.
    """
    n, other_n = F.col("n"), F.col("other.n")
    most = F.least(n - F.col("place"), other_n - F.col("other.place"))
    fits = most * (NUMERATOR + DENOMINATOR) >= (n + other_n) * NUMERATOR
    a, b = F.least("key", "other.key"), F.greatest("key", "other.key")
    return met.where(fits).select(a.alias("a"), b.alias("b")).distinct()


def _first_of_each(token: np.ndarray, key: np.ndarray, place: np.ndarray):
    """One row for each token and set, in ascending order; copies of a set count once."""
    order = np.lexsort((place, key, token))
    token, key, place = token[order], key[order], place[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    return token[new], key[new], place[new]


def _listed(token: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(token), bool)
    return listed[np.minimum(np.searchsorted(listed, token), len(listed) - 1)] == token


def _parts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``hash`` of its text, ``n_shingles`` and ``part``, null without words."""
    join = Join(docs)
    classes = join.classes()
    frequent = join.spark.sparkContext.broadcast(join.frequent())
    sizes = classes.where("key is not null").groupBy("key").agg(F.min("n_shingles").alias("n"))
    incidences = graph.compact(join.incidences(frequent).join(sizes, "key"))
    first = graph.compact(join.first_pairs(incidences))
    links = join.links(first, classes, frequent)
    rest = join.remaining_pairs(incidences, graph.components(links, ROUNDS))
    rest = graph.compact(rest.join(first, ["a", "b"], "left_anti"))
    links = links.unionByName(join.links(rest, classes, frequent))
    parts = graph.components(links)
    part = F.coalesce("component", "key").alias("part")
    placed = classes.join(parts.withColumnRenamed("node", "key"), "key", "left")
    return placed.select("doc_id", "hash", "n_shingles", part)


def _least(placed: DataFrame, least) -> DataFrame:
    """``placed`` with the value of the aggregate ``least`` of its part as ``least``."""
    # A part of one row is left out: there are nearly as many of these as rows.
    found = graph.compact(
        placed.where("part is not null").groupBy("part").agg(least.alias("least"), F.count("*").alias("rows")).where("rows > 1")
    )
    if found.count() <= BROADCAST_DOCS:
        found = F.broadcast(found)
    return placed.join(found.select("part", "least"), "part", "left")


def similar_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, and ``component_id``, the smallest number reachable by links.

    A row without a number links like any other; ``component_id`` is null where no number is reachable.
    """
    found = _least(_parts(docs), F.min("doc_id"))
    return found.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every group of similar ones, all columns kept: that of the smallest number.

    Rows are told by number and text: of a repeated number only the similar texts go, and of rows that are equal in both
    one stays. A row without a number comes after those with one. Different texts without words all stay.
    """
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    found = graph.compact(_least(_parts(docs), F.min(order)))
    same = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("hash") == F.col("least.hash"))
    same = F.col("least").isNull() | same
    # Per number and text: whether it stays, and how often it is there.
    rows = found.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), same.alias("_stays"))
    told = graph.compact(rows.agg(F.count("*").alias("_rows")).where("not _stays or _rows > 1"))
    if told.count() <= BROADCAST_DOCS:
        told = F.broadcast(told)
    is_told = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
    marked = docs.join(told, is_told, "left")
    left = marked.where("_stays is null").select(docs.columns)
    again = marked.where("_stays").dropDuplicates(["_id", "_hash"]).select(docs.columns)
    return left.unionByName(again)
