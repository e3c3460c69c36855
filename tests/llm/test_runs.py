import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidegauge.llm import queries, runs
from tidegauge.llm.tables import table

FOLDER = "/root/testdata/sf0.001"


def every_run(words):
    """All runs, by comparing the words with themselves at every distance."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((start, end - start, q) for (start, end), q in found.items())


def found_in(texts):
    ids = [1000 * t + w for t, words in enumerate(texts) for w in words]
    starts = np.cumsum([0, *map(len, texts)])
    return runs.find_runs(np.array(ids, np.int64), starts)


def test_runs_equal_brute_force():
    draw = random.Random(7)
    total = 0
    for _ in range(800):
        texts = []
        for _ in range(draw.randint(1, 5)):
            kinds, n = draw.choice([1, 2, 2, 3, 8]), draw.randint(0, 70)
            words = [draw.randrange(kinds) for _ in range(n)]
            if draw.random() < 0.6 and n > 4:
                a = draw.randrange(n)
                p = draw.randint(1, max(1, (n - a) // 3))
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
                words += words[-draw.randint(1, 20) :] * draw.randint(0, 6)
            texts.append(words)
        expected = [every_run(words) for words in texts]
        assert found_in(texts) == expected
        total += sum(map(len, expected))
    assert total > 2000


@pytest.mark.parametrize("words", [[0] * 5, [0, 1] * 3 + [0], [0, 1, 2] * 4, [0] * 6, ([0] * 6 + [1]) * 5, [0, 1, 0, 1, 2] * 40])
def test_runs_at_the_bounds(words):
    assert found_in([words]) == [every_run(words)]


def test_runs_of_long_texts():
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 200_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    equal, cycle = [0] * 300_000, list(range(70_000)) * 4
    assert found_in([fibonacci[-1], equal, [], cycle]) == [[], [(0, 300_000, 1)], [], [(0, 280_000, 70_000)]]


def test_symbols_are_repeated_pairs():
    words = np.array([1, 2, 3, 1, 2, 3, 9, 1, 2, 3, 1, 2, 3, 8], np.int64)
    nodes, left = runs.repair(words, np.zeros(14, np.int64), np.array([14]))
    # Nothing but 123123 holds six words, at both of its places.
    assert [(n.x.tolist(), n.y.tolist(), [p.tolist() for p in n.places]) for n in nodes] == [([0], [6], [[0, 7]])]
    assert left.tolist() == [0, 6, 7, 13]


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (None, "a a a a a a"), (5, "x\x0bx x\x0cx x x y"), (5, "x\x0bx x\x0cx x x y"), (6, "A a A a A a")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS runs", "'c' AS collapsed", "2 AS part")
    got = sorted(((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.with_runs(docs).collect()))
    six = [(0, 6, 1)]
    assert got == [(0, six, "a"), (1, [], ""), (2, [], ""), (3, [], ""), (5, six, "x y"), (5, six, "x y"), (6, [], "A a A a A a")]
    assert runs.with_runs(docs.limit(0)).count() == 0


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = every_run(words)
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r) for r in queries.op13_runs(spark, FOLDER).collect()}
    docs = table(spark, FOLDER, "documents").collect()
    # The plain way takes the square of a text's words.
    short = [d for d in docs if len(d["text"] or "") < 20_000]
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert [got[d["doc_id"]] for d in short] == [expected_row(d["doc_id"], d["text"]) for d in short]


def test_cycles_of_empty_texts(spark):
    # 10, 23 and 31 are among the numbers whose hash ends in 0.
    chosen = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    docs = spark.createDataFrame([(chosen[0], None), (chosen[1], ""), (chosen[2], " one ")], "doc_id LONG, text STRING")
    got = {r["doc_id"]: r["collapsed"] for r in runs.with_runs(queries.with_cycles(docs)).collect()}
    assert got == dict(zip(chosen, ["", "", "one"]))
