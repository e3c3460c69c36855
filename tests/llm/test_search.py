import math
import random
import re
from collections import Counter

import numpy as np

from tidegauge.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plainly(docs, items, k=10):
    counted = [(number, Counter(terms(text))) for number, text in docs if terms(text)]
    n, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for number, c in counted:
            m = 25 + (75 * c.total() * n) // length
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, r in wanted.items() if t in c
            )
            if score > 0:
                found.append((-score, number is None, number or 0, number))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


def frames(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id LONG, text STRING").selectExpr("*", "1 AS n", "2 AS rank", "3 AS score", "4 AS item")
    return docs, spark.createDataFrame(items, "item_id LONG, text STRING").selectExpr("*", "5 AS block", "6 AS term")


def generated(draw, n):
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i if i % 17 else None, " ".join(draw.choices(words, weights, k=draw.randint(0, 40)))) for i in range(n)]


def test_ranking_equals_all_scores(spark, monkeypatch):
    draw = random.Random(3)
    docs = [*generated(draw, 400), (5, None), (6, ""), (7, "w1 w59"), (7, "w1 w59"), (8, "?! ..")]
    items = [*generated(draw, 25), (1, "w59 w59 w58"), (2, ""), (3, None), (4, "unheard of"), (30, "Ümlaut W1 w1-w2_w3")]
    monkeypatch.setattr(search, "BLOCK_POSTINGS", 300)
    left, right = frames(spark, docs, items)
    expected = plainly(docs, items)
    assert Counter(map(tuple, search.ranked(left.repartition(3), right).collect())) == expected
    # Items in several blocks.
    assert Counter(map(tuple, search.ranked(left, right, item_bytes=2500).collect())) == expected


def test_defined_cases(spark):
    docs, items = frames(spark, [(1, "ab ab"), (None, "ab ab"), (0, "ab ab"), (3, "cd"), (4, None), (5, "x")], [(None, "AB"), (9, "zz")])
    assert [r["doc_id"] for r in sorted(search.ranked(docs, items).collect(), key=lambda r: r["rank"])] == [0, 1, None]
    assert search.ranked(docs.limit(0), items).count() == 0
    assert search.ranked(docs, items.limit(0)).count() == 0
    assert search.ranked(docs.where("doc_id = 4"), items).count() == 0


def test_no_accumulators_beyond_the_bound():
    # Two documents hold the rare term; the common one cannot lift the others past them.
    m = np.full(1000, 100)
    doc = np.concatenate([[3, 5], np.arange(1000)])
    term = np.concatenate([[0, 0], np.ones(1000, int)])
    block = search.Block(m, doc, term, np.ones(1002, np.int64), 2)
    docs, scores = block.best(np.array([0, 1]), np.array([500, 1]), 2, 0)
    assert docs.tolist() == [3, 5]
    unit = 10**9 // (1000 + 800)
    assert scores.tolist() == [501 * unit] * 2
    # With a better one known elsewhere nothing is looked at.
    assert not len(block.best(np.array([0, 1]), np.array([500, 1]), 2, 10**9)[0])


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = ("Aé b2 " * 5000 + "c" * 3000).encode()
    whole = search.count_terms(text)
    monkeypatch.setattr(search, "PART_BYTES", 7)
    assert search.count_terms(text) == whole == {"aé".encode(): 5000, b"b2": 5000, b"c" * 3000: 1}
