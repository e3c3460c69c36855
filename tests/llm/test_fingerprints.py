import hashlib
import random

import pytest

from tidegauge.llm import fingerprints, queries
from tidegauge.llm.tables import table

FOLDER = "/root/testdata/sf0.001"


def prose(draw, words):
    letters = "etaoinshrdlu"
    return " ".join("".join(draw.choices(letters, k=draw.randint(1, 8))) for _ in range(words))


def edited(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        place = draw.randrange(len(letters))
        letters[place : place + draw.randint(0, 1)] = draw.choice(["", "x", "q"])
    return "".join(letters)


def test_walk_equals_the_plain_walk(monkeypatch):
    """One bit for a step and a character decides whether the walk moves on."""
    monkeypatch.setattr(fingerprints, "PART", 100)
    text = prose(random.Random(2), 400) + "é漢\U0001f600"
    walker = fingerprints.Walker()
    places, end = walker.walk(text)
    at, step, shown = 0, 0, []
    while at < len(text):
        shown.append(at)
        moved = walker.moves[text[at]][step % fingerprints.PERIOD]
        at, step = at + (moved == (step + 1) % fingerprints.PERIOD), step + 1
    assert end == len(shown)
    assert places.tolist() == [shown[s] for s in fingerprints._STEPS if s < end]
    # From the middle on, as from the start.
    first, middle = walker.walk(text[:777])
    rest, _ = walker.walk(text[777:], middle)
    assert [*first, *(rest + 777)] == places.tolist()


def test_likeness_follows_edits():
    draw = random.Random(5)
    for words in (30, 300, 3000):
        text = prose(draw, words)
        own = fingerprints.fingerprint(text)
        near = fingerprints.likeness(own, fingerprints.fingerprint(edited(draw, text, max(1, words // 60))))
        half = fingerprints.likeness(own, fingerprints.fingerprint(text[: len(text) // 2] + prose(draw, words)[: len(text) // 2]))
        far = fingerprints.likeness(own, fingerprints.fingerprint(prose(draw, words)))
        assert fingerprints.likeness(own, fingerprints.fingerprint(text)) == 1
        assert near > 0.7 and 0.35 < half < 0.65 and far < 0.2


def test_shared_bands_are_those_in_both():
    draw = random.Random(4)
    for words in (0, 1, 3, 40, 41, 300):
        text = prose(draw, words)
        for other in (text, edited(draw, text or "a", 2), text[: len(text) // 2] + prose(draw, words), prose(draw, 3 * words)):
            a, b = fingerprints.fingerprint(text), fingerprints.fingerprint(other)
            assert fingerprints.shared_bands(a, b) == len(set(fingerprints.bands(a)) & set(fingerprints.bands(b)))


def test_query_against_plain_texts(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    rows = sorted(rows, key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in queries.op11_fingerprints(spark, FOLDER).collect()}
    assert len(got) == len(rows)
    halves, others = [], []
    for row, after in zip(rows, rows[1:] + rows[:1]):
        text, following, found = row["text"] or "", after["text"] or "", got[row["doc_id"]]
        half = len(text) // 2
        other = text[: len(text) - half] + following[:half]
        assert found["n_chars"] == len(text)
        assert found["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        assert found["fingerprint"] == fingerprints.fingerprint(text)
        assert found["edited_fingerprint"] == fingerprints.fingerprint(other)
        assert found["near_edited"] == fingerprints.likeness(found["fingerprint"], found["edited_fingerprint"])
        assert found["near_next"] == fingerprints.likeness(found["fingerprint"], fingerprints.fingerprint(following))
        halves.append(found["near_edited"])
        others.append(found["near_next"])
    assert sorted(halves)[10] > 0.3 and sorted(others)[len(others) // 2] < 0.1


ROWS = [(None, "last"), (1, ""), (1, None), (2, "x"), (3, "long text " * 3000), (3, "long text " * 3000), (9, "ab")]


@pytest.mark.parametrize("parts", [1, 5])
def test_neighbours_in_order(spark, parts):
    docs = spark.createDataFrame(ROWS, "doc_id LONG, text STRING").selectExpr("*", "1 AS part", "2 AS opens", "3 AS row")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = fingerprints.against_neighbours(docs.repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    long = "long text " * 3000
    edits = {9: "al", 3: (long, long[:15_000] + "x"), 2: "x", 1: ("", ""), None: "laab"}
    expected = [(9, "al"), (3, edits[3][0]), (3, edits[3][1]), (2, "x"), (1, ""), (1, ""), (None, "laab")]
    hashed = sorted(((n or 0, hashlib.sha256(t.encode()).hexdigest()) for n, t in expected))
    assert sorted((r["doc_id"] or 0, r["edited_sha256"]) for r in got) == hashed
    assert {r["near_edited"] for r in got if r["doc_id"] in (1, 2)} == {1.0}
    assert fingerprints.against_neighbours(docs.limit(0)).count() == 0
    alone = fingerprints.against_neighbours(docs.where("doc_id = 9")).first()
    assert (alone["near_next"], alone["edited_sha256"]) == (1.0, hashlib.sha256(b"aa").hexdigest())


def test_matches_are_all_alike_texts(spark):
    draw = random.Random(8)
    texts = [prose(draw, draw.randint(3, 400)) for _ in range(60)]
    copies = [edited(draw, t, len(t) // 400 + 1) for t in texts] + texts[:10]
    docs = [(i, t) for i, t in enumerate(texts + copies)] + [(500, ""), (501, None), (None, texts[0])]
    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING").selectExpr("*", "1 AS band", "2 AS met")
    asked = frame.where("doc_id % 20 = 0")
    prints = [(i, fingerprints.fingerprint(t or "")) for i, t in docs]
    least = 0.85
    expected = {
        (a, b): fingerprints.likeness(p, q) for a, p in prints if a is not None and a % 20 == 0 for b, q in prints
        if fingerprints.likeness(p, q) >= least
    }
    got = {(r["query_id"], r["doc_id"]): r["likeness"] for r in fingerprints.matches(asked, frame, least).collect()}
    assert got == expected and len(got) > 15
    assert fingerprints.matches(asked.limit(0), frame).count() == 0
    assert fingerprints.matches(asked, frame.limit(0)).count() == 0
