import random
import re
from collections import Counter

from tidegauge.llm import decontaminate as d
from tidegauge.llm import queries

SCHEMA = "doc_id LONG, text STRING"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute_force(docs, items):
    """All (doc_id, item_id) with a seed of equal words in a window of enough equal words, on any diagonal.

    A diagonal is tried if enough words on it are equal at all. Items without room for a seed: all their words in a row.
    """
    out = set()
    others = [(item_id, words(item)) for item_id, item in items]
    for doc_id, text in docs:
        own = words(text)
        places = {}
        for p, word in enumerate(own):
            places.setdefault(word, []).append(p)
        for item_id, other in others:
            n = len(other)
            if n < d.SPAN:
                starts = places.get(other[0], []) if n else []
                if any(own[p : p + n] == other and (n >= d.ALONE or len(own) == n) for p in starts):
                    out.add((doc_id, item_id))
                continue
            needed = -(-68 * min(d.WINDOW, n) // 100)
            # places in the item; the document's place is ``q - shift``
            met = Counter(q - p for q, word in enumerate(other) for p in places.get(word, []))
            for shift, count in met.items():
                if count < needed:
                    continue
                equal = [0 <= q - shift < len(own) and own[q - shift] == other[q] for q in range(n)]
                for q in range(n - d.SPAN + 1):
                    if not any(all(equal[q + m] for m in mask) for mask in d.MASKS):
                        continue
                    if any(sum(equal[max(0, q + k) : q + k + d.WINDOW]) >= needed for k in range(-d._BEFORE, 1)):
                        out.add((doc_id, item_id))
    return out


def result(spark, docs, items, schema=SCHEMA):
    got = d.contaminated(
        spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id LONG, text STRING, seed INT, needed INT")
    )
    rows = got.collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id) for r in rows}


def planted(seed, substitute):
    draw = random.Random(seed)
    text = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(text(draw.choice([5, 9, 10, 15, 30, 60]))), 0, 0) for i in range(20)]
    docs = []
    for i in range(60):
        own = text(draw.randint(0, 80))
        if i % 2:
            passage = items[draw.randrange(20)][1].split()
            passage = [f"x{draw.randrange(99)}" if draw.random() < substitute else w for w in passage]
            at = draw.randint(0, len(own))
            own[at:at] = passage
        docs.append((i, " ".join(w.upper() if draw.random() < 0.3 else w + draw.choice(["", ",", "."]) for w in own)))
    return docs, items


def test_equals_brute_force(spark):
    for seed, substitute in enumerate([0.0, 0.1, 0.2, 0.3]):
        docs, items = planted(seed, substitute)
        expected = brute_force(docs, [i[:2] for i in items])
        assert expected and result(spark, docs, items) == expected


def test_blocks_of_seeds_find_the_same(spark, monkeypatch):
    docs, items = planted(7, 0.1)
    expected = result(spark, docs, items)
    monkeypatch.setattr(d, "BLOCK_SEEDS", 400)
    assert result(spark, docs, items) == expected


def test_a_passage_with_every_fifth_word_replaced_is_found(spark):
    item = [f"w{i}" for i in range(40)]
    for start in range(5):
        text = ["x" if (i + start) % 5 == 0 else w for i, w in enumerate(item)]
        assert result(spark, [(1, " ".join(text))], [(2, " ".join(item), 0, 0)]) == {(1, 2)}


def test_defined_cases(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    repeated = "la " * 3000
    docs = [(1, None), (2, ""), (3, passage), (3, passage), (None, passage), (4, "... " + passage), (5, repeated), (6, "x " * 200_000 + passage)]
    items = [(1, passage, 0, 0), (2, passage, 0, 0), (3, None, 0, 0), (4, "one two three", 0, 0), (5, repeated, 0, 0), (None, passage, 0, 0)]
    expected = {(doc, item) for doc in (3, None, 4, 6) for item in (1, 2, None)} | {(5, 5)}
    assert result(spark, docs, items) == expected
    assert result(spark, [], items) == set()
    assert result(spark, docs, []) == set()
    assert result(spark, [(1, passage, 2, "s")], items[:1], SCHEMA + ", item_id INT, words STRING") == {(1, 1)}


def test_short_items(spark):
    items = [(1, "Paris, of course", 0, 0), (2, "a b c d e", 0, 0), (3, "a b c d", 0, 0), (4, "yes", 0, 0), (5, "1 2 3 4 5 6 7 8 9", 0, 0), (6, "", 0, 0)]
    docs = [
        (1, "paris of COURSE"), (2, "Paris, of course, is a city."), (3, "x a, b, c, d, e y"), (4, "a b c d x e"), (5, "a b c d"),
        (6, "yes"), (7, "yes yes"), (8, "0 1 2 3 4 5 6 7 8 9"), (9, "1 2 3 4 5 6 7 8 x"), (10, "c d e"), (11, None), (None, "Yes!"),
    ]
    expected = {(1, 1), (3, 2), (5, 3), (6, 4), (None, 4), (8, 5)}
    assert brute_force(docs, [i[:2] for i in items]) == expected
    assert result(spark, docs, items) == expected


def test_removal_keeps_columns_and_clean_rows(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, passage, 5), (2, "clean text", 6), (None, "also clean", 7)], "doc_id LONG, text STRING, item_id INT")
    items = spark.createDataFrame([(1, passage)], "item_id LONG, text STRING")
    left = d.decontaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.item_id for r in left.collect()) == [6, 7]


def test_no_python_in_the_plan(spark):
    docs, items = planted(1, 0.1)
    got = d.contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([i[:2] for i in items], "item_id LONG, text STRING"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op4_benchmark(spark, folder).collect()}
    assert got == brute_force(docs, items)
