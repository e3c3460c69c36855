import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tidegauge.llm import decontaminate, quality, secrets

from .test_decontaminate import brute_force as leaks
from .test_jaccard import brute_force as components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, FOLDER).write.parquet(path)
        left = spark.read.parquet(path)
        out.append((name, docs, left))
        docs = left
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_the_stages_keep_the_columns(spark, stages):
    assert [n for n, *_ in stages] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(left.columns == columns for *_, left in stages[:-1])


def test_rejected_documents_go(spark, stages):
    _, docs, left = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = rows(left)
    right = [(doc_id in kept) == (labels[doc_id] == 1) for doc_id in rows(docs) if doc_id in labels]
    assert np.mean(right) > 0.9 and len(kept) < docs.count()


def test_one_document_of_each_group_stays(stages):
    _, docs, left = stages[1]
    of = components([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(rows(left)) == sorted(d for d, _, c in of if d == c)


def test_contaminated_documents_go(spark, stages):
    _, docs, left = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    short = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 20_000]
    found = {doc for doc, _ in leaks(short, items)}
    assert {d for d, _ in short} - set(rows(left)) == found


def test_secrets_are_replaced(stages):
    _, docs, left = stages[3]
    before, after = rows(docs), rows(left)
    assert set(before) == set(after)
    for doc_id, row in before.items():
        spans = secrets.find_spans(row.text or "")
        if spans:
            assert not any(row.text[s:e] in after[doc_id].text for _, s, e in spans)
        else:
            assert after[doc_id].text == row.text


def test_all_that_is_left_is_packed(stages):
    _, docs, left = stages[4]
    pieces = {}
    for r in left.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(rows(docs))
    assert all(sum(p.length for p in own) == own[0].doc_tokens for own in pieces.values())


def test_run_gives_the_last_stage(spark, stages):
    got = contract.queries()["pipeline"](spark, FOLDER)
    key = lambda df: sorted((r.doc_id, r.start, bytes(r.ids)) for r in df.collect())
    pieces = {}
    for doc_id, start, ids in key(got):
        pieces[doc_id] = pieces.get(doc_id, b"") + ids
    expected = {}
    for doc_id, start, ids in key(stages[-1][2]):
        expected[doc_id] = expected.get(doc_id, b"") + ids
    assert pieces == expected


def test_empty_documents_and_missing_labels(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_thresholds():
    assert quality.KEEP_SCORE == 0.3 and all(len(m) == 6 and max(m) < decontaminate.SPAN for m in decontaminate.MASKS)
