import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import chat, queries

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "<|end|>\n", "<|next|>", "<|", "|>", "\\", "\n", "a", "é", "𝄞", "$1", ""]


def formatted(spark, rows, schema=SCHEMA):
    got = chat.format_conversations(spark.createDataFrame(rows, schema))
    read = got.select(
        "conv_id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("text"),
    )
    return {r.conv_id: r for r in read.collect()}


def test_hostile_turns_are_read_back(spark):
    draw = random.Random(1)
    rows = []
    for conv in range(40):
        for turn in range(draw.randint(1, 6)):
            text = "".join(draw.choices(PIECES, k=draw.randint(0, 8)))
            role = draw.choice(["user", "assistant", "system", "a|>\nb", "x\\"])
            rows.append((conv, turn, role, text))
    got = formatted(spark, draw.sample(rows, len(rows)))
    for conv in range(40):
        own = [(role, text) for c, _, role, text in rows if c == conv]
        assert [(t.role, t.text) for t in got[conv].turns] == own
        assert got[conv].text == "".join(text for role, text in own if role == "assistant")
        spans = [got[conv].formatted[s.start : s.end] for s in got[conv].loss]
        assert len(spans) == sum(role == "assistant" for role, _ in own)
        assert not any(mark in span for span in spans for mark in chat.CONTROL)


def test_neighbours_of_one_role_share_a_message(spark):
    got = formatted(spark, [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 3, "assistant", "d"), (1, 1, "user", "b")])
    assert got[1].formatted == "<|user|>\na<|next|>b<|next|>c<|end|>\n<|assistant|>\nd<|end|>\n"


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, "n")]
    got = formatted(spark, rows)
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "")]
    assert [(t.role, t.text) for t in got[1].turns] == [("", "n"), ("user", "a"), ("user", "a"), ("user", "b")]


def test_empty_table_and_other_columns(spark):
    assert formatted(spark, []) == {}
    got = formatted(spark, [(1, 0, "assistant", "x", "f", 7)], SCHEMA + ", formatted STRING, turns INT")
    assert got[1].text == "x"


def test_long_text(spark):
    text = "ab<|é" * 400_000
    assert formatted(spark, [(1, 0, "assistant", text)])[1].text == text


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    answer = connection.execute(queries.ORACLES["op10_chat"])
    columns = [d[0] for d in answer.description]
    expected = {tuple(row) for row in answer.fetchall()}
    got = queries.op10_chat(spark, folder)
    assert {tuple(r) for r in got.select(columns).collect()} == expected
    own = [r for r in got.collect() if r.conv_id == -1]
    said = "</s>[INST] ok [/INST]"
    assert own[0].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
