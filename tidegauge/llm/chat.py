"""Chat formatting with Spark expressions: sorted turns, merged neighbours, escaped control strings.

A conversation becomes one string of messages::

    <|role|>
    text<|next|>text<|end|>

Adjacent turns of one role share a message, their texts divided by ``<|next|>``, so that the turns
can be read back. Control strings inside texts and roles get a backslash after their first
character, and a backslash is doubled; dropping one backslash before any character undoes both.

Defined cases: a null text or role counts as empty; turns with equal number are ordered by role and
text, null numbers first; repeated rows are repeated turns; a null conversation id is one conversation; an
empty table gives no rows; other columns are ignored. A conversation is one output value, so its
turns meet in one task, as the method demands; it is bounded by the largest string Spark can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
OPEN, CLOSE, NEXT, END = "<|", "|>\n", "<|next|>", "<|end|>\n"
#: What must not occur inside a text: this template's marks and those of a common other one.
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]"]


def escape(text: Column) -> Column:
    """``text`` without control strings; undone by :func:`unescape`."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, and ``loss``, the spans of assistant text.

    A span holds ``start`` and ``end`` in code points of ``formatted``, end exclusive.
    """
    of_turn = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(
        F.sort_array(F.collect_list(of_turn)).alias("turns")
    )

    def piece(t: Column, i: Column) -> Column:
        # get() is null before the first turn, which therefore opens a message.
        same = F.coalesce(F.get("turns", i - 1)["role"] == t["role"], F.lit(False))
        opening = F.concat(
            F.when(i == 0, "").otherwise(END), F.lit(OPEN), escape(t["role"]), F.lit(CLOSE)
        )
        return F.struct(
            F.when(same, NEXT).otherwise(opening).alias("mark"),
            escape(t["text"]).alias("body"),
            (t["role"] == LOSS_ROLE).alias("loss"),
        )

    def add_span(state: Column, p: Column) -> Column:
        start = state["at"] + F.char_length(p["mark"])
        end = start + F.char_length(p["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(p["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans")
        )

    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    state = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])), "")
    return pieces.select(
        "conv_id",
        F.concat(joined, F.lit(END)).alias("formatted"),
        F.aggregate("pieces", state, add_span, lambda s: s["spans"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, each with ``role`` and ``text``."""
    messages = F.split(formatted, r"<\|end\|>\n", -1)

    def of_message(message: Column) -> Column:
        close = F.locate(CLOSE, message)
        role = unescape(F.substr(message, F.lit(len(OPEN) + 1), close - (len(OPEN) + 1)))
        texts = F.split(F.substr(message, close + len(CLOSE)), r"<\|next\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(F.slice(messages, F.lit(1), F.size(messages) - 1), of_message))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss spans, unescaped, in order."""
    part = F.transform(
        loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return F.array_join(part, "")
