"""Secret scan through a ledger of text contents.

Every version of every text is addressed by the SHA-256 of its UTF-8 bytes. The ledger keeps, per
content and version of the rules, the spans found; only pairs it does not know are scanned, once
each, however many paths share a content. It is a table in a folder, to which each arrival of texts adds what it brings
(:func:`update_ledger`); an arrival that was repeated after a failure adds nothing, and rows that are there twice count
once. Findings are joined back to all paths.

Rules (``RULES``) find leftmost non-overlapping matches per kind. A span is ``kind``, ``start``,
``end`` in code points, end exclusive; spans are ordered by start, then by the kind's place in the
list.

Defined cases: a null text is an empty one; texts are scanned whole; repeated rows each get the
findings of their content; null paths are paths like any other; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import textops
from tidegauge.session import shared_folder

#: Kind, pattern, the group whose length counts, and its least length. The first three.
RULES = [
    (
        "assign",
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("github", r"gh[opusr]_[A-Za-z0-9]+", 0, 40),
    ("webtoken", None, 0, 40),
    ("privatekey", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
]
BASE_KINDS = ("assign", "access", "hex")
RULES_VERSION = "1"
SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
REDACTED = "[SECRET]"
#: Contents with findings are broadcast to the redaction up to this number; beyond it they are joined by shuffle.
BROADCAST_CONTENTS = 100_000

_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


_DOTTED = re.compile(r"[A-Za-z0-9_.-]+")


def _web_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Three parts joined by dots, of which the first two begin with ``eyJ`` and go on; in time linear in the text."""
    if ".eyJ" not in text:
        return
    for run in _DOTTED.finditer(text):
        if ".eyJ" not in run[0]:
            continue
        parts, at, i = run[0].split("."), run.start(), 0
        while i + 2 < len(parts):
            first = parts[i].find("eyJ")
            if 0 <= first < len(parts[i]) - 3 and parts[i + 1][:3] == "eyJ" and len(parts[i + 1]) > 3 and parts[i + 2]:
                end = at + len(parts[i]) + len(parts[i + 1]) + len(parts[i + 2]) + 2
                yield at + first, end
                at, i = end + 1, i + 3
            else:
                at, i = at + len(parts[i]) + 1, i + 1


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text."""
    found = []
    for place, (kind, pattern, group, least) in enumerate(RULES):
        if pattern is None:
            found += [(start, place, end, kind) for start, end in _web_tokens(text) if end - start >= least]
            continue
        # A run of 32 hexadecimal digits is the same whether shorter runs are passed over or dropped.
        pattern = "[0-9a-f]{32,}" if kind == "hex" else pattern
        for m in re.finditer(pattern, text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), place, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


@F.arrow_udf(SPANS)
def _scan(texts: pa.Array) -> pa.Array:
    rows = [
        [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text.as_py() or "")] for text in texts
    ]
    return pa.array(rows, _SPANS_ARROW)


def content_of(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"), 256)


def scan_unseen(texts: DataFrame, ledger: DataFrame, text: str = "text") -> DataFrame:
    """Ledger rows for the contents of ``texts`` that ``ledger`` lacks under the present rules."""
    textops.small_batches(texts.sparkSession)
    content = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    unseen = texts.select(content_of(F.col(text)).alias("content"), content)
    known = ledger.where(F.col("version") == RULES_VERSION).select("content")
    # Both need the rows of a content together: one shuffle.
    once = unseen.join(known, "content", "left_anti").dropDuplicates(["content"])
    return once.select("content", F.lit(RULES_VERSION).alias("version"), _scan("text").alias("spans"))


LEDGER = T.StructType().add("content", "string").add("version", "string").add("spans", SPANS)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger in the folder ``path``, a row for each content and version of the rules; empty before the first arrival."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def update_ledger(texts: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Add the contents of ``texts`` that the ledger in ``path`` lacks, and give the whole ledger.

    Without ``path`` a new ledger is made in the shared folder.
    """
    spark = texts.sparkSession
    path = path or shared_folder(spark)
    scan_unseen(texts, read_ledger(spark, path), text).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def findings(paths: DataFrame, ledger: DataFrame, text: str = "text") -> DataFrame:
    """``paths`` without its text, and the spans of each row's content under the present rules."""
    kept = [F.col(f"`{c}`") for c in paths.columns if c != text]
    own = paths.select(F.struct(*kept).alias("path"), content_of(F.col(text)).alias("content"))
    known = ledger.where(F.col("version") == RULES_VERSION).dropDuplicates(["content"]).select("content", "spans")
    return own.join(known, "content").select("path", "content", "spans")


@F.arrow_udf(T.StringType())
def _redact(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist()):
        parts, at = [], 0
        for span in found:
            if span["end"] > at:
                if span["start"] >= at:
                    parts += [text[at : span["start"]], REDACTED]
                at = span["end"]
        out.append("".join([*parts, text[at:]]))
    return pa.array(out, pa.string())


def redacted(docs: DataFrame, ledger: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span found replaced by a mark; the columns stay as they are."""
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    secret = ledger.where((F.col("version") == RULES_VERSION) & (F.size("spans") > 0))
    secret = secret.dropDuplicates(["content"]).select("content", "spans")
    if secret.count() <= BROADCAST_CONTENTS:
        secret = F.broadcast(secret)
    found = docs.select(record, content_of(F.col(text)).alias("content")).join(secret, "content", "left")
    old = F.col(f"record.`{text}`").cast("string")
    new = F.when(F.col("spans").isNull(), old).otherwise(_redact(F.coalesce(old, F.lit("")), F.coalesce("spans", F.array())))
    return found.select(*[(new if c == text else F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def span_text(spans: Column, kinds=None) -> Column:
    """``kind:start:end`` of the spans (of ``kinds`` only, if given), comma-joined."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
