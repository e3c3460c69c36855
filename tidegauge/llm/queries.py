"""One query per operator, over whole tables, and the SQL equivalents where there are any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    chat,
    decontaminate,
    embeddings,
    fingerprints,
    jaccard,
    licences,
    packing,
    quality,
    runs,
    search,
    secrets,
    shards,
    urls,
)
from tidegauge.llm.tables import table
from tidegauge.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
SHARDS, SHARD_SEED = 8, 20
TOKENIZER = "word_bpe_49k.json"


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    size = F.octet_length(text).cast("long") + 1
    shuffled = shards.shuffle_shards(docs, "doc_id", size, SHARDS, SHARD_SEED)
    text = F.coalesce(F.encode("record.text", "UTF-8"), F.lit(b""))
    return shuffled.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shards.shard_of(F.col("record.doc_id"), SHARDS + 1, SHARD_SEED).alias("grown_shard"),
    )


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of a page are those of the document with its number; low quality or toxic is bad."""
    pages = table(spark, folder, "pages")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return urls.judge(pages, labels).drop("mined")


def op4_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def dealt(doc_id):
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of ``source / hundreds of the number / lang``; a first line is a folder's notice.

    By a hash of the number one in a hundred lies in ``source`` and others of one in ten in ``source / hundreds``;
    a licence of theirs, in whatever line, is that of their folder and those below.
    """
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    hundred = F.floor(F.col("doc_id") / 100).cast("string")
    # concat_ws leaves out nulls.
    hundred = F.when(F.coalesce(dealt(F.col("doc_id")) % 100 != 0, F.lit(True)), hundred)
    lang = F.when(F.coalesce(dealt(F.col("doc_id")) % 10 != 0, F.lit(True)), F.coalesce("lang", F.lit("")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), hundred, lang, F.col("doc_id").cast("string"))
    notice = (F.col("own.line") == 0) & (F.col("own.unit") == "line") | (dealt(F.col("file.doc_id")) % 10 == 0)
    found = licences.scan(docs.select("doc_id", path.alias("path"), "text"), notice)
    return found.select(
        F.col("file.doc_id").alias("doc_id"), F.col("file.path").alias("path"), "licence",
        F.col("own.cosine").alias("cosine"), F.col("own.unit").alias("unit"), F.col("own.line").alias("line"),
        "inherited_from",
    )


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The documents come in two arrivals by a hash of their number; of the second only contents new to the ledger are scanned."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = shared_folder(spark)
    second = F.coalesce(dealt(F.col("doc_id")) % 2 == 1, F.lit(False))
    for arrival in (docs.where(~second), docs.where(second)):
        known = secrets.update_ledger(arrival, ledger)
    found = secrets.findings(docs, known)

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("path.doc_id").alias("doc_id"),
        *[number(kind) for kind in secrets.BASE_KINDS],
        F.sha2(secrets.span_text(F.col("spans"), secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op7_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


def held_out(doc_id):
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0


def training_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "quality")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.scored(docs, quality.train(docs, training_labels(spark, folder)))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted"),
    )


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turn = F.col("id").cast("long")
    role = F.when(turn == 0, "user").otherwise("assistant")
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), F.lit(said).alias("text")
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_conversations(turns)
    read = formatted.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss_text"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.against_neighbours(table(spark, folder, "documents"))


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def with_cycles(docs: DataFrame) -> DataFrame:
    """One document in ten, by a hash of its number, repeats its words from some word on with some period."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    chosen = docs.select("*", hashed.alias("h"), F.when(hashed % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).alias("a")
    chosen = chosen.select("*", n.alias("n"), g.alias("g"), F.when(n > 0, a).alias("a"))
    period = 1 + F.call_function("div", F.col("n") - F.col("a"), 3 + F.col("g") % 8)
    chosen = chosen.select("*", period.alias("p"))
    cycled = F.transform(
        F.sequence(F.lit(0), (F.col("n") - 1).cast("int")),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return chosen.select(
        "doc_id", F.when(F.col("n") > 0, F.array_join(cycled, " ")).otherwise(F.col("text")).alias("text")
    )


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    found = runs.with_runs(with_cycles(docs))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        runs.longest(F.col("runs")).alias("longest"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )
    return found.select(
        "doc_id", "n_runs", "longest.*",
        F.call_function("div", 1000 * F.col("longest.length"), F.col("longest.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_shards": op2_shards,
    "op3_url_rules": op3_url_rules,
    "op4_benchmark": op4_benchmark,
    "op5_licences": op5_licences,
    "op6_secrets": op6_secrets,
    "op7_vectors": op7_vectors,
    "op8_jaccard": op8_jaccard,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
    "op11_fingerprints": op11_fingerprints,
    "op12_search": op12_search,
    "op13_runs": op13_runs,
}


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for mark in chat.CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


ORACLES: dict[str, str] = {
    "op10_chat": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, row_number() OVER w AS number, role IS NOT DISTINCT FROM lag(role) OVER w AS merged,
        {_escaped('text')} AS written, {_escaped('role')} AS written_role
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY number) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(written) + CASE WHEN merged THEN 8 ELSE length(written_role) + 13 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
""",
    "op12_search": """
WITH split AS (
    SELECT 0 AS kind, row_number() OVER () AS row, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 1, 0, item_id, coalesce(text, '') FROM benchmark
), terms AS (
    SELECT kind, row, id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM split
), held AS (SELECT row, id AS doc_id, term, count(*) AS tf FROM terms WHERE kind = 0 GROUP BY ALL),
asked AS (SELECT id AS item_id, term, count(*) AS repeats FROM terms WHERE kind = 1 GROUP BY ALL),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM held GROUP BY row),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, whole GROUP BY term, docs
), scored AS (
    SELECT item_id, row, doc_id,
        sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (row), whole
    GROUP BY item_id, row, doc_id
), placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
""",
}
