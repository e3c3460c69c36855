"""URL filter by association rules: FP-growth over URL tokens and labels, matched by an inverted index.

Listed rules of host and path decide first, the longest that fits. The rest is judged by mined rules:
FP-growth finds token combinations that frequently go with a bad label; rules below the confidence
bound, and rules that a shorter one covers, are pruned. How often is a number of bad pages, the same at
every size of the table, so that a rare host is learned as soon as there is evidence. Tokens of fewer bad
pages are in no rule and are left out first; tokens that the labelled URLs hold always together are one
item, lest a dozen query keys of one link make thousands of combinations, and a rule names them all.
Where more than ``ITEMS`` items are left, combinations are mined by class of their rarest item. Each rule is indexed under its rarest token,
so that a page meets only the rules of tokens it has, whatever token most pages share.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no tokens, and is
allowed; pages with a null label are not learned from; of repeated labels of one page the worst
counts; an empty label table yields no mined rules; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import written

#: (verdict, host, path), as given.
LISTED = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
BAD = "bad"
#: Share of the labelled pages that a rule must rest on besides; 0: the number of pages alone decides.
MIN_SUPPORT = 0.0
MIN_CONFIDENCE = 0.6
#: Bad pages a rule must rest on: fewer prove nothing, however small the table.
MIN_PAGES = 20
#: Items of one run of FP-growth, whose driver holds their names and counts.
ITEMS = 200_000
#: Broadcast the mined rules up to this number (a rule has few short tokens).
BROADCAST_RULES = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels, path segments (numbers as one token), query keys."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    parts = [
        F.transform(F.split(host_of(url), r"\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(
            F.split(path_of(url), "/"),
            lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, r"^[0-9]+$", "0")),
        ),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^[^=]*", 0))),
    ]
    present = F.filter(F.concat(*parts), lambda x: ~F.endswith(x, F.lit(":")))
    return F.coalesce(F.array_distinct(present), F.expr("cast(array() as array<string>)"))


def _items(urls: DataFrame, needed: int) -> DataFrame:
    """Items of the tokens of at least ``needed`` bad pages: ``item`` and its ``members``, which the URLs hold always together.

    ``urls`` holds distinct ``tokens`` with their hash ``own``, ``pages`` and ``bad`` pages. Names sort by number of
    pages, fewest first.
    """
    token = urls.select("own", "pages", "bad", F.explode("tokens").alias("token"))
    # Tokens of the same URLs have the same sums of their hashes.
    same = [F.bit_xor(F.xxhash64(F.lit(k), "own")).alias(f"same_{k}") for k in range(2)]
    counted = token.groupBy("token").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"), *same)
    items = counted.where(F.col("bad") >= needed).groupBy("pages", "same_0", "same_1").agg(
        F.array_sort(F.collect_set("token")).alias("members")
    )
    name = F.concat(F.lpad(F.col("pages").cast("string"), 18, "0"), F.lit(" "), F.col("members")[0])
    return items.select(name.alias("item"), "members")


def _class(item: Column, classes: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(classes))


def _mined(baskets: DataFrame, needed: int, min_confidence: float, k: int, classes: int) -> DataFrame | None:
    """Rules over ``items`` whose rarest item is in class ``k``: ``items``, ``confidence``, ``bad_pages``."""
    if classes > 1:
        # Sorted from the rarest on, the items of such a rule begin at one of class k.
        first = F.array_position(F.transform("items", lambda x: _class(x, classes) == k), F.lit(True)).cast("int")
        held = baskets.select("bad", "items", first.alias("first")).where("first > 0")
        baskets = held.select("bad", F.slice("items", F.col("first"), F.size("items")).alias("items"))
    count = baskets.count()
    if count < needed:
        return None
    bad = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    # FP-growth rounds its least count up from the share.
    growth = FPGrowth(itemsCol="items", minSupport=(needed - 0.5) / count, minConfidence=min_confidence)
    found = growth.fit(baskets.select(F.concat("items", bad).alias("items"))).associationRules
    rules = found.where(F.col("consequent")[0] == BAD).select(
        F.array_sort("antecedent").alias("items"), "confidence", F.round(F.col("support") * count).cast("long").alias("bad_pages")
    )
    return rules.where(_class(F.col("items")[0], classes) == k)


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Rules ``tokens -> bad`` from ``url`` and boolean ``bad``: ``tokens``, ``confidence``, ``support``.

    A rule is dropped if its confidence does not exceed that of a rule over a part of its tokens.
    """
    known = written(
        labelled.where(F.col("bad").isNotNull()).select(F.array_sort(tokens_of(F.col("url"))).alias("tokens"), "bad")
    )
    count = known.count()
    needed = max(min_pages, math.ceil(min_support * count))
    # Alike URLs are counted before their tokens are.
    of_urls = known.groupBy("tokens").agg(F.count("*").alias("pages"), F.count_if("bad").alias("bad"))
    of_urls = written(of_urls.withColumn("own", F.xxhash64("tokens")))
    items = written(_items(of_urls, needed))
    placed = of_urls.select("own", F.explode("tokens").alias("token")).join(
        items.select("item", F.explode("members").alias("token")), "token"
    )
    held = placed.groupBy("own").agg(F.array_sort(F.collect_set("item")).alias("items"))
    baskets = written(known.select(F.xxhash64("tokens").alias("own"), "bad").join(held, "own").select("items", "bad"))
    classes = -(-items.count() // ITEMS)
    mined = [_mined(baskets, needed, min_confidence, k, classes) for k in range(classes)]
    mined = [rules for rules in mined if rules is not None]
    if not mined:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support double")
    rules = written(reduce(DataFrame.unionByName, mined))
    item = F.explode("items").alias("item")
    # A covering rule shares its rarest item with the rule it covers.
    by_first = rules.select(
        F.col("items")[0].alias("item"), F.col("items").alias("part"), F.col("confidence").alias("part_confidence")
    )
    covered = (
        rules.select("items", "confidence", item)
        .join(by_first, "item")
        .where(
            (F.size("part") < F.size("items"))
            & (F.col("part_confidence") >= F.col("confidence"))
            & (F.size(F.array_except("part", "items")) == 0)
        )
        .select("items")
        .distinct()
    )
    left = rules.join(covered, "items", "left_anti")
    return (
        left.select("items", "confidence", "bad_pages", item)
        .join(items, "item")
        .groupBy("items", "confidence", "bad_pages")
        .agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens"))
        .select("tokens", "confidence", (F.col("bad_pages") / F.lit(max(count, 1))).alias("support"))
    )


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``page_id`` of the pages whose URL holds all tokens of a rule.

    ``pages`` holds page_id and url. A rule is looked up under its rarest token.
    """
    urls = pages.select("page_id", tokens_of(F.col("url")).alias("tokens"))
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    frequency = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("pages"))
    known = F.struct(F.coalesce("pages", F.lit(0)).alias("pages"), "token")
    counted = wanted.join(frequency, "token", "left").select("token", known.alias("known"))
    index = (
        rules.select("tokens", F.explode("tokens").alias("token"))
        .join(counted, "token")
        .groupBy(F.col("tokens").alias("rule"))
        .agg(F.min("known")["token"].alias("token"))
    )
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    postings = urls.select("page_id", "tokens", F.explode("tokens").alias("token"))
    hits = postings.join(index, "token").where(F.size(F.array_except("rule", "tokens")) == 0)
    return hits.select("page_id").distinct()


def listed_rule(host: Column, path: Column, rules=LISTED) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest listed rule that fits, or null."""
    fitting = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fitting))


def judge(pages: DataFrame, labels: DataFrame, listed=LISTED, **mining) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and ``mined`` (a mined rule matches).

    ``labels`` holds page_id and boolean ``bad``. One row per page row, repeated ones included.
    """
    bad = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    urls = pages.select("page_id", "url")
    rules = written(mine_rules(urls.join(bad, "page_id"), **mining))
    matched = match_rules(urls, rules).withColumn("mined", F.lit(True))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    mined = F.coalesce("mined", F.lit(False))
    return (
        urls.join(matched, "page_id", "left")
        .select("page_id", host.alias("host"), path.alias("path"), mined.alias("mined"))
        .withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed))
        .select(
            "page_id", "host", "path", F.col("listed.rule").alias("rule"),
            F.coalesce("listed.verdict", F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"),
            "mined",
        )
    )
