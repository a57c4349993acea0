"""URL filter by association rules.

Labelled URLs become sets of tokens (labels of the host and words in them,
segments of the path, names in the query, the scheme).  Spark's FP-growth mines
token combinations that go with the bad label; rules of enough support and
confidence stay, all of them but those that a shorter rule of at least their
confidence implies.  An inverted index matches them: a rule is entered under its
token that the fewest labelled URLs have, and fires when a URL with that token has all
others too.  Listed host and path rules come before mined ones.

SQL functions and the JVM's FP-growth only.  Null URLs and those without
``://`` have no host, path or tokens and are allowed; rows with the same
page_id and URL are judged alike; without bad labels nothing is mined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Labelled pages that are mined at most; they bound the rules.
MAX_TRAIN = 50_000
#: Labelled pages a rule must hold for, and the least share of bad ones.
SUPPORT, CONFIDENCE = 30, 0.5
_BAD = "label=bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits a host, its subdomains, and paths that start with a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)


def listed(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL; a number counts as a number, whichever it is."""
    host, path = host_of(url), F.lower(path_of(url))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    words = F.flatten(F.transform(labels, lambda x: F.split(x, "-")))
    segments = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, r"\d+", "0"))
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))

    def marked(mark: str, x: Column) -> Column:
        return F.transform(F.filter(x, lambda t: t != ""), lambda t: F.concat(F.lit(mark), t))

    scheme = F.array(F.lower(F.substring_index(url, "://", 1)))
    every = F.concat(marked("host:", labels), marked("word:", words), marked("path:", segments), marked("query:", names), marked("scheme:", scheme))
    return F.when(F.contains(url, F.lit("://")), F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def mine(pages: DataFrame, labels: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, max_train: int = MAX_TRAIN) -> DataFrame:
    """rule (a number), tokens, confidence, pages and anchor (its rarest token) of every rule; labels: page_id and bad (boolean)."""
    some = labels.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    some = some.orderBy(F.xxhash64("page_id"), "page_id").limit(max_train)  # the documented bound of the sample
    known = pages.select("page_id", "url").join(some, "page_id").select(tokens(F.col("url")).alias("t"), "bad")
    known = stage(known.select(F.when(F.col("bad"), F.array_append("t", F.lit(_BAD))).otherwise(F.col("t")).alias("items")), "labelled")
    n = known.count()
    schema = "rule int, tokens array<string>, confidence double, pages long, anchor string"
    if not n:
        return known.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support / n), minConfidence=1.0).fit(known)
    sets = stage(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    every_token = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    bad = F.array_contains("items", _BAD)
    both = sets.where(bad & (F.size("items") > 1)).select(F.array_remove("items", _BAD).alias("tokens"), F.col("freq").alias("pages"))
    every = both.join(sets.where(~bad).select(F.col("items").alias("tokens"), "freq"), "tokens")
    every = stage(every.select("tokens", (F.col("pages") / F.col("freq")).alias("confidence"), "pages"), "rules")
    # with a combination, all parts of it are frequent: the most confident part of any size comes up token by token
    level = every.where(F.size("tokens") == 1).withColumn("part", F.lit(-1.0))
    kept = level
    for size in range(2, (every.agg(F.max(F.size("tokens"))).first()[0] or 0) + 1):
        below = level.select(F.col("tokens").alias("shorter"), F.greatest("confidence", "part").alias("part"))
        parts = every.where(F.size("tokens") == size).withColumn("shorter", F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))))
        level = stage(parts.join(below, "shorter").groupBy("tokens", "confidence", "pages").agg(F.max("part").alias("part")), "level")
        kept = kept.unionByName(level)
    kept = kept.where((F.col("confidence") >= confidence) & (F.col("confidence") > F.col("part")))
    number = F.row_number().over(Window.orderBy(F.size("tokens"), "tokens")) - 1  # only of rules that nothing shorter implies
    kept = stage(kept.select(number.alias("rule"), "tokens", "confidence", "pages"), "kept")
    single = every_token.join(kept.select("rule", F.explode("tokens").alias("token")), "token")
    rarest = single.groupBy("rule").agg(F.min(F.struct("freq", "token"))["token"].alias("anchor"))
    return stage(kept.join(rarest, "rule"), "anchored")


def fired(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, url, and the most confident rule of all whose tokens a URL has."""
    index = rules.select("rule", "confidence", F.col("tokens").alias("needed"), F.col("anchor").alias("token"))
    rows = pages.select("page_id", "url").distinct().withColumn("had", tokens(F.col("url")))
    rows = rows.select("page_id", "url", "had", F.explode("had").alias("token"))
    # the rules are a written table: Spark broadcasts the index where it is small enough
    met = rows.join(index, "token").where(F.size(F.array_except("needed", "had")) == 0)
    return met.groupBy("page_id", "url").agg(F.max(F.struct("confidence", "rule")).alias("fired"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, verdict, and mined (the number of the mined rule that fired)."""
    hits = fired(pages, mine(pages, labels)).select(F.col("page_id").alias("_page"), F.col("url").alias("_url"), "fired")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = listed(rules, F.col("host"), F.col("path"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    joined = rows.join(hits, F.col("page_id").eqNullSafe(F.col("_page")) & F.col("url").eqNullSafe(F.col("_url")), "left")
    method = F.when(F.col("fired").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "url", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.col("fired.rule").alias("mined"))
