"""URL verdicts: curated host and path rules first, then rules mined from labelled URLs by FP-growth.

Mined rules are combinations of URL tokens that come with the bad label often enough (support) and seldom without it
(confidence). They are matched by an inverted index: a rule is filed under its rarest token, looked up by the tokens
of a URL, and then checked whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import stage

BAD = "label:block"
#: Up to so many mined rules the index goes to every task; it is counted before. More are joined by a shuffle.
SMALL_INDEX = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is ``host/path``: it fits the host and its subdomains where the url's path starts with ``/path``."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def curated(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else NULL. ``rules`` is a list written by hand."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: host labels, top-level domain, path segments (numbers as ``#``), file ending, query keys."""
    host, path = host_of(url), path_of(url)
    labels, segments = F.split(host, r"\."), F.split(F.lower(path), "/")
    named = lambda kind: lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "#"))
    keys = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), 1), named("query:"))
    ending = F.regexp_extract(F.lower(path), r"\.([a-z0-9]+)$", 1)
    parts = F.concat(
        F.transform(F.filter(labels, lambda x: x != ""), named("host:")),
        F.when(F.size(labels) > 1, F.array(F.concat(F.lit("top:"), F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>")),
        F.transform(F.filter(segments, lambda x: x != ""), named("path:")),
        F.when(ending != "", F.array(F.concat(F.lit("ending:"), ending))).otherwise(F.array().cast("array<string>")),
        keys,
    )
    return F.array_distinct(parts)


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.5) -> DataFrame:
    """Rules (rule_id, tokens, anchor, confidence) from ``labelled`` (url string, bad boolean), staged.

    A rule stays if the share of all labelled urls that have its tokens and are bad is ``min_support`` or more, if its
    confidence is ``min_confidence`` or more and above the overall share of bad ones, and if no part of it alone is as
    confident. Labels that are NULL are left out, urls that are NULL have no token. Without labelled urls, or without
    bad ones, there is no rule. ``anchor`` is the rule's rarest token.
    """
    spark = labelled.sparkSession
    schema = "rule_id long, tokens array<string>, anchor string, confidence double"
    baskets = stage(labelled.filter("bad IS NOT NULL").select(
        F.concat(tokens(F.col("url")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items")))
    if baskets.filter(F.array_contains("items", BAD)).isEmpty():
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = stage(model.associationRules.filter((F.col("consequent") == F.array(F.lit(BAD))) & (F.col("lift") > 1))
                  .select(F.array_sort("antecedent").alias("tokens"), "confidence"))
    # A part of a rule is found among the rules of one token less, so that each rule looks up as many keys as it has tokens.
    parts = rules.select("tokens", "confidence", F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("part"))
    general = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("without"))
    poorer = parts.join(general, "part").filter("without >= confidence").select("tokens").distinct()
    kept = rules.join(poorer, "tokens", "left_anti").withColumn("rule_id", F.xxhash64("tokens"))
    often = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = kept.select("rule_id", F.explode("tokens").alias("token")).join(often, "token").groupBy("rule_id").agg(
        F.min(F.struct("freq", "token")).alias("least"))
    return stage(kept.join(rarest, "rule_id").select("rule_id", "tokens", F.col("least.token").alias("anchor"), "confidence"))


def judge(pages: DataFrame, rules: list[UrlRule], mined: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and ``confidence``, that of the best mined rule that fits, per row of ``pages``.

    ``pages`` has page_id and url; other columns are not read. The curated rule decides if one fits, else a mined
    rule blocks, else the url is allowed. NULL or relative urls have empty host and path and are allowed unless a rule
    of query keys fits. Repeated rows are judged each. The tokens of a url are joined with the rules' anchors and the
    best fit is combined before the one shuffle, which is by row.
    """
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    exploded = rows.withColumn("tokens", tokens(F.col("url"))).withColumn("token", F.explode_outer("tokens"))
    index = mined.select(F.col("anchor").alias("token"), F.col("tokens").alias("wanted"), "confidence")
    if mined.count() <= SMALL_INDEX:
        index = F.broadcast(index)
    fits = F.size(F.array_except("wanted", "tokens")) == 0
    best = exploded.join(index, "token", "left").groupBy("row", "page_id", "url").agg(F.max(F.when(fits, F.col("confidence"))).alias("confidence"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    return best.select("page_id", host.alias("host"), path.alias("path"), curated(host, path, rules).alias("own"), "confidence").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"), "confidence")
