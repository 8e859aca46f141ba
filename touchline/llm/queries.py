"""The registered queries of this subpackage, and the SQL that must agree where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import alignment, decontamination, exact_dedup, language, ngram_join, oracles, packing, prefix_trie, quality, secret_scan, token_files, toxicity, urls, warc
from touchline.llm.workers import small_batches
from touchline.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            pin(spark)
            small_batches(spark)
            return build(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


@query()
def op1_token_files(table) -> DataFrame:
    manifest = token_files.write_sequences(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(manifest).drop("shard")


@query()
def op2_packing(table) -> DataFrame:
    return packing.pack(table("documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


@query(oracles.SECRETS)
def op5_secrets(table) -> DataFrame:
    spans = secret_scan.scan(table("documents"), owner="source", repository="doc_id")
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k.name}')) AS BIGINT)").alias(f"n_{k.name}") for k in secret_scan.BASE]
    return spans.select("doc_id", *counts, F.sha2(F.expr(secret_scan.listed("base")), 256).alias("base_sha256"),
                        F.expr(secret_scan.listed("spans")).alias("spans"), "n_live", "n_copied")


@query(oracles.QUALITY)
def op8_quality(table) -> DataFrame:
    docs = table("documents").select("doc_id", "text")
    digest = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judged(docs, quality.estimate(docs, wanted=digest), digest)
    failed = F.expr(" OR ".join(f"({r.fails})" for r in quality.BASE))
    return judged.select("doc_id", *[F.col(f"metrics.{m}").cast("long").alias(m) for m in digest], "failed").select(
        "doc_id", *digest, failed.alias("base_failed"), F.col("failed").isNull().alias("kept"))


URL_RULES = [urls.UrlRule("net/", "block"), urls.UrlRule("example.net/en/", "allow"), urls.UrlRule("example.com/de/", "block"), urls.UrlRule("org/fr/", "allow")]


@query()
def op9_urls(table) -> DataFrame:
    pages = table("pages").select("page_id", "url")
    bad = F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    labels = table("labels").groupBy(F.col("doc_id").alias("page_id")).agg(bad)
    mined = urls.mine(pages.join(labels, "page_id").select("url", "bad"))
    return urls.judge(pages, URL_RULES, mined).drop("confidence")


@query(oracles.WARC)
def op10_warc(table) -> DataFrame:
    return warc.read_archives(warc.write_archives(table("pages")))


@query()
def op3_language(table) -> DataFrame:
    docs = table("documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.train(docs.filter(~F.col("held_out")), language.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    return language.predict(docs, model, ["doc_id", "held_out"])


@query()
def op7_toxicity(table) -> DataFrame:
    docs, labels = table("documents").select("doc_id", "text"), table("labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~language.held_out(F.col("doc_id"))))
    found = toxicity.score(docs, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), F.size("segments").cast("long").alias("n_segments"))


@query()
def op6_ngram_join(table) -> DataFrame:
    return ngram_join.similar_groups(table("documents"), n=4, percent=85)


@query(oracles.DECONTAMINATION)
def op4_decontamination(table) -> DataFrame:
    return decontamination.contaminated(table("documents"), table("benchmark")).drop("distance", "id_text")


@query(oracles.EXACT)
def op13_exact_dedup(table) -> DataFrame:
    return exact_dedup.duplicates(table("documents"))


@query()
def op12_alignment(table) -> DataFrame:
    return alignment.align(table("documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query(oracles.TRIE)
def op11_prefix_trie(table) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.ordered_turns(table("conversations"))))
