"""Training-data pipeline over the documents table: each stage works on what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontamination, language, ngram_join, packing, secret_scan
from touchline.llm.workers import small_batches
from touchline.session import pin, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told: they have letters, and one language is likelier than all others together.

    The model learns from all documents that name a language; one that names none gets the predicted one. Without any
    named language nothing can be told, and only texts without letters go.
    """
    model = language.train(docs, language.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    if not model.languages:
        return docs.select(COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    told = language.predict(docs, model, COLUMNS).filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0.5))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of Jaccard similarity 0.8 on shingles of five words."""
    return ngram_join.one_of_each(docs.select(COLUMNS), n=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document, secrets replaced by a mark; n_chars is that of the new text."""
    found = secret_scan.scan(docs, owner="source", repository="doc_id", keep=("text", "lang", "source", "n_chars"))
    text = F.when(F.size("spans") > 0, F.expr(secret_scan.redacted())).otherwise(F.col("kept.text"))
    chars = F.when(F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("kept.n_chars"))
    return found.withColumn("text", text).select("doc_id", "text", "kept.lang", "kept.source", chars.alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("language identification", languages),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("packing", packed),
]
#: No SQL: tokenizers and the language model have no counterpart in it. tests/llm holds each stage to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin(spark)
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
