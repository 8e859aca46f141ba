"""Exact duplicates by two passes over the texts and a Bloom filter between them.

The first pass hashes each text to two bits of one 64-bit word of the filter and counts, by bit, how many rows hit it.
Bits hit twice or more make the filter. In the second pass a row of which either bit was hit once is the only one of
its text: it goes straight through. The others, copies and some whose bits others share by chance, are shuffled by the
SHA-256 of the text, which alone decides. The filter never decides what is equal, so no size of it changes a result.

Only built-in expressions: bits are counted with a combine before the shuffle, 17 bytes a row at most, and the filter
is looked up by a broadcast join on the word. Its words are bounded by ``most_words``, so the broadcast is too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import stage

#: Rows per word of the filter while ``most_words`` allows it: about 1 in 100 single rows is then shuffled in vain.
ROWS_A_WORD = 4
#: Most words of the filter: 2 ** 23, of 16 bytes each as a row, 128 MB. Beyond 33 million rows words fill up, and more
#: single rows are shuffled; a cluster with larger executors sets it higher.
MOST_WORDS = 1 << 23
FOUND = ("keep_id", "group_size", "kept", "text_sha256")


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def word_of(text: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(words).cast("long"))


def bits_of(text: Column) -> list[Column]:
    """Two different bits of a word, from hashes of their own."""
    first = F.pmod(F.xxhash64(F.lit(1), text), F.lit(64))
    step = F.pmod(F.xxhash64(F.lit(2), text), F.lit(63)) + 1
    return [first, F.pmod(first + step, F.lit(64))]


def words_for(rows: int, most: int) -> int:
    return max(1, min(most, rows // ROWS_A_WORD))


def repeated_bits(docs: DataFrame, words: int) -> DataFrame:
    """First pass: (word, bits) of the bits that two or more rows hit; words without such a bit are left out.

    A bit has one row per task before the shuffle, however many rows hit it.
    """
    text = text_of(docs)
    hits = docs.select(word_of(text, words).alias("word"), F.explode(F.array(*bits_of(text))).alias("bit"))
    twice = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return twice.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, CAST(bit AS INT)))").alias("bits"))


def split(docs: DataFrame, keep: Sequence[str], most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(single, several): rows whose text is the only one of its kind, and rows that may be copies.

    Both have the columns ``keep`` of ``docs`` in a struct ``kept``, and ``doc_id`` and ``text_sha256``. No row of
    ``single`` has an equal anywhere.
    """
    text = text_of(docs)
    words = words_for(docs.count(), most_words)
    filled = stage(repeated_bits(docs, words))
    mask = F.lit(0).cast("long")
    for bit in bits_of(text):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int")))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.struct(F.lit(0).alias("_"), *[docs[c].alias(c) for c in keep]).alias("kept"),
        F.sha2(text, 256).alias("text_sha256"), word_of(text, words).alias("word"), mask.alias("mask"))
    # the filter has `words` rows at most
    looked_up = rows.join(F.broadcast(filled), "word", "left")
    again = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    columns = ["doc_id", "kept", "text_sha256"]
    return looked_up.filter(~again).select(*columns), looked_up.filter(again).select(*columns)


def duplicates(docs: DataFrame, keep: Sequence[str] = (), most_words: int = MOST_WORDS) -> DataFrame:
    """(doc_id, *keep, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id long, text string).

    Texts are equal when their code points are; NULL counts as empty. Of equal texts the row of the largest doc_id has
    ``kept``; a NULL id is smaller than any, and of rows equal in text and id one, the last as stored, is kept. keep_id
    is the doc_id of the row that stays, NULL if the group has no id. Very long texts are hashed whole. An empty table
    gives no rows. ``keep`` names further columns to carry, whatever their names; others are not read.

    Groups are combined before the shuffle. What a hot group's rows are told comes by a join of two stored tables,
    which adaptive execution splits.
    """
    single, several = split(docs, keep, most_words)
    several = stage(several.withColumn("place", F.monotonically_increasing_id()))
    groups = stage(several.groupBy("text_sha256").agg(
        F.max(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "place")).alias("last"), F.count(F.lit(1)).alias("group_size")))
    of_many = several.join(groups, "text_sha256").select(
        "doc_id", "kept", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("last.place")).alias("stays"), "text_sha256")
    alone = single.select("doc_id", "kept", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("stays"), "text_sha256")
    every = alone.unionByName(of_many)
    taken = [F.col("kept").getField(c).alias(c) for c in keep if c not in ("doc_id", *FOUND)]
    return every.select("doc_id", *taken, "keep_id", "group_size", F.col("stays").alias("kept"), "text_sha256")


def distinct_texts(docs: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; only rows that may be copies are shuffled.

    Columns named like those of :func:`duplicates` are kept as they are.
    """
    inner = [f"c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*inner)
    source = {name: named[inner[docs.columns.index(name)]] for name in ("doc_id", "text")}
    wide = named.select(source["doc_id"].alias("doc_id"), source["text"].alias("text"), *[named[c] for c in inner])
    return duplicates(wide, inner, most_words).filter("kept").select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns, strict=True)])
