"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index search, and an exact check.

A window has as many words as some item. Only windows that hold enough shingles of one item, in whatever order, are
looked at: others cannot be similar to it. Their 64-bit SimHashes are searched among the items' by
blocks: of four 16-bit blocks, two fingerprints within ``RADIUS`` differ by at most ``RADIUS // 4`` bits in one, so
listing each item under all block values within ``ITEM_BITS`` and asking for all within ``WINDOW_BITS`` misses none.
What is found is checked by the weighted Jaccard similarity of the shingles themselves, weights being how often each
occurs. Everything is built of Spark's own expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.ngram_join import key_of
from touchline.llm.quality import let
from touchline.session import stage

SHINGLE = 5
#: A window of similarity 0.8 lies within this radius but for about 3 in 10,000; those more alike are surer.
RADIUS = 19
ITEM_BITS, WINDOW_BITS = 3, 1
assert ITEM_BITS + WINDOW_BITS >= RADIUS // 4
#: Shingles of items that are sent to every task at once; more of them are taken in turns, the documents being read again.
INDEX_ROWS = 1_000_000

#: Words are runs of letters and digits, in lower case.
WORDS = r"regexp_extract_all(lower(coalesce(CAST(text AS STRING), '')), '[\\p{L}\\p{N}]+', 0)"
_PLACES = ", ".join(f"words[i + {k}]" for k in range(SHINGLE))
#: Hashes of the shingles of ``words`` in order; fewer words than a shingle are one, none have none.
HASHES = (f"CASE WHEN size(words) >= {SHINGLE} THEN transform(sequence(0, size(words) - {SHINGLE}), i -> xxhash64({_PLACES})) "
          "WHEN size(words) > 0 THEN array(xxhash64(array_join(words, ' '))) ELSE CAST(array() AS array<bigint>) END")
SHINGLES = (f"CASE WHEN size(words) >= {SHINGLE} THEN transform(sequence(0, size(words) - {SHINGLE}), i -> concat_ws(' ', {_PLACES})) "
            "ELSE array(array_join(words, ' ')) END")
#: Bit b is set where the shingles that have it outweigh the others; a shingle counts as often as it occurs.
SIMHASH = ("aggregate(sequence(0, 63), 0L, (bits, b) -> if(aggregate(hashes, 0, (a, h) -> "
           "a + if((shiftright(h, b) & 1L) = 1L, 1, -1)) > 0, bits | shiftleft(1L, b), bits))")


def within(bits: int) -> str:
    """SQL of the 16-bit masks of at most so many bits, listed, as Spark would filter all numbers anew for every row."""
    return "array(" + ", ".join(str(x) for x in range(1 << 16) if x.bit_count() <= bits) + ")"


def blocks(table: DataFrame, bits: int) -> DataFrame:
    """A row per block of ``simhash`` and value within ``bits`` of it, as (block, value)."""
    listed = table.withColumn("block", F.explode(F.expr("sequence(0, 3)")))
    own = F.expr("CAST(shiftright(simhash, 16 * block) & 65535 AS INT)")
    return listed.withColumn("own", own).withColumn("mask", F.explode(F.expr(within(bits)))).withColumn("value", F.expr("own ^ mask")).drop("own", "mask")


def fingerprinted(table: DataFrame) -> DataFrame:
    """``table`` (words) with its shingles and SimHash."""
    return table.withColumn("shingles", F.expr(SHINGLES)).withColumn("simhash", F.expr(let("hashes", HASHES, SIMHASH)))


def items_of(benchmark: DataFrame) -> DataFrame:
    """Items with words, each wording once (``item``) under its smallest item_id, staged."""
    words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.expr(WORDS).alias("words")).filter("size(words) > 0")
    return stage(words.groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn(
        "size", F.size("words")).withColumn("item", F.md5(F.array_join("words", " "))))


def starts(percent: int) -> str:
    """SQL of the starts of windows that may be similar to an item of ``n`` shingles, which stand at the sorted
    ``places`` of a text of ``total`` shingles; each start once.

    Similar are sets of n and m shingles if percent * (n + m) of 100 + percent are common at least, so a whole window
    holds ``full`` places and one cut off by the text's end, where m is no less than is common, ``cut``. The windows
    that hold the places i to i + k - 1 start from the last one's place - n + 1 to the first one's; those that start
    up to place i - 1 hold k places from there on too and are listed with it.
    """
    def spans(k: str, low: str, high: str) -> str:
        first = f"greatest({low}, places[i + {k} - 1] - n + 1, if(i = 0, 0, places[greatest(i - 1, 0)] + 1))"
        ranges = f"transform(sequence(0, size(places) - {k}), i -> struct({first} AS lo, least({high}, places[i]) AS hi))"
        return f"if(size(places) < {k}, array(), flatten(transform(filter({ranges}, r -> r.lo <= r.hi), r -> sequence(r.lo, r.hi))))"

    full, cut = f"CAST(ceil({2 * percent} * n / {100 + percent}) AS INT)", f"CAST(ceil({percent} * n / 100) AS INT)"
    both = f"concat({spans('k.full', '0', 'total - n')}, {spans('k.cut', 'greatest(0, total - n + 1)', 'total - 1')})"
    return let("k", f"struct(greatest(1, {full}) AS full, greatest(1, {cut}) AS cut)", both)


def windows_of(docs: DataFrame, items: DataFrame, percent: int, index_rows: int = INDEX_ROWS) -> DataFrame:
    """Windows (row, doc_id, id_text, start, size, window) of the documents that hold enough of an item, staged."""
    index = stage(items.select("size", F.xxhash64("words").alias("number"), F.size(F.expr(HASHES)).alias("n"), F.explode(F.expr(HASHES)).alias("hash")).distinct())
    turns = max(1, -(-index.count() // index_rows))
    # The outer form, as the plain one has Spark compute the array once more to filter empty ones.
    listed = docs.select(key_of().alias("id_text"), F.expr(WORDS).alias("words")).withColumn("hashes", F.expr(HASHES)).select(
        "id_text", F.size("hashes").alias("total"), F.posexplode_outer("hashes").alias("place", "hash"))
    found = [listed.join(F.broadcast(index.filter(F.expr(f"pmod(hash, {turns}) = {turn}"))), "hash").drop("hash") for turn in range(turns)]
    held = reduce(DataFrame.union, found).groupBy("id_text", "total", "number", "size", "n").agg(F.array_sort(F.collect_set("place")).alias("places"))
    begun = held.withColumn("starts", F.expr(starts(percent))).filter("size(starts) > 0")
    begun = stage(begun.groupBy("id_text", "size").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts")))
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), key_of().alias("id_text"), "text")
    cut = read.join(begun, "id_text").select("row", "doc_id", "id_text", "size", "starts", F.expr(WORDS).alias("words"))
    return stage(cut.select("row", "doc_id", "id_text", F.explode("starts").alias("start"), "size", "words").withColumn(
        "window", F.expr("array_join(slice(words, start + 1, size), ' ')")).drop("words"))


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80, index_rows: int = INDEX_ROWS) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words, distance, id_text) per row of ``docs`` and item that it holds.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. An item is held if some
    window of its number of words (at the text's end of fewer) has a weighted Jaccard similarity of ``percent`` or
    more on shingles of five words; the best window is given, the first of equal ones, by words from 0. Items of the
    same words are one, under their smallest id. An item of fewer than five words is held only by a text of just these
    words. NULL and empty texts or items hold and are held by nothing; repeated rows give rows each; a NULL doc_id
    stays NULL. Without documents or items there are no rows.

    The texts are read once a turn for the places of the items' shingles, and once more for the windows, by a join on
    the hash of id and text with what was found. Windows of the same
    words are searched and checked once, whatever the number of documents that have them, and come back to these by a
    join of two staged tables, whose large partitions adaptive execution splits.
    """
    items = items_of(benchmark)
    windows = windows_of(docs, items, percent, index_rows).withColumn("key", F.md5("window"))
    distinct = stage(fingerprinted(windows.groupBy("size", "key").agg(F.any_value("window").alias("window")).withColumn("words", F.split("window", " "))).drop("words", "window"))
    listed = stage(fingerprinted(items).drop("words"))
    asked, known = blocks(distinct.select("size", "key", "simhash"), WINDOW_BITS), blocks(listed.select("size", "item", "simhash"), ITEM_BITS)
    near = asked.join(known.withColumnRenamed("simhash", "item_simhash"), ["size", "block", "value"]).withColumn(
        "distance", F.expr("bit_count(simhash ^ item_simhash)")).filter(F.col("distance") <= RADIUS).select("size", "key", "item", "distance").distinct()
    both = near.join(distinct.select("size", "key", "shingles"), ["size", "key"]).join(listed.select("item", "item_id", F.col("shingles").alias("wanted")), "item")
    common = F.expr("aggregate(transform(array_intersect(shingles, wanted), k -> least(size(filter(shingles, x -> x = k)), size(filter(wanted, x -> x = k)))), 0, (a, n) -> a + n)")
    checked = both.withColumn("common", common).withColumn("total", F.size("shingles") + F.size("wanted") - F.col("common"))
    alike = stage(checked.filter(100 * F.col("common") >= percent * F.col("total")).select(
        "size", "key", "item", "item_id", (F.col("common") / F.col("total")).alias("similarity"), "distance"))
    held = windows.select("row", "doc_id", "id_text", "start", "size", "key").join(alike, ["size", "key"])
    best = held.groupBy("row", "doc_id", "id_text", "item", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "size", "distance")).alias("best"))
    return best.select("doc_id", "item_id", "best.similarity", (-F.col("best.back")).cast("long").alias("start"), F.col("best.size").cast("long").alias("n_words"),
                       F.col("best.distance").cast("long").alias("distance"), "id_text")


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns kept."""
    held = stage(contaminated(docs, benchmark, percent).select(F.col("id_text").alias("id and text")).distinct())
    return docs.withColumn("id and text", key_of()).join(held, "id and text", "left_anti").drop("id and text")
