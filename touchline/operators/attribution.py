"""Conversion attribution over the communications history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import long_of
from touchline.functions.dates import ms_to_text, within_days
from touchline.operators.joins import TASK_ROWS, spread_join
from touchline.operators.status import WINDOW_DAYS
from touchline.schemas import CHANNEL_WEIGHTS

#: Accounts are told apart by so many bits of a hash where partitions are looked for.
ACCOUNT_BITS = 24
CONVERSION_COLUMNS = ["conv_use_case_cat", "order_id", "conversion_dt", "conversion_type"]


def weight_of(channel: Column, weights: Mapping[str, int] = CHANNEL_WEIGHTS) -> Column:
    """Rank of a channel; NULL for one the hierarchy does not name."""
    pairs = [F.lit(part) for item in weights.items() for part in item]
    return F.element_at(F.create_map(*pairs), channel)


def typed_conversions(conversions: DataFrame) -> DataFrame:
    """Conversion file (epoch milliseconds as text) to the history's column names and forms."""
    return conversions.select(
        "account_id",
        "conv_use_case_cat",
        "order_id",
        ms_to_text(long_of(conversions, "conv_dte")).alias("conversion_dt"),
        F.col("conv_type").alias("conversion_type"),
    )


def credited_again(history: DataFrame, conversions: DataFrame, **options) -> DataFrame:
    """:func:`attribute_conversions` for a history that an earlier run may have written.

    Rows that an earlier run has not credited lose the conversions it had paired them with, and become one row per
    message again; a pair that was credited then is not added a second time. So a second run with the same
    conversions gives the same rows. Rows that are equal in all columns become one.
    """
    converted = F.coalesce("conv_flg", F.lit(False))
    columns = [*CONVERSION_COLUMNS, "conv_flg"]
    bare = history.withColumns({c: F.when(converted, F.col(c)) for c in columns}).dropDuplicates()
    return attribute_conversions(bare, conversions, **options).dropDuplicates()


def best_channels(history: DataFrame, weights: Mapping[str, int] = CHANNEL_WEIGHTS) -> DataFrame:
    """(account_id, _best): the rank of the best channel each account was reached on."""
    reached = history.select("account_id", weight_of(F.col("channel"), weights).alias("_weight"))
    return reached.groupBy("account_id").agg(F.min("_weight").alias("_best"))


def account_number(account: Column) -> Column:
    return F.pmod(F.xxhash64(account), F.lit(1 << ACCOUNT_BITS)) + 1


def account_bitmaps(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bucket, bits): which accounts a partition may hold, as bitmaps of hashed account ids.

    Bucket 0 says that the partition has rows which an earlier run paired with a conversion and did not credit. A
    partition has one bitmap of 4 kB for each bucket its accounts fall into, 2 MB at most, however many rows it has.
    """
    number = account_number(F.col("account_id"))
    paired = ~F.coalesce("conv_flg", F.lit(False)) & F.expr(" OR ".join(f"{c} IS NOT NULL" for c in CONVERSION_COLUMNS))
    found = F.array(
        F.when(F.col("account_id").isNotNull(), F.struct(F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))),
        F.when(paired, F.struct(F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("bit"))))
    bits = history.select(*keys, F.explode(F.array_compact(found)).alias("x")).select(*keys, "x.bucket", "x.bit")
    return bits.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def touched_partitions(bitmaps: DataFrame, keys: Sequence[str], conversions: DataFrame) -> DataFrame:
    """Partitions that a run with these conversions may change: those that hold one of their accounts, by
    :func:`account_bitmaps`, or rows of bucket 0. Hashes may name one too many, never one too few.

    Two bitmaps have a bit in common if they have fewer set together than each for itself. The conversions' own bitmaps
    are 2 MB at most.
    """
    number = account_number(F.col("account_id"))
    asked = conversions.where("account_id IS NOT NULL").select(F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
    asked = asked.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("asked"))
    both = bitmaps.join(F.broadcast(asked), "bucket").select(*keys, "bucket", F.explode(F.array("bits", "asked")).alias("bits"))
    counted = both.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("together"), F.sum(F.bitmap_count("bits")).alias("each"))
    return counted.where("together < each").select(*keys).union(bitmaps.where("bucket = 0").select(*keys)).distinct()


def attribute_conversions(
    history: DataFrame,
    conversions: DataFrame,
    weights: Mapping[str, int] = CHANNEL_WEIGHTS,
    days: int = WINDOW_DAYS,
    least: int = 0,
    best: DataFrame | None = None,
) -> DataFrame:
    """Flag the rows a conversion is credited to.

    ``conversions`` has ``account_id`` and the four conversion columns. Rows already converted keep everything.
    Each other row takes the conversions of its account (a row per conversion) and is flagged when the campaign
    name holds the use case, the conversion came 0 to 14 days after the contact, and the channel is the best
    one the account was reached on. The flag is three-valued: NULL where an input is missing.

    Both joins are on the account, so the history is shuffled once; converted rows need no separate branch and
    union. ``best`` are the :func:`best_channels` of a longer history of which ``history`` is a part.
    """
    converted = F.coalesce("conv_flg", F.lit(False))
    best = best_channels(history, weights) if best is None else best
    found = conversions.select("account_id", *[F.col(c).alias(f"_{c}") for c in CONVERSION_COLUMNS])
    joined = spread_join(history, [best, found], ["account_id"], only_when=~converted, right_repeats=True, task_rows=TASK_ROWS)
    taken = {
        c: F.when(converted, F.col(c)).otherwise(F.col(f"_{c}").cast(history.schema[c].dataType))
        for c in CONVERSION_COLUMNS
    }
    flag = F.when(converted, F.col("conv_flg")).otherwise(
        F.col("campaign_name").contains(F.col("conv_use_case_cat"))
        & within_days(F.col("conversion_dt"), F.col("contact_dt"), days, least)
        & (weight_of(F.col("channel"), weights) == F.col("_best"))
    )
    return joined.withColumns(taken).withColumn("conv_flg", flag).select(*history.columns)
