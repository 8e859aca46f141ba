"""Account and contact lists: base audience, contact ids, contact and call exports, conversion archive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import clean_header, long_of, prefixed_key, stamp, with_constants
from touchline.functions.dates import RunTime, as_datetime
from touchline.functions.names import campaign_of_export


def base_audience(
    accounts: DataFrame,
    key: str,
    prefix: str,
    constants: Mapping[str, str],
    winback: DataFrame | None = None,
    winback_key: str | None = None,
) -> DataFrame:
    """One row per account: the prefixed key and constant columns.

    The win-back list, when there is one, joins in before the dedup, so an account in both appears once.
    """
    keys = accounts.select(F.col(key).cast("string").alias("_key"))
    if winback is not None:
        keys = keys.unionByName(winback.select(F.col(winback_key or key).cast("string").alias("_key")))
    return with_constants(keys.distinct().select(prefixed_key(F.col("_key"), prefix).alias("account_id")), constants)


def contact_ids(export: DataFrame, user: str, account: str, prefix: str, run: RunTime) -> DataFrame:
    """Contact id and account key of an export, for accounts with the prefix."""
    clean = clean_header(export)
    return clean.where(F.col(account).cast("string").startswith(prefix)).select(
        long_of(clean, user).alias("user_id"),
        F.col(account).cast("string").alias("account_id"),
        F.lit(f"{as_datetime(run):%Y%m%d}").alias("process_day"),
    )


def contact_export(export: DataFrame, run: RunTime) -> DataFrame:
    """A contact export with cleaned header and the second-exact stamp."""
    return stamp(clean_header(export), run, "hour")


def call_audience(
    export: DataFrame, run: RunTime, channel: str = "CALLCENTER", name_column: str = "file_name"
) -> DataFrame:
    """A call-centre export: as above, with the channel, and the campaign read from the file name."""
    named = clean_header(export).withColumns({
        "channel": F.lit(channel), "campaign_name": campaign_of_export(F.col(name_column), channel),
    })
    return stamp(named.drop(name_column), run, "hour")


def conversion_archive(conversions: DataFrame, run: RunTime) -> DataFrame:
    """Arrived conversions under (month, day, hour), ready to be appended as one batch."""
    return stamp(conversions, run, "hour", hour_column="hour")
