"""Event feeds of the e-mail platform, and the dimensions that select them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import conform, long_of, stamp
from touchline.functions.dates import on_day, trailing_days
from touchline.operators.joins import lookup_join
from touchline.schemas import FEEDS


def tagged_programs(programs: DataFrame, tag: str) -> DataFrame:
    """Programs whose name holds ``tag``, as (id, name) with numeric ids."""
    return programs.where(F.col("name").contains(tag)).select(long_of(programs, "id").alias("id"), "name")


def program_campaigns(campaigns: DataFrame, programs: DataFrame) -> DataFrame:
    """Ids of the campaigns that belong to one of the programs."""
    allowed = programs.select(F.col("id").alias("program_id")).distinct()
    chosen = lookup_join(campaigns, allowed, ["program_id"], "left_semi")
    return chosen.select(F.col("id").alias("campaign_id")).distinct()


def event_feed(
    kind: str,
    events: DataFrame,
    run_day: dt.date,
    campaign_ids: DataFrame | None = None,
    program_ids: DataFrame | None = None,
    days: int = 1,
) -> DataFrame:
    """One feed in its declared form, stamped with the run's partition keys.

    Keeps the events of the run day (of the last ``days`` days), with a contact, of an allowed campaign.
    ``campaign_ids`` restricts contact feeds (column ``campaign_id``), ``program_ids`` the campaigns feed
    (column ``program_id``); without them every program counts.
    """
    timely = events.where(on_day(F.col("event_time"), run_day) if days == 1
                          else trailing_days(F.col("event_time"), run_day, days))
    if kind == "campaigns":
        if program_ids is not None:
            wanted = program_ids.select("program_id").distinct()
            timely = lookup_join(timely, wanted, ["program_id"], "left_semi")
    else:
        timely = timely.where(F.col("contact_id").isNotNull())
        if campaign_ids is not None:
            typed = timely.withColumn("_campaign", long_of(timely, "campaign_id"))
            allowed = campaign_ids.select(F.col("campaign_id").alias("_campaign"))
            timely = lookup_join(typed, allowed, ["_campaign"], "left_semi")
    return stamp(conform(timely, FEEDS[kind]), run_day)


def paged_contacts(pages: DataFrame, key: str, prefix: str) -> DataFrame:
    """Distinct contacts of a paged result whose account key has the prefix."""
    return pages.where(F.col(key).startswith(prefix)).distinct()


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Pages already read as separate frames, as one."""
    whole = pages[0]
    for page in pages[1:]:
        whole = whole.unionByName(page)
    return whole
