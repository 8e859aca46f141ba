"""Status updates of the communications history from later events: opens, clicks, bounces, calls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import contains_any, long_of
from touchline.functions.dates import within_days
from touchline.operators.joins import spread_join
from touchline.schemas import CONTACTED_DISPOSITIONS

WINDOW_DAYS = 14  # fixed value: days after the send in which an event still counts
MESSAGE = ["contact_id", "campaign_id", "comm_dt"]


def message_events(
    events: DataFrame, kind: str, days: int = WINDOW_DAYS, least: int | None = None, attributes: Sequence[str] = ()
) -> DataFrame:
    """Events keyed like the messages they answer, within the day window; campaign ids may be text."""
    return events.where(within_days(F.col("event_time"), F.col("email_sent_at"), days, least)).select(
        long_of(events, "contact_id").alias("contact_id"),
        long_of(events, "campaign_id").alias("campaign_id"),
        F.to_date("email_sent_at").alias("comm_dt"),
        F.lit(kind).alias("kind"),
        "event_time",
        *attributes,
    ).dropna(subset=MESSAGE)


def _when(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def first_opens_and_clicks(opens: DataFrame | None, clicks: DataFrame | None, days: int, least: int | None) -> DataFrame:
    """First open, first click and click count per message.

    The feeds are stacked and aggregated once. Times and counts alone keep it a hash aggregate, combined before
    the shuffle, so a busy contact costs one row per task.
    """
    feeds = [
        message_events(events, kind, days, least)
        for kind, events in (("open", opens), ("click", clicks)) if events is not None
    ]
    return reduce(DataFrame.unionByName, feeds).groupBy(*MESSAGE).agg(
        F.min(_when("open", F.col("event_time"))).alias("first_open"),
        F.min(_when("click", F.col("event_time"))).alias("first_click"),
        F.count(_when("click", F.lit(1))).alias("clicks"),
    )


def first_bounces(bounces: DataFrame, days: int, least: int | None) -> DataFrame:
    """First bounce per message with its type and reason."""
    why = ["bounce_type", "dsn_reason"]
    return message_events(bounces, "bounce", days, least, why).groupBy(*MESSAGE).agg(
        F.min(F.struct("event_time", *why)).alias("first_bounce")
    )


def apply_status(
    history: DataFrame,
    opens: DataFrame | None = None,
    clicks: DataFrame | None = None,
    bounces: DataFrame | None = None,
    channel: str = "email",
    days: int = WINDOW_DAYS,
    least: int | None = None,
    open_is_contact: bool = True,
) -> DataFrame:
    """All status columns in one pass over the history: aggregate the feeds, join once, project once.

    Dates are filled only where they are NULL; click count and bounce reason follow the newest feed. Applying it
    twice changes nothing. Rows of other channels pass through.
    """
    answers = []
    if opens is not None or clicks is not None:
        answers.append(first_opens_and_clicks(opens, clicks, days, least))
    if bounces is not None:
        answers.append(first_bounces(bounces, days, least))
    joined = spread_join(history, answers, MESSAGE, only_when=F.col("channel") == channel)
    new: dict[str, Column] = {}
    if opens is not None:
        new["open_dt"] = F.coalesce("open_dt", "first_open")
        if open_is_contact:
            new["contact_dt"] = F.coalesce("contact_dt", "first_open")
    if clicks is not None:
        clicked = F.col("clicks") > 0
        new["click_dt"] = F.coalesce("click_dt", "first_click")
        new["clicks_count"] = F.when(clicked, F.col("clicks").cast("int")).otherwise(F.col("clicks_count"))
    if bounces is not None:
        bounced = F.col("first_bounce").isNotNull()
        new["bounce_dt"] = F.coalesce("bounce_dt", "first_bounce.event_time")
        for name in ("bounce_type", "dsn_reason"):
            new[name] = F.when(bounced, F.col(f"first_bounce.{name}")).otherwise(F.col(name))
    return joined.withColumns(new).select(*history.columns)


def apply_first_open(history: DataFrame, opens: DataFrame, **options) -> DataFrame:
    return apply_status(history, opens=opens, **options)


def apply_clicks(history: DataFrame, clicks: DataFrame, **options) -> DataFrame:
    return apply_status(history, clicks=clicks, **options)


def apply_first_bounce(history: DataFrame, bounces: DataFrame, **options) -> DataFrame:
    return apply_status(history, bounces=bounces, **options)


def first_calls(
    feedback: DataFrame,
    attempt: str = "Intento_discado_1",
    disposition: str = "Disposicion",
    contacted: Sequence[str] = CONTACTED_DISPOSITIONS,
) -> DataFrame:
    """First dial date per account among calls that reached the customer."""
    reached = feedback.where(F.col(attempt).isNotNull() & contains_any(F.col(disposition), contacted))
    return reached.groupBy("account_id").agg(F.min(attempt).alias("comm_dt"))


def apply_call_contact(history: DataFrame, feedback: DataFrame, **columns) -> DataFrame:
    """Set ``contact_dt``, where NULL, on the rows of the day of the account's first reaching call."""
    calls = first_calls(feedback, **columns).withColumn("_called", F.lit(True))
    joined = spread_join(history, calls, ["account_id", "comm_dt"])
    called = F.when(F.col("_called"), F.col("comm_dt"))
    return joined.withColumn(
        "contact_dt", F.coalesce("contact_dt", called.cast(history.schema["contact_dt"].dataType))
    ).select(*history.columns)
