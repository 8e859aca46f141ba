"""Building the communications history of a day from sends, cancels, calls and audiences."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import conform, contains_any, long_of, prefixed_key, stamp, stripped_key, with_constants
from touchline.functions.dates import day_key, month_key, on_day, parse_date
from touchline.operators.joins import NO_KEY, hot_keys, lookup_join, spread_join
from touchline.operators.latest import latest_per_key, latest_with_ties
from touchline.session import stage
from touchline.schemas import CONTACTED_DISPOSITIONS, HISTORY, SIMPLE_HISTORY

CALL_CHANNEL = "Outbound_call"  # fixed value: channel of call-centre rows
ATTEMPTS = ("Intento_discado_1", "Intento_discado_2", "Intento_discado_3")


def contact_accounts(ids: DataFrame) -> DataFrame:
    """One row per (contact, account), without missing accounts; input columns user_id, account_id."""
    return ids.where(F.col("account_id").isNotNull()).select(
        F.col("user_id").cast("long").alias("contact_id"), "account_id"
    ).distinct()


def current_offers(
    offers: DataFrame, run_day: dt.date, prefix: str, offer_type: str = "single", channel: str = "email",
    since: str | None = None, hot: dict | None = None,
) -> DataFrame:
    """Newest offers per account and use case up to the run day; offers of the same newest date all stay.

    ``since`` leaves out partitions up to and with that ``day`` key. ``hot`` gives hot values of sub_acct_no.
    """
    if since is not None:
        offers = offers.where(F.col("day") > since)
    wanted = (
        offers.where((F.col("offer_type") == offer_type) & (F.col("channel") == channel))
        .withColumn("rec_date", parse_date(F.col("date").cast("string")))
        .where(F.col("rec_date") <= F.lit(run_day))
    )
    newest = latest_with_ties(
        wanted, ["sub_acct_no", "offer_type", "channel", "use_case"], "rec_date", by=["sub_acct_no"], hot=hot
    )
    return newest.select(
        prefixed_key(F.col("sub_acct_no"), prefix).alias("account_id"),
        "offer_type", "use_case", "rec_date", "id_oferta_int", "regime",
    )


def latest_links(links: DataFrame) -> DataFrame:
    """The newest link of each offer."""
    columns = ["id_oferta_int", "link", "link_generated_dt", "link_expiration_dt"]
    return latest_per_key(
        links.select(*columns), ["id_oferta_int"], ["link_generated_dt", "link_expiration_dt", "link"]
    )


def latest_campaigns(campaigns: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest version of each campaign, one row per id."""
    return latest_per_key(campaigns, ["id"], ["event_time", *tie_break])


def compose_day(
    sends: DataFrame,
    cancels: DataFrame,
    contact_ids: DataFrame,
    offers: DataFrame,
    links: DataFrame,
    campaigns: DataFrame,
    programs: DataFrame,
    run_day: dt.date,
    prefix: str,
    offers_since: str | None = None,
    channel: str = "email",
) -> DataFrame:
    """History rows of one day: a row per message and status (sent, cancelled) and use case offered.

    The account side (contact, account, offers, links) is joined first, among tables of one row per account or
    offer, and staged; the messages are then shuffled once, by contact. Campaign versions are reduced to one row
    per id.
    """
    def messages(feed: DataFrame, sent: Column, cancelled: Column, reason: Column) -> DataFrame:
        return feed.where(F.col("contact_id").isNotNull() & on_day(F.col("event_time"), run_day)).select(
            "contact_id",
            "campaign_id",
            F.to_date("event_time").alias("comm_dt"),
            sent.cast("timestamp").alias("sent_dt"),
            cancelled.cast("timestamp").alias("cancel_dt"),
            reason.cast("string").alias("cancel_reason"),
        )

    none = F.lit(None)
    raw = messages(sends, F.col("event_time"), none, none).unionByName(
        messages(cancels, none, F.col("event_time"), F.col("reason"))
    )
    offered = spread_join(
        current_offers(offers, run_day, prefix, channel=channel, since=offers_since),
        latest_links(links), ["id_oferta_int"], hot={NO_KEY: 1.0},  # ids are one row each, but those that are NULL
    )
    # the raw tables tell the hot accounts at the price of a scan of one column
    offer_accounts = offers.select(prefixed_key(F.col("sub_acct_no"), prefix).alias("account_id"))
    account = stage(spread_join(
        contact_accounts(contact_ids), offered, ["account_id"], hot=hot_keys(contact_ids, ["account_id"]),
        right_repeats=True, hot_right=hot_keys(offer_accounts, ["account_id"]),
    ))
    versions = campaigns.select("id", "event_time", "program_id")
    campaign = latest_campaigns(versions, ["program_id"]).select(F.col("id").alias("campaign_id"), "program_id")
    program = programs.select(long_of(programs, "id").alias("program_id"), F.col("name").alias("campaign_name"))
    named = lookup_join(campaign, program, ["program_id"])
    base = raw.distinct()
    of_contact = spread_join(base, account, ["contact_id"], hot=hot_keys(raw, ["contact_id"]), right_repeats=True)
    full = lookup_join(of_contact, named, ["campaign_id"], probe=raw)
    rows = full.withColumn("sub_acct_no_sbb", stripped_key(F.col("account_id"), prefix)).withColumn(
        "channel", F.lit(channel)
    )
    return conform(stamp(rows, run_day), HISTORY)


def compose_simple(
    sends: DataFrame, cancels: DataFrame, bounces: DataFrame, campaigns: DataFrame, run_day: dt.date,
    channel: str = "email",
) -> DataFrame:
    """Short history: every send, cancel and bounce of the day with the newest name of its campaign."""
    columns = ["contact_id", "campaign_id", "event_time", "launch_id"]
    of_day = F.col("contact_id").isNotNull() & on_day(F.col("event_time"), run_day)
    feeds = [feed.where(of_day).select(*columns) for feed in (sends, cancels, bounces)]
    events = feeds[0].unionByName(feeds[1]).unionByName(feeds[2])
    names = latest_campaigns(campaigns.select("id", "name", "event_time"), ["name"]).select(
        F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name")
    )
    rows = lookup_join(events, names, ["campaign_id"]).withColumn("channel", F.lit(channel))
    return stamp(conform(rows, SIMPLE_HISTORY), run_day)


def attempts_to_communications(
    feedback: DataFrame,
    campaign_name: str | None = None,
    contacted: Sequence[str] = CONTACTED_DISPOSITIONS,
    attempts: Sequence[str] = ATTEMPTS,
    account_column: str = "account_id",
    number_column: str = "cuenta",
    disposition: str = "Disposicion",
) -> DataFrame:
    """One (account, number, date, contact date) row per distinct dial attempt of a call-feedback row.

    The first attempt counts when present; the second and third when present and different from the one before
    (a missing one before drops them). An attempt carries the contact date if the call reached the customer and
    the attempt is not earlier than the next present one in its comparison order.
    """
    a1, a2, a3 = (F.col(c) for c in attempts)
    reached = contains_any(F.col(disposition), contacted)

    def attempt(day: Column, keep: Column, *others: Column) -> Column:
        contact = F.when(reached & (day >= F.coalesce(*others, day)), day)
        return F.struct(day.alias("comm_dt"), contact.alias("contact_dt"), keep.alias("keep"))

    tries = F.array(
        attempt(a1, a1.isNotNull(), a2, a3),
        attempt(a2, a2.isNotNull() & (a2 != a1), a3, a1),
        attempt(a3, a3.isNotNull() & (a3 != a2), a2, a1),
    )
    rows = feedback.select(
        F.col(account_column).alias("account_id"),
        F.col(number_column).cast("string").alias("sub_acct_no_sbb"),
        F.lit(campaign_name).alias("campaign_name"),
        F.inline(tries),
    ).where("keep").drop("keep")
    return rows.distinct()


def call_rows(attempts: DataFrame, channel: str = CALL_CHANNEL) -> DataFrame:
    """Attempts in the form of the history, partition keys taken from the attempt date."""
    return conform(
        attempts.select(
            "*",
            F.col("comm_dt").cast("timestamp").alias("sent_dt"),
            F.lit(False).alias("conv_flg"),
            month_key(F.col("comm_dt")).alias("month"),
            day_key(F.col("comm_dt")).alias("day"),
            F.lit(channel).alias("channel"),
        ),
        HISTORY,
    )


def audience_to_communications(
    audience: DataFrame, run_day: dt.date, prefix: str, number_column: str, channel: str = CALL_CHANNEL
) -> DataFrame:
    """A call audience as history rows of the day with no status yet, one per account and campaign."""
    number = F.col(number_column).cast("string")
    rows = audience.select(
        prefixed_key(number, prefix).alias("account_id"), number.alias("sub_acct_no_sbb"), "campaign_name"
    ).distinct()
    rows = with_constants(rows, {"comm_dt": run_day, "conv_flg": False, "channel": channel})
    return conform(stamp(rows, run_day), HISTORY)
