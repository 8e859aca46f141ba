"""The batch jobs end to end: read, transform, write. Run dates and paths are arguments, never the wall clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import conform, read_ddl, stamp
from touchline.functions.dates import RunTime, parse_date, trailing_days
from touchline.operators import audience, compose, feeds, offers, status
from touchline.operators.attribution import account_bitmaps, best_channels, credited_again, touched_partitions, typed_conversions
from touchline.operators.ids import last_id
from touchline.operators.mirror import Mirror, mirror
from touchline.plans import mirrors
from touchline.schemas import CALL_FEEDBACK, CHANNEL_WEIGHTS, CONVERSIONS, HISTORY, HISTORY_KEYS, OFFER_FILE, OFFERS_IN
from touchline.session import staged
from touchline.sinks import handoff
from touchline.sinks import partitions as sink
from touchline.sinks.versions import Table
from touchline.sources.delivered import read_delivery
from touchline.sources.files import read_csv, read_export, read_pages
from touchline.sources.tables import file_or_slice, optional, scan, slice_between, slice_eq, slice_from

ARRIVAL_KEYS = ("month", "day", "day_hour")


# --- mirrors ---------------------------------------------------------------------------------------------

def mirror_slice(spark: SparkSession, source: str, root: str, spec: Mirror, value: str, prefix: str, key: str) -> None:
    """Replace one slice; ``key`` is the target's partition column, which carries the slice value."""
    rows = slice_eq(scan(spark, source), **{spec.slice_key: value})
    sink.replace_slice(mirror(rows, spec, prefix), root, key, value)


def mirror_since(spark: SparkSession, source: str, root: str, spec: Mirror, after: str, prefix: str, key: str) -> None:
    """Backfill: every slice after a date. Each slice found replaces its own, so a second run adds nothing."""
    rows = slice_from(scan(spark, source), spec.slice_key, after, inclusive=False)
    sink.write_partitions(mirror(rows, spec, prefix), root, [key])


def mirror_window(
    spark: SparkSession, source: str, root: str, spec: Mirror, run_day: dt.date, prefix: str, key: str = "dt",
    days: int = 14,
) -> None:
    """Replace the trailing window that ends on the run day; slice values are ``yyyyMMdd`` text."""
    low, high = f"{run_day - dt.timedelta(days=days - 1):%Y%m%d}", f"{run_day:%Y%m%d}"
    rows = slice_between(scan(spark, source), spec.slice_key, low, high)
    sink.replace_range(mirror(rows, spec, prefix), root, key, low, high)


def mirror_reload(spark: SparkSession, source: str, root: str, spec: Mirror, value: str, prefix: str) -> None:
    """One slice becomes the whole target."""
    sink.snapshot(mirror(slice_eq(scan(spark, source), **{spec.slice_key: value}), spec, prefix), root)


def mirror_whole(spark: SparkSession, source: str, root: str, spec: Mirror, prefix: str) -> None:
    """Full reload."""
    sink.snapshot(mirror(scan(spark, source), spec, prefix), root)


def price_book(spark: SparkSession, source: str, root: str, load: str) -> None:
    """Append the price book as one load; running the load again replaces it."""
    sink.append_batch(mirror(scan(spark, source), mirrors.PRICE_BOOK, ""), root, [], load, "load")


def snapshot_view(spark: SparkSession, view: str, root: str) -> None:
    sink.snapshot(scan(spark, view), root)


# --- events and communications ---------------------------------------------------------------------------

def load_feeds(
    sources: Mapping[str, DataFrame], roots: Mapping[str, str], programs: DataFrame, run_day: dt.date, tag: str | None,
    days: int = 1,
) -> None:
    """Filter and store the event feeds of a day; with no ``tag`` every program counts."""
    allowed = None if tag is None else feeds.tagged_programs(programs, tag)
    ids = None if allowed is None else feeds.program_campaigns(sources["campaigns"], allowed)
    wanted = None if allowed is None else allowed.select(F.col("id").alias("program_id"))
    for kind, events in sources.items():
        feed = feeds.event_feed(kind, events, run_day, ids, wanted, days)
        sink.write_partitions(feed, roots[kind], ["month", "day"], gather=False)


def compose_and_store(history_root: str, run_day: dt.date, **inputs) -> None:
    """Write the day's communications rows."""
    rows = compose.compose_day(run_day=run_day, **inputs)
    sink.write_partitions(rows, history_root, HISTORY_KEYS, gather=False)


def store_simple_history(
    history_root: str, run_day: dt.date, sends: DataFrame, cancels: DataFrame, bounces: DataFrame, campaigns: DataFrame,
    channel: str = "email", table: str | None = None,
) -> None:
    """Write the day's short history in place of an earlier run's; ``table`` is the catalog's name of it, if it has one."""
    rows = compose.compose_simple(sends, cancels, bounces, campaigns, run_day, channel)
    sink.write_partitions(rows, history_root, ["month", "day"], gather=False)
    announce(rows.sparkSession, table)


def announce(spark: SparkSession, table: str | None) -> None:
    """Tell the catalog of partitions written by path, if the folder is a table of it."""
    if table is not None:
        sink.register_partitions(spark, table)


def refresh_status(
    spark: SparkSession, history_root: str, run_day: dt.date, opens: DataFrame, clicks: DataFrame, bounces: DataFrame,
    channel: str = "email", days: int = status.WINDOW_DAYS,
) -> None:
    """Bring the status of the last ``days`` days of one channel up to date, in one pass over their partitions.

    Of the feeds only answers to messages of those days are read.
    """
    low = run_day - dt.timedelta(days=days - 1)
    opens, clicks, bounces = (
        feed.where(trailing_days(F.col("email_sent_at"), run_day, days)) for feed in (opens, clicks, bounces)
    )
    stored = spark.read.schema(HISTORY).parquet(history_root)
    rows = slice_between(slice_eq(stored, channel=channel), "day", f"{low:%Y%m%d}", f"{run_day:%Y%m%d}")
    sink.write_partitions(status.apply_status(rows, opens, clicks, bounces, channel), history_root, HISTORY_KEYS)


def typed_call_feedback(raw: DataFrame, prefix: str) -> DataFrame:
    """Call-feedback file to its stored form; dates are month/day/year."""
    days = {c: parse_date(F.col(c), ["M/d/yyyy"]) for c in compose.ATTEMPTS}
    key = F.concat(F.lit(prefix), F.col("cuenta"))
    return conform(raw.withColumns({**days, "account_id": key, "csv_origen": F.col("file_name")}), CALL_FEEDBACK)


def load_calls(
    spark: SparkSession, path: str, feedback_root: str, history_root: str, run: RunTime, prefix: str,
    campaign_name: str,
) -> None:
    """Store a call-feedback file and add its dial attempts to the history.

    The campaign name, which comes from the file name, tells the file's rows: loading it again replaces them.
    """
    calls = typed_call_feedback(read_csv(spark, path, with_name=True), prefix)
    sink.write_partitions(stamp(calls, run, "hour"), feedback_root, ARRIVAL_KEYS, gather=False)
    rows = compose.call_rows(compose.attempts_to_communications(calls, campaign_name))
    sink.merge_batch(
        rows, history_root, HISTORY_KEYS, "campaign_name", campaign_name, F.col("channel") == compose.CALL_CHANNEL
    )


def refresh_call_contact(
    spark: SparkSession, history_root: str, feedback: DataFrame, run_day: dt.date, channel: str = compose.CALL_CHANNEL
) -> None:
    """Contact dates of a day's call rows from the call feedback stored that day."""
    day = f"{run_day:%Y%m%d}"
    rows = slice_eq(spark.read.schema(HISTORY).parquet(history_root), day=day, channel=channel)
    rows = status.apply_call_contact(rows, slice_eq(feedback, day=day))
    sink.write_partitions(rows, history_root, HISTORY_KEYS, gather=False)


def attribute(
    spark: SparkSession, history_root: str, conversions: DataFrame | None = None, aside: str | None = None,
    arrived: str | None = None, archive: str | None = None, keys: Mapping[str, object] | None = None,
    table: str | None = None,
) -> None:
    """Credit arrived conversions over the whole history and publish it again; a second run changes nothing.

    Conversions are given, or read from the file ``arrived``, or else from the slice ``keys`` of the table ``archive``.
    ``aside`` is where the new history is written first, see :func:`publish`; ``table`` is the history's name in the catalog.
    """
    if conversions is None:
        conversions = file_or_slice(spark, arrived, archive, dict(keys or {}), read_csv)
    history = spark.read.schema(HISTORY).parquet(history_root)
    rows = credited_again(history, typed_conversions(conform(conversions, CONVERSIONS)))
    sink.publish(rows, history_root, HISTORY_KEYS, aside)
    announce(spark, table)


def history_table(spark: SparkSession, root: str, schema: str | T.StructType = HISTORY, keys: Sequence[str] = HISTORY_KEYS) -> Table:
    """The communications history as a table of versions, with the account bitmaps of its partitions."""
    rows = T.StructType([f for f in read_ddl(schema).fields if f.name not in keys])
    return Table(spark, root, keys, {"rows": rows, "accounts": "bucket long, bits binary"})


def store_history(table: Table, rows: DataFrame, replaced: Sequence[tuple] | None = None, since: int | None = None) -> int:
    """Make ``rows`` the table's, in place of the partitions ``replaced``, or of the whole table without it."""
    with staged(rows) as kept:
        return table.commit(replaced, since, rows=kept, accounts=account_bitmaps(kept, table.keys))


def attribute_changed(table: Table, conversions: DataFrame, weights: Mapping[str, int] = CHANNEL_WEIGHTS) -> list[tuple]:
    """Credit conversions in the partitions they concern; returns these.

    ``conversions`` are typed. Read and rewritten are the partitions that hold an account of a conversion, or rows that an
    earlier run paired and did not credit; of the others one column is read, for the best channel of each account. All
    rows of these accounts come out as :func:`credited_again` over the whole history gives them. Other rows of other
    partitions stay as they are; there an uncredited flag may be NULL where the whole run would write false.

    Readers see the table before the run or after it. A run that found its commit overtaken changes nothing.
    """
    since = table.last()
    partitions = [tuple(row) for row in touched_partitions(table.read("accounts", number=since), table.keys, conversions).collect()]
    if not partitions:
        return []
    rows = table.read("rows", partitions, since)
    reached = table.read("rows", number=since).select("account_id", "channel")
    best = best_channels(reached.join(rows.select("account_id").distinct(), "account_id", "left_semi"), weights)
    store_history(table, credited_again(rows, conversions, weights=weights, best=best), partitions, since)
    return sorted(partitions, key=repr)


# --- offers ----------------------------------------------------------------------------------------------

def load_offers(spark: SparkSession, path: str, root: str, run: RunTime, table: str | None = None) -> None:
    """Number, type and store an offers file; ids go on after the greatest stored one. ``table`` is its catalog name.

    The run's own partition does not count, so a run that is repeated gives the same ids.
    """
    ids = "id_oferta_int long, month string, day string, day_hour string"
    stored = optional(lambda: spark.read.schema(f"{OFFERS_IN}, {ids}").parquet(root), ids, spark)
    own = stamp(spark.range(1), run, "hour").select(*ARRIVAL_KEYS)
    stored = stored.join(F.broadcast(own), list(ARRIVAL_KEYS), "left_anti")  # one row
    rows = offers.offers_assign_ids(read_csv(spark, path), last_id(stored, "id_oferta_int"), run)
    sink.write_partitions(rows, root, ARRIVAL_KEYS, gather=False)
    announce(spark, table)


def request_links(offers_view: DataFrame, requests: DataFrame, root: str, folder: str, run: RunTime) -> None:
    with staged(offers.offers_links_in(offers_view, requests, run)) as rows:
        sink.write_partitions(rows, root, ARRIVAL_KEYS, gather=False)
        handoff.write_csv(rows, folder, drop=["ID_OFERTA_INT", *ARRIVAL_KEYS])


def store_links(spark: SparkSession, path: str, offered_root: str, root: str, run: RunTime) -> None:
    links = offers.typed_links(read_csv(spark, path))
    rows = offers.offers_links_out(spark.read.parquet(offered_root), links, run)
    sink.write_partitions(rows, root, ARRIVAL_KEYS, gather=False)


def request_packages(offers_view: DataFrame, requests: DataFrame, root: str, folder: str, run: RunTime) -> None:
    with staged(offers.offers_packages(offers_view, requests, run)) as rows:
        sink.write_partitions(rows, root, ARRIVAL_KEYS, gather=False)
        handoff.write_csv(offers.packages_handoff(rows), folder)


# --- accounts and contacts -------------------------------------------------------------------------------

def export_base(
    spark: SparkSession, accounts: DataFrame, key: str, prefix: str, constants: Mapping[str, str], folder: str,
    run_day: dt.date, winback_path: str | None = None, winback_key: str = "sub_acct_no_sbb",
) -> str:
    """Dated base-audience files; the win-back file is used when it is there."""
    winback = None
    if winback_path:
        winback = optional(lambda: read_csv(spark, winback_path), f"{winback_key} string", spark)
    rows = audience.base_audience(accounts, key, prefix, constants, winback, winback_key)
    return handoff.write_dated_csv(rows, folder, "fixed_base", run_day)


def load_contact_ids(
    spark: SparkSession, path: str, root: str, user: str, account: str, prefix: str, run: RunTime
) -> None:
    sink.snapshot(audience.contact_ids(read_export(spark, path), user, account, prefix, run), root)


def load_contact_export(spark: SparkSession, path: str, root: str, run: RunTime) -> None:
    rows = audience.contact_export(read_export(spark, path), run)
    sink.write_partitions(rows, root, ARRIVAL_KEYS, gather=False)


def load_call_audience(spark: SparkSession, path: str, root: str, folder: str, run: RunTime) -> None:
    """Store a call-centre export and hand it on; an empty file is an error. The file is read once."""
    export, seen = sink.observed(read_export(spark, path, with_name=True))
    with staged(audience.call_audience(export, run)) as rows:
        if not seen.get["rows"]:
            raise ValueError(f"{path} is empty")
        sink.write_partitions(rows, root, ARRIVAL_KEYS, gather=False)
        handoff.write_csv(rows, folder, drop=["channel", "campaign_name", *ARRIVAL_KEYS])


def load_paged_contacts(spark: SparkSession, pages: str, root: str, key: str, prefix: str) -> None:
    sink.snapshot(feeds.paged_contacts(read_pages(spark, pages, f"id string, `{key}` string"), key, prefix), root)


def load_winback(spark: SparkSession, path: str, root: str, archive: str, upload_date: str, prefix: str) -> None:
    """Archive the monthly win-back file and reload the typed table from it."""
    raw = read_csv(spark, path)
    handoff.archive_tsv(raw, archive, upload_date)
    sink.snapshot(mirror(raw, mirrors.WINBACK, prefix), root)


def archive_conversions(spark: SparkSession, path: str, root: str, run: RunTime) -> None:
    """Keep arrived conversions under their arrival time; the same arrival replaces itself."""
    rows = audience.conversion_archive(read_csv(spark, path), run)
    sink.write_partitions(rows, root, ["month", "day", "hour"], gather=False)


def typed_offer_files(
    spark: SparkSession, folder: str, day: dt.date, refused: str | None = None, run: RunTime | None = None
) -> DataFrame:
    """All offer files of a day, typed; columns are found by each file's own header.

    Rows that do not fit are stored in the table ``refused`` under the run's keys, as they came; running again replaces
    them. Without such a table they stay, with NULL for what does not fit.
    """
    found = read_delivery(spark, folder, OFFER_FILE, name_glob=f"*{day:%Y%m%d}*.csv", strict=refused is not None)
    if refused is not None:
        sink.write_partitions(stamp(found.refused, run or day, "hour"), refused, ARRIVAL_KEYS, gather=False)
    return found.rows.drop("file_name")
