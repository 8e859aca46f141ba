"""Offer files: surrogate ids, link requests and responses, package requests, typing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import apply_mapping, long_of, stamp
from touchline.functions.dates import RunTime, day_key, ms_to_date, parse_date
from touchline.operators.ids import dense_ids
from touchline.operators.joins import spread_join
from touchline.operators.latest import latest_per_key
from touchline.schemas import OFFER_FILE, OFFERS_IN

# Columns of the outgoing link request and of the package list, under their outside names.
LINK_REQUEST = {
    "SUB_ACCT_NO_SBB": "sub_acct_no",
    "FROM_CSG_CODE": "pkg_cde",
    "FROM_CSG_CODE_DESCRIPTION": "hsd_service",
    "TO_CSG_CODE": "recommendedpkg",
    "TO_CSG_CODE_DESCRIPTION": "tocsgcodefriendlyname",
    "PAYMENT_DIF": "delta_arpu",
}
PACKAGE_COLUMNS = (
    "SUB_ACCT_NO", "PKG_CDE", "ONLINE_DESCR_PKG", "SMT_DESCR_PKG", "HSD_SERVICE", "BUNDLECHARGE_CSG",
    "RECOMMENDEDPKG", "DISCOUNT", "DATE", "RANK", "PKG_TYPE", "STB", "ADDITIONAL_CHARGE", "DELTA_ARPU", "REGIME",
    "REWARD",
)


def offers_assign_ids(raw: DataFrame, last: int, run: RunTime) -> DataFrame:
    """Raw offers, typed and stamped, with ids that go on after ``last`` in account order."""
    numbered = dense_ids(raw, ["sub_acct_no"], "id_oferta_int", start=last)
    typed = apply_mapping(numbered, OFFERS_IN + ", id_oferta_int long")
    return stamp(typed, run, "hour")


def link_requests(requests: DataFrame) -> DataFrame:
    """The audience that needs links, typed; the two dates arrive as epoch milliseconds.

    Columns in: account, action_ms, expiration_ms, channel, use_case, offer_type.
    """
    return requests.select(
        long_of(requests, "account").alias("account"),
        ms_to_date(long_of(requests, "action_ms")).alias("action_date"),
        ms_to_date(long_of(requests, "expiration_ms")).alias("LINK_EXPIRATION_DT"),
        "channel", "use_case", "offer_type",
    )


def offers_links_in(offers: DataFrame, requests: DataFrame, run: RunTime) -> DataFrame:
    """Current offers asked for, matched on account, channel, action date, use case and offer type."""
    keys = ["account", "channel", "action_date", "use_case", "offer_type"]
    wanted = offers.select(
        long_of(offers, "sub_acct_no").alias("account"),
        F.to_date("next_best_action_date").alias("action_date"),
        "channel", "use_case", "offer_type",
        *[F.col(source).alias(name) for name, source in LINK_REQUEST.items()],
        F.col("id_oferta_int").alias("ID_OFERTA_INT"),
    )
    matched = spread_join(wanted, link_requests(requests), keys, "inner", by=["account"], right_repeats=True)
    return stamp(matched.select(*LINK_REQUEST, "LINK_EXPIRATION_DT", "ID_OFERTA_INT"), run, "hour")


def typed_links(links: DataFrame) -> DataFrame:
    """Link response file: account number, link, and the two dates from their text forms."""
    return links.select(
        long_of(links, "SUB_ACCT_NO").alias("account"),
        F.col("LINK").cast("string").alias("LINK"),
        parse_date(F.col("CREATED_DATETIME").cast("string"), ["M/d/yyyy h:m:s a"]).alias("LINK_GENERATED_DT"),
        parse_date(F.col("LINK_EXPIRATION_DT").cast("string"), ["yyyy-M-d"]).alias("LINK_EXPIRATION_DT"),
    )


def offers_links_out(offered: DataFrame, links: DataFrame, run: RunTime) -> DataFrame:
    """Links matched to the offers requested on the day of generation; the newest batch wins per account.

    Columns of ``offered``: SUB_ACCT_NO_SBB, id_oferta_int, day, day_hour. Within a batch the greater offer id,
    then the greater link, decides. As only the greatest of an account can win, both sides are reduced to one row
    per account and day before they meet: no pairs, and no key left to be hot.
    """
    requested = offered.select(
        long_of(offered, "SUB_ACCT_NO_SBB").alias("account"), "day", "SUB_ACCT_NO_SBB", "id_oferta_int", "day_hour"
    )
    newest = latest_per_key(requested, ["account", "SUB_ACCT_NO_SBB", "day"], ["day_hour", "id_oferta_int"])
    # the request's day is a partition key: joined as it is, it can prune the scan
    of_day = links.withColumn("day", day_key(F.col("LINK_GENERATED_DT")))
    greatest = latest_per_key(of_day, ["account", "day"], ["LINK", "LINK_EXPIRATION_DT"])
    matched = newest.join(greatest, ["account", "day"])
    columns = ["SUB_ACCT_NO_SBB", "LINK", "LINK_GENERATED_DT", "LINK_EXPIRATION_DT", "id_oferta_int"]
    won = latest_per_key(
        matched.select(*columns, "day_hour"), ["SUB_ACCT_NO_SBB"], ["day_hour", "id_oferta_int", "LINK"]
    )
    return stamp(won.select(*columns), run, "hour")


def offers_packages(offers: DataFrame, requests: DataFrame, run: RunTime) -> DataFrame:
    """Offers of the accounts in a package request, matched on account and offer type.

    Columns of ``requests``: account, offer_type.
    """
    keys = ["account", "offer_type"]
    wanted = offers.select(
        long_of(offers, "sub_acct_no").alias("account"), "offer_type",
        *[F.col(name.lower()).alias(name) for name in PACKAGE_COLUMNS],
    )
    asked = requests.select(long_of(requests, "account").alias("account"), "offer_type")
    matched = spread_join(wanted, asked, keys, "inner", by=["account"], right_repeats=True)
    return stamp(matched.select(*PACKAGE_COLUMNS), run, "hour")


def packages_handoff(packages: DataFrame, digits: int = 15) -> DataFrame:
    """The package list as handed over: reward as text with fixed digits, no bookkeeping columns."""
    return packages.drop("month", "day", "day_hour").withColumn("REWARD", F.format_number("REWARD", digits))


def offer_file_typing(raw: DataFrame) -> DataFrame:
    return apply_mapping(raw, OFFER_FILE)
