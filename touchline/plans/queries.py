"""One query per operator over the driver tables. Importing the module registers them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import columns as C
from touchline.functions import dates as D
from touchline.functions import names as N
from touchline.operators import audience, compose, feeds, latest, offers, status
from touchline.operators.attribution import attribute_conversions, credited_again, typed_conversions
from touchline.operators.ids import dense_ids, last_id
from touchline.operators.joins import lookup_join, spread_join
from touchline.operators.mirror import Mirror, mirror, replaced_range, replaced_slice
from touchline.plans import jobs
from touchline.plans.registry import query
from touchline.plans.views import RUN_DAY, Tables
from touchline.schemas import FEEDS
from touchline.session import new_path
from touchline.sources import tables as S
from touchline.sources.delivered import read_delivery

RUN = dt.datetime(1999, 6, 30, 10, 20, 30)
STAMP = "'199906' AS month, '19990630' AS day"
STAMP_HOUR = STAMP + ", '19990630102030' AS day_hour"


# --- scans -----------------------------------------------------------------------------------------------

@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def scan_slice_eq(t: Tables) -> DataFrame:
    return S.slice_eq(t.orders, o_orderstatus="F")


@query("SELECT * FROM orders WHERE o_orderdate > DATE '1998-01-01'")
def scan_slice_open_range(t: Tables) -> DataFrame:
    return S.slice_from(t.orders, "o_orderdate", dt.date(1998, 1, 1), inclusive=False)


@query("SELECT * FROM orders WHERE o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1999-06-30'")
def scan_slice_window(t: Tables) -> DataFrame:
    return S.slice_between(t.orders, "o_orderdate", dt.date(1997, 1, 1), RUN_DAY)


@query("SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'")
def scan_slice_composite(t: Tables) -> DataFrame:
    return S.slice_eq(t.orders, o_orderstatus="O", o_orderpriority="2-HIGH")


@query("SELECT event_id, event_type FROM events WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-24'")
def scan_trailing_days(t: Tables) -> DataFrame:
    rows = t.events.where(D.trailing_days(F.col("ts"), dt.date(2024, 1, 23), 14))
    return rows.select("event_id", "event_type")


@query("SELECT c_mktsegment AS id, c_name AS account FROM customer")
def paged_contacts_distinct(t: Tables) -> DataFrame:
    page = t.customer.select(F.col("c_mktsegment").alias("id"), F.col("c_name").alias("account"))
    return feeds.paged_contacts(feeds.union_pages([page, page]), "account", "Customer#")


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dashed, strftime(o_orderdate, '%Y%m%d') AS compact,
           replace(o_orderpriority, ' ', '_') AS campaign, 'base_' || replace(o_orderpriority, ' ', '_')
           || '_CALLCENTER_' AS mask, o_orderpriority || '_' || strftime(o_orderdate, '%Y%m%d') AS bare
    FROM orders""")
def filename_metadata_regex(t: Tables) -> DataFrame:
    export = F.concat(
        F.lit("base_"), F.replace("o_orderpriority", F.lit(" "), F.lit("_")), F.lit("_CALLCENTER_export_"),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv"),
    )
    feedback = F.concat(
        F.lit("outbound_feedback_"), F.col("o_orderpriority"), F.lit("_"), D.day_key(F.col("o_orderdate")),
        F.lit(".csv"),
    )
    return t.orders.select(
        "o_orderkey",
        N.dashed_date(export).alias("dashed"),
        N.compact_date(feedback).alias("compact"),
        N.campaign_of_export(export, "CALLCENTER").alias("campaign"),
        N.mask_of_export(export).alias("mask"),
        N.between_marks(feedback, "outbound_feedback_").alias("bare"),
    )


@query(r"SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS file_name FROM pages")
def url_base_name(t: Tables) -> DataFrame:
    return t.pages.select("page_id", N.base_name(F.col("url")).alias("file_name"))


@query("""
    SELECT o_orderkey AS order_no, CAST(o_custkey AS VARCHAR) AS account, o_orderdate AS placed,
           CAST(NULL AS INTEGER) AS program_id
    FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def sql_feed(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("feed_orders")
    t.customer.createOrReplaceTempView("feed_customers")
    return S.from_sql(
        t.spark, """
        select o_orderkey as order_no, o_custkey as account, o_orderdate as placed from feed_orders
        where o_orderstatus = :status and o_custkey in (select c_custkey from feed_customers where c_acctbal > 0)""",
        "order_no long, account string, placed timestamp_ntz, program_id int", status="O",
    )


# --- event feeds -----------------------------------------------------------------------------------------

FEED_OF_TYPE = {
    "sends": "signup", "opens": "view", "clicks": "click", "bounces": "error", "cancels": "purchase",
    "complaints": "error", "unsubscribes": "view",
}
SQL_TYPES = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp": "TIMESTAMP"}
FEED_COLUMNS = {
    "contact_id", "launch_id", "campaign_type", "campaign_id", "event_time", "email_sent_at", "domain",
    "message_id", "customer_id", "reason", "dsn_reason", "bounce_type", "link_id",
}
CAMPAIGN_COLUMNS = {"id", "name", "version_name", "type", "program_id", "event_time"}


def feed_sql(kind: str, have: set[str], rest: str) -> str:
    """Declared columns of a feed, typed, NULL where the source has none; the nested one is left out."""
    declared = [column.split(" ") for column in FEEDS[kind].split(", ")]
    picked = [
        f"CAST({name if name in have else 'NULL'} AS {SQL_TYPES[kind]}) AS {name}"
        for name, kind in declared if name != "geo"
    ]
    return f"SELECT {', '.join(picked)}, {STAMP} {rest}"


def register_feeds() -> None:
    for kind, event_type in FEED_OF_TYPE.items():
        sql = feed_sql(kind, FEED_COLUMNS, f"""
            FROM feed WHERE event_type = '{event_type}' AND contact_id IS NOT NULL
            AND CAST(event_time AS DATE) = DATE '{RUN_DAY}' AND campaign_id IN (
                SELECT id FROM campaigns WHERE program_id IN (SELECT id FROM programs WHERE contains(name, '#1')))""")

        def build(t: Tables, kind=kind, event_type=event_type) -> DataFrame:
            ids = feeds.program_campaigns(t.campaigns, feeds.tagged_programs(t.programs, "#1"))
            rows = t.feed.where(F.col("event_type") == event_type)
            return feeds.event_feed(kind, rows, RUN_DAY, campaign_ids=ids).drop("geo")

        query(sql, "feed", "campaigns", "programs", name=f"feed_{kind}")(build)

    def campaigns(t: Tables) -> DataFrame:
        wanted = feeds.tagged_programs(t.programs, "#1").select(F.col("id").alias("program_id"))
        return feeds.event_feed("campaigns", t.campaigns, dt.date(1999, 1, 31), program_ids=wanted, days=31).withColumn(
            "month", F.lit("199906")).withColumn("day", F.lit("19990630"))

    sql = feed_sql("campaigns", CAMPAIGN_COLUMNS, """
        FROM campaigns WHERE event_time < DATE '1999-02-01'
        AND program_id IN (SELECT id FROM programs WHERE contains(name, '#1'))""")
    query(sql, "campaigns", "programs", name="feed_campaigns")(campaigns)


register_feeds()

PLACE = "named_struct('time_zone', 'UTC', 'City_Name', concat('city ', message_id), 'postal_code', message_id * 10, 'since', event_time)"


def register_places() -> None:
    """Feeds whose nested place comes in another order and case, with a number for text, a field more and five fewer."""
    for kind in ("opens", "clicks"):
        event_type = FEED_OF_TYPE[kind]

        def build(t: Tables, kind=kind, event_type=event_type) -> DataFrame:
            rows = t.feed.where(F.col("event_type") == event_type).withColumn("geo", F.expr(f"if(message_id % 4 = 0, null, {PLACE})"))
            return feeds.event_feed(kind, rows, RUN_DAY).select(
                "contact_id", "launch_id", "event_time", F.col("geo").isNull().alias("no_place"), "geo.city_name",
                "geo.postal_code", "geo.time_zone", "geo.country_iso_code")

        query(f"""
            SELECT contact_id, launch_id, event_time, message_id % 4 = 0 AS no_place,
                   CASE WHEN message_id % 4 <> 0 THEN 'city ' || message_id END AS city_name,
                   CASE WHEN message_id % 4 <> 0 THEN CAST(message_id * 10 AS VARCHAR) END AS postal_code,
                   CASE WHEN message_id % 4 <> 0 THEN 'UTC' END AS time_zone, CAST(NULL AS VARCHAR) AS country_iso_code
            FROM feed WHERE event_type = '{event_type}' AND contact_id IS NOT NULL AND CAST(event_time AS DATE) = DATE '{RUN_DAY}'
            """, "feed", name=f"feed_{kind}_place")(build)


register_places()


@query("""
    SELECT l_orderkey AS order_id, l_linenumber AS line, CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS BIGINT) END AS quantity,
           CAST(NULL AS VARCHAR) AS note, CAST(l_shipdate AS DATE) AS shipped
    FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies = 1""")
def conform_nested_lines(t: Tables) -> DataFrame:
    """Orders as nested documents: lines with numbers as text, some of them no numbers, and ship dates by line as text."""
    whole = "cast(cast(l_quantity as bigint) as string)"
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("copies"), F.max("l_quantity").alias("l_quantity"), F.max("l_shipdate").alias("l_shipdate")).where("copies = 1")
    documents = lines.groupBy(F.col("l_orderkey").cast("string").alias("Order_Id")).agg(
        F.expr(f"collect_list(named_struct('Quantity', if(l_linenumber = 2, 'two', {whole}), 'LINE', cast(l_linenumber as string)))").alias("lines"),
        F.expr("map_from_entries(collect_list(struct(cast(l_linenumber as string), cast(to_date(l_shipdate) as string))))").alias("shipped"))
    nested = C.conform(documents, "order_id long, lines array<struct<line:int,quantity:long,note:string>>, shipped map<int,date>")
    return nested.select("order_id", "shipped", F.explode("lines").alias("l")).select(
        "order_id", "l.line", "l.quantity", "l.note", F.expr("shipped[l.line]").alias("shipped"))



# --- mirrors ---------------------------------------------------------------------------------------------

ORDER_MIRROR = Mirror(
    columns="account int, order_no long, placed timestamp, price double, priority int, status string, dt string",
    sources={"account": "o_custkey", "order_no": "o_orderkey", "placed": "o_orderdate", "price": "o_totalprice",
             "priority": "o_orderpriority", "status": "o_orderstatus"},
    slice_key="o_orderstatus", account_from="account", drop_account_from=True, timestamps_as_ms=True,
    ms_added=("dt",),
)
WINDOW_MIRROR = Mirror(
    columns="order_no long, price double, dt string, placed date", slice_key="dt",
    sources={"order_no": "o_orderkey", "price": "o_totalprice", "placed": "o_orderdate"},
    ms_added=("dt",), ms_instead=("placed",),
)


def dated_orders(t: Tables, pattern: str) -> DataFrame:
    return t.orders.withColumn("dt", F.date_format("o_orderdate", pattern))


@query("""
    SELECT 'ACC_' || o_custkey AS account_id, o_orderkey AS order_no,
           CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS placed, o_totalprice AS price,
           CAST(NULL AS INTEGER) AS priority, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS dt,
           CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS dt_ms
    FROM orders WHERE o_orderstatus = 'F'""")
def mirror_slice(t: Tables) -> DataFrame:
    twice = dated_orders(t, "yyyy-MM-dd")
    twice = twice.unionAll(twice)
    return mirror(S.slice_eq(twice, **{ORDER_MIRROR.slice_key: "F"}), ORDER_MIRROR, "ACC_")


@query("""
    SELECT 'P' || p_partkey AS "part code", p_brand AS brand, CAST(p_size AS BIGINT) AS size,
           p_retailprice AS regular, CAST(NULL AS BIGINT) AS "boxes-->" FROM part""")
def price_book(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.concat(F.lit("P"), "p_partkey").alias("part code"), F.col("p_brand").alias("brand name"),
        F.col("p_size").cast("string").alias("size"), F.col("p_retailprice").alias("regular"),
        F.col("p_type").alias("boxes-->"),
    )
    spec = Mirror("`part code` string, brand string, size long, regular double, `boxes-->` long",
                  {"brand": "brand name"}, slice_key=None)
    return mirror(raw.unionAll(raw), spec, "")


WINDOW_SQL = """
    SELECT o_orderkey AS order_no, o_totalprice + (CASE WHEN {inside} THEN 1 ELSE 0 END) AS price,
           strftime(o_orderdate, '%Y%m%d') AS dt, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS dt_ms,
           CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS placed_ms FROM orders"""


def moved_prices(t: Tables) -> tuple[DataFrame, DataFrame]:
    stored = dated_orders(t, "yyyyMMdd")
    return stored, stored.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query(WINDOW_SQL.format(inside="o_orderdate BETWEEN DATE '1999-06-17' AND DATE '1999-06-30'"))
def mirror_window_replace(t: Tables) -> DataFrame:
    stored, source = moved_prices(t)
    rows = S.slice_between(source, "dt", "19990617", "19990630")
    return replaced_range(
        mirror(stored, WINDOW_MIRROR, ""), mirror(rows, WINDOW_MIRROR, ""), "dt", "19990617", "19990630"
    )


@query(WINDOW_SQL.format(inside="o_orderdate = DATE '1999-06-30'"))
def slice_replace_result(t: Tables) -> DataFrame:
    stored, source = moved_prices(t)
    rows = S.slice_eq(source, dt="19990630")
    return replaced_slice(mirror(stored, WINDOW_MIRROR, ""), mirror(rows, WINDOW_MIRROR, ""), "dt", "19990630")


# --- columns ---------------------------------------------------------------------------------------------

@query("""
    SELECT event_id AS id, CAST(NULL AS INTEGER) AS bad_number, k AS number,
           CASE WHEN event_type = 'view' THEN true WHEN event_type = 'error' THEN false END AS flag,
           CASE WHEN event_type = 'click' THEN DATE '2024-02-03' END AS day, CAST(k AS DOUBLE) AS amount
    FROM ev""", "ev")
def typed_mapping_bad_values(t: Tables) -> DataFrame:
    raw = t.ev.selectExpr(
        "event_id", "concat('n', k) as props", "cast(k as string) as k", "cast(k as string) as amount",
        "case event_type when 'view' then 'Y' when 'error' then '0' else '12.7' end as flag",
        "if(event_type = 'click', '2024-02-03', '03-02-2024') as day",
    )
    return C.apply_mapping(
        raw, "id long, bad_number int, number int, flag boolean, day date, amount double",
        {"id": "event_id", "bad_number": "props", "number": "k"},
    )


@query(f"SELECT *, {STAMP_HOUR} FROM orders")
def run_date_stamp(t: Tables) -> DataFrame:
    return C.stamp(t.orders, RUN, "hour")


@query("""
    SELECT 'ACC_' || o_custkey AS account_id, CAST(o_custkey AS VARCHAR) AS number, 'FIXED' AS mkt,
           strftime(o_orderdate, '%Y%m') AS month, strftime(o_orderdate, '%Y%m%d') AS day, o_orderkey,
           CAST(NULL AS TIMESTAMP) AS open_dt, CAST(NULL AS INTEGER) AS clicks_count FROM orders""")
def date_partition_keys(t: Tables) -> DataFrame:
    key = C.prefixed_key(F.col("o_custkey"), "ACC_")
    keyed = t.orders.select(
        key.alias("account_id"), C.stripped_key(key, "ACC_").alias("number"),
        D.month_key(F.col("o_orderdate")).alias("month"), D.day_key(F.col("o_orderdate")).alias("day"), "o_orderkey",
    )
    return C.with_nulls(C.with_constants(keyed, {"mkt": "FIXED"}), "open_dt timestamp, clicks_count int")


@query("""
    SELECT c_custkey AS "user_id_", c_name AS "full_name", c_acctbal AS "balance__usd_", c_mktsegment AS segment
    FROM customer""")
def clean_header_projection(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.col("c_custkey").alias("user id)"), F.col("c_name").alias("full \t name"),
        F.col("c_acctbal").alias("balance (usd)"), F.col("c_mktsegment").alias("segment"),
    )
    return C.clean_header(raw)


@query("SELECT c_custkey AS account, c_mktsegment, c_acctbal FROM customer")
def rename_lower_drop(t: Tables) -> DataFrame:
    upper = t.customer.toDF(*[c.upper() for c in t.customer.columns])
    return C.lower_names(upper).withColumnRenamed("c_custkey", "account").drop("c_name", "c_nationkey")


@query("""
    SELECT event_id, contact_id, k, event_type, value, CAST(floor(epoch(event_time)) AS BIGINT) * 1000 AS event_time,
           CAST(floor(epoch(load_time)) AS BIGINT) * 1000 AS load_time FROM ev""", "ev")
def epoch_ms_all_timestamps(t: Tables) -> DataFrame:
    return C.timestamps_to_epoch_ms(t.ev)


@query("""
    SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS second,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS label FROM events""")
def epoch_ms_to_date(t: Tables) -> DataFrame:
    ms = D.epoch_ms(F.col("ts"))
    return t.events.select(
        "event_id", D.ms_to_date(ms).alias("day"), D.ms_to_timestamp(ms).alias("second"), D.ms_to_text(ms).alias("label")
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS moment FROM orders""")
def multi_pattern_dates(t: Tables) -> DataFrame:
    text = F.date_format
    forms = t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", text("o_orderdate", "M/d/yyyy"))
                            .when(F.col("o_orderpriority") == "2-HIGH", text("o_orderdate", "yyyyMMdd"))
                            .when(F.col("o_orderpriority") == "3-MEDIUM", text("o_orderdate", "yyyy-MM-d"))
                            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", text("o_orderdate", "MM/dd/yyyy"))
                            .otherwise(text("o_orderdate", "d. MMMM")).alias("form"))
    return forms.select(
        "o_orderkey", D.parse_date(F.col("form")).alias("day"), D.parse_timestamp(F.col("form")).alias("moment")
    )


# --- predicates ------------------------------------------------------------------------------------------

@query("""
    SELECT comm_id, conv_flg, conv_flg IS TRUE AS converted,
           conv_flg AND campaign_name = 'F' AS both_true, conv_flg OR campaign_name = 'F' AS any_true
    FROM contact_history""", "contact_history")
def three_valued_split(t: Tables) -> DataFrame:
    flag, f = F.col("conv_flg"), F.col("campaign_name") == "F"
    rows = t.contact_history
    converted = rows.where(flag).withColumn("converted", F.lit(True))
    open_rows = rows.where(~F.coalesce(flag, F.lit(False))).withColumn("converted", F.lit(False))
    return converted.unionByName(open_rows).select(
        "comm_id", "conv_flg", "converted", (flag & f).alias("both_true"), (flag | f).alias("any_true")
    )


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%red%' OR p_name LIKE '%bolt%'")
def like_any(t: Tables) -> DataFrame:
    return t.part.where(C.contains_any(F.col("p_name"), ["red", "bolt"])).select("p_partkey", "p_name")


@query("SELECT p_partkey, contains(p_name, lower(p_type)) AS named FROM part")
def column_contains(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_name").contains(F.lower("p_type")).alias("named"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> CASE WHEN o_orderstatus = 'F' "
       "THEN '2-HIGH' WHEN o_orderstatus = 'O' THEN '5-LOW' END")
def unequal_nullable(t: Tables) -> DataFrame:
    other = F.when(F.col("o_orderstatus") == "F", "2-HIGH").when(F.col("o_orderstatus") == "O", "5-LOW")
    return t.orders.where(F.col("o_orderpriority") != other).select("o_orderkey", "o_orderpriority")


# --- joins -----------------------------------------------------------------------------------------------

@query("""
    SELECT h.comm_id, h.contact_id, c.account_id, substring(c.account_id, 5) AS number
    FROM history h LEFT JOIN contacts c ON h.contact_id = c.user_id""", "history", "contacts")
def left_lookup_dedup(t: Tables) -> DataFrame:
    rows = spread_join(t.history, compose.contact_accounts(t.contacts), ["contact_id"])
    return rows.select("comm_id", "contact_id", "account_id", C.stripped_key(F.col("account_id"), "ACC_").alias("number"))


@query("""
    SELECT h.comm_id, h.channel, c.account_id FROM history h
    LEFT JOIN contacts c ON h.contact_id = c.user_id AND h.channel = 'email'""", "history", "contacts")
def left_lookup_on_literal(t: Tables) -> DataFrame:
    ids = compose.contact_accounts(t.contacts)
    rows = spread_join(t.history, ids, ["contact_id"], only_when=F.col("channel") == "email")
    return rows.select("comm_id", "channel", "account_id")


@query("""
    SELECT comm_id, account_id, CASE channel WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END
           AS weight FROM contact_history""", "contact_history")
def channel_weights(t: Tables) -> DataFrame:
    weights = S.local_table(t.spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "channel string, weight int")
    return lookup_join(t.contact_history, weights, ["channel"]).select("comm_id", "account_id", "weight")


@query("""
    SELECT event_id, k FROM ev WHERE k IN (SELECT id FROM campaigns WHERE program_id IN (
        SELECT id FROM programs WHERE contains(name, '#2')))""", "ev", "campaigns", "programs")
def semi_join_campaigns(t: Tables) -> DataFrame:
    ids = feeds.program_campaigns(t.campaigns, feeds.tagged_programs(t.programs, "#2"))
    rows = t.ev.withColumn("campaign_id", F.col("k").cast("long"))
    return lookup_join(rows, ids, ["campaign_id"], "left_semi").select("event_id", "k")


@query("""
    SELECT event_id, event_type FROM answers a WHERE event_type = 'view' AND EXISTS (
        SELECT 1 FROM history h WHERE h.contact_id = a.contact_id AND h.campaign_id = a.campaign_id)""",
       "answers", "history")
def existence_semi(t: Tables) -> DataFrame:
    rows = t.answers("view").withColumn("campaign_id", F.col("campaign_id").cast("long"))
    known = t.history.select("contact_id", "campaign_id").distinct()
    joined = spread_join(rows, known, ["contact_id", "campaign_id"], "left_semi")
    return joined.select("event_id", F.lit("view").alias("event_type"))


# --- latest and first ------------------------------------------------------------------------------------

@query("""
    SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_offer_per_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest.latest_per_key(rows, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate FROM (
        SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1""")
def latest_offers_with_ties(t: Tables) -> DataFrame:
    return latest.latest_with_ties(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate")


@query("""
    SELECT id, name, program_id, event_time, p_partkey FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_time DESC, p_partkey DESC) AS rn
        FROM campaigns) WHERE rn = 1""", "campaigns")
def latest_campaign(t: Tables) -> DataFrame:
    return compose.latest_campaigns(
        t.campaigns.select("id", "name", "program_id", "event_time", "p_partkey"), ["p_partkey"]
    )


@query("""
    SELECT user_id, event_id, event_type, ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_event_attrs(t: Tables) -> DataFrame:
    return latest.first_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"])


# --- status of messages ----------------------------------------------------------------------------------

STATUS_SQL = """
    , open_of AS (SELECT contact_id, campaign_id, email_sent_at, min(event_time) AS first_open FROM answers
          WHERE event_type = 'view' AND date_diff('day', email_sent_at, CAST(event_time AS DATE)) <= 14 GROUP BY ALL),
    click_of AS (SELECT contact_id, campaign_id, email_sent_at, min(event_time) AS first_click,
          CAST(count(*) AS INTEGER) AS clicks FROM answers
          WHERE event_type = 'click' AND date_diff('day', email_sent_at, CAST(event_time AS DATE)) <= 14 GROUP BY ALL),
    bounce_of AS (SELECT contact_id, campaign_id, email_sent_at, event_time AS first_bounce, bounce_type AS btype,
          dsn_reason AS reason FROM answers
          WHERE event_type = 'error' AND date_diff('day', email_sent_at, CAST(event_time AS DATE)) <= 14
          QUALIFY row_number() OVER (PARTITION BY contact_id, campaign_id, email_sent_at
                                     ORDER BY event_time, bounce_type, dsn_reason) = 1)
    SELECT h.comm_id, h.contact_id, h.campaign_id, h.comm_dt, h.sent_dt, h.channel, {columns}
    FROM history h
    LEFT JOIN open_of o ON h.contact_id = o.contact_id AND h.campaign_id = o.campaign_id
         AND h.comm_dt = o.email_sent_at AND h.channel = 'email'
    LEFT JOIN click_of c ON h.contact_id = c.contact_id AND h.campaign_id = c.campaign_id
         AND h.comm_dt = c.email_sent_at AND h.channel = 'email'
    LEFT JOIN bounce_of b ON h.contact_id = b.contact_id AND h.campaign_id = b.campaign_id
         AND h.comm_dt = b.email_sent_at AND h.channel = 'email'"""
OLD = {"open": "h.open_dt, h.contact_dt", "click": "h.click_dt, h.clicks_count",
       "bounce": "h.bounce_dt, h.bounce_type, h.dsn_reason"}
NEW = {
    "open": "coalesce(h.open_dt, o.first_open) AS open_dt, coalesce(h.contact_dt, o.first_open) AS contact_dt",
    "click": "coalesce(h.click_dt, c.first_click) AS click_dt, coalesce(c.clicks, h.clicks_count) AS clicks_count",
    "bounce": "coalesce(h.bounce_dt, b.first_bounce) AS bounce_dt, CASE WHEN b.first_bounce IS NOT NULL THEN b.btype "
              "ELSE h.bounce_type END AS bounce_type, CASE WHEN b.first_bounce IS NOT NULL THEN b.reason "
              "ELSE h.dsn_reason END AS dsn_reason",
}


def status_sql(*fresh: str) -> str:
    return STATUS_SQL.format(columns=", ".join(NEW[k] if k in fresh else OLD[k] for k in OLD))


@query(status_sql("open"), "history", "answers")
def first_open(t: Tables) -> DataFrame:
    return status.apply_first_open(t.history, t.answers("view"))


@query(status_sql("click"), "history", "answers")
def click_counts(t: Tables) -> DataFrame:
    return status.apply_clicks(t.history, t.answers("click"))


@query(status_sql("bounce"), "history", "answers")
def first_bounce(t: Tables) -> DataFrame:
    return status.apply_first_bounce(t.history, t.answers("error"))


@query(status_sql("open", "click", "bounce"), "history", "answers")
def status_combined(t: Tables) -> DataFrame:
    return status.apply_status(t.history, t.answers("view"), t.answers("click"), t.answers("error"))


@query("""
    SELECT o.o_orderkey, 'ACC_' || o.o_custkey AS account_id, CAST(o.o_orderdate AS DATE) AS comm_dt,
           coalesce(CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate - INTERVAL 1 DAY END, c.first_call) AS contact_dt
    FROM orders o LEFT JOIN (
        SELECT o_custkey, min(o_orderdate) AS first_call FROM orders
        WHERE o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%LOW%' GROUP BY o_custkey) c
    ON o.o_custkey = c.o_custkey AND o.o_orderdate = c.first_call""")
def call_contact(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "o_orderkey", "concat('ACC_', o_custkey) as account_id", "to_date(o_orderdate) as comm_dt",
        "if(o_orderstatus = 'F', o_orderdate - interval 1 day, null) as contact_dt",
    )
    calls = t.orders.selectExpr(
        "concat('ACC_', o_custkey) as account_id", "to_date(o_orderdate) as Intento_discado_1",
        "o_orderpriority as Disposicion",
    )
    return status.apply_call_contact(rows, calls, contacted=["HIGH", "LOW"])


# --- composing the history -------------------------------------------------------------------------------

ATTEMPTS_SQL = """
    SELECT account_id, sub_acct_no_sbb, '{campaign}' AS campaign_name, a1 AS comm_dt,
           CASE WHEN reached AND a1 >= coalesce(a2, a3, a1) THEN a1 END AS contact_dt FROM c WHERE a1 IS NOT NULL
    UNION SELECT account_id, sub_acct_no_sbb, '{campaign}', a2,
           CASE WHEN reached AND a2 >= coalesce(a3, a1, a2) THEN a2 END FROM c WHERE a2 IS NOT NULL AND a2 <> a1
    UNION SELECT account_id, sub_acct_no_sbb, '{campaign}', a3,
           CASE WHEN reached AND a3 >= coalesce(a2, a1, a3) THEN a3 END FROM c WHERE a3 IS NOT NULL AND a3 <> a2"""
CALLS_SQL = ", c AS (SELECT *, contains(disposition, 'R') OR contains(disposition, 'A') AS reached FROM calls)"


@query(CALLS_SQL + ATTEMPTS_SQL.format(campaign="spring"), "calls")
def call_attempts_unpivot(t: Tables) -> DataFrame:
    return compose.attempts_to_communications(t.calls, "spring", contacted=["R", "A"])


@query(CALLS_SQL + ", n AS (" + ATTEMPTS_SQL.format(campaign="spring") + """)
    SELECT account_id, sub_acct_no_sbb, campaign_name, comm_dt, CAST(comm_dt AS TIMESTAMP) AS sent_dt,
           CAST(contact_dt AS TIMESTAMP) AS contact_dt, false AS conv_flg, strftime(comm_dt, '%Y%m') AS month,
           strftime(comm_dt, '%Y%m%d') AS day, 'Outbound_call' AS channel FROM n""", "calls")
def call_history_rows(t: Tables) -> DataFrame:
    rows = compose.call_rows(compose.attempts_to_communications(t.calls, "spring", contacted=["R", "A"]))
    return rows.select("account_id", "sub_acct_no_sbb", "campaign_name", "comm_dt", "sent_dt", "contact_dt", "conv_flg",
                       "month", "day", "channel")


@query(f"""
    SELECT 'ACC_' || c_custkey AS account_id, CAST(c_custkey AS VARCHAR) AS sub_acct_no_sbb,
           c_mktsegment AS campaign_name, DATE '{RUN_DAY}' AS comm_dt, false AS conv_flg,
           CAST(NULL AS INTEGER) AS clicks_count, {STAMP}, 'Outbound_call' AS channel FROM customer""")
def audience_rows(t: Tables) -> DataFrame:
    people = t.customer.withColumnRenamed("c_mktsegment", "campaign_name")
    rows = compose.audience_to_communications(people.unionAll(people), RUN_DAY, "ACC_", "c_custkey")
    return rows.select("account_id", "sub_acct_no_sbb", "campaign_name", "comm_dt", "conv_flg", "clicks_count", "month",
                       "day", "channel")


@query(f"""
    SELECT f.contact_id, 'email' AS channel, f.campaign_id, c.name AS campaign_name, f.event_time, f.launch_id, {STAMP}
    FROM feed f LEFT JOIN (
        SELECT id, name FROM campaigns QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_time DESC, name DESC) = 1
    ) c ON f.campaign_id = c.id
    WHERE f.event_type IN ('signup', 'purchase', 'error') AND f.contact_id IS NOT NULL
      AND CAST(f.event_time AS DATE) = DATE '{RUN_DAY}'""", "feed", "campaigns")
def compose_simple(t: Tables) -> DataFrame:
    rows = t.feed.withColumn("campaign_id", F.col("campaign_id").cast("long"))
    kinds = [rows.where(F.col("event_type") == kind) for kind in ("signup", "purchase", "error")]
    return compose.compose_simple(*kinds, t.campaigns, RUN_DAY)


@query(f"""
    , base AS (
        SELECT DISTINCT contact_id, campaign_id, CAST(event_time AS DATE) AS comm_dt,
               CASE WHEN event_type = 'signup' THEN event_time END AS sent_dt,
               CASE WHEN event_type = 'purchase' THEN event_time END AS cancel_dt,
               CASE WHEN event_type = 'purchase' THEN reason END AS cancel_reason
        FROM feed WHERE event_type IN ('signup', 'purchase') AND contact_id IS NOT NULL
        AND CAST(event_time AS DATE) = DATE '{RUN_DAY}'),
    offered AS (
        SELECT 'ACC_' || account AS account_id, * EXCLUDE (account) FROM offers
        WHERE offer_type = 'single' AND channel = 'email' AND day <= DATE '{RUN_DAY}'
        QUALIFY rank() OVER (PARTITION BY account, use_case ORDER BY day DESC) = 1),
    link AS (
        SELECT * FROM links QUALIFY row_number() OVER (
            PARTITION BY id_oferta_int ORDER BY link_generated_dt DESC, link_expiration_dt DESC, link DESC) = 1),
    campaign AS (
        SELECT id, program_id FROM campaigns
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_time DESC, program_id DESC) = 1)
    SELECT c.account_id, substring(c.account_id, 5) AS sub_acct_no_sbb, o.use_case, p.name AS campaign_name,
           b.contact_id, b.campaign_id, b.comm_dt, b.sent_dt, b.cancel_dt, b.cancel_reason, o.id_oferta_int,
           o.offer_type, o.day AS rec_date, o.regime, l.link, l.link_generated_dt, l.link_expiration_dt,
           CAST(m.program_id AS INTEGER) AS program_id, {STAMP}, 'email' AS channel
    FROM base b LEFT JOIN contacts c ON b.contact_id = c.user_id
    LEFT JOIN offered o ON c.account_id = o.account_id
    LEFT JOIN link l ON o.id_oferta_int = l.id_oferta_int
    LEFT JOIN campaign m ON b.campaign_id = m.id LEFT JOIN programs p ON m.program_id = p.id""",
       "feed", "campaigns", "programs", "contacts", "offers", "links")
def compose_full(t: Tables) -> DataFrame:
    rows = t.feed.withColumn("campaign_id", F.col("campaign_id").cast("long"))
    whole = compose.compose_day(
        rows.where(F.col("event_type") == "signup"), rows.where(F.col("event_type") == "purchase"),
        t.contacts, t.offers, t.links, t.campaigns, t.programs, RUN_DAY, "ACC_",
    )
    return whole.select(
        "account_id", "sub_acct_no_sbb", "use_case", "campaign_name", "contact_id", "campaign_id", "comm_dt", "sent_dt",
        "cancel_dt", "cancel_reason", "id_oferta_int", "offer_type", "rec_date", "regime", "link", "link_generated_dt",
        "link_expiration_dt", "program_id", "month", "day", "channel",
    )


# --- attribution -----------------------------------------------------------------------------------------

ATTRIBUTED = """
    , weighted AS (
        SELECT *, CASE channel WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                  WHEN '4-NOT SPECIFIED' THEN 4 END AS weight FROM contact_history),
    ranked AS (SELECT *, min(weight) OVER (PARTITION BY account_id) AS best FROM weighted)
    SELECT r.comm_id, r.account_id, r.channel, r.campaign_name, r.contact_dt,
           CASE WHEN r.conv_flg THEN r.conv_flg ELSE
               contains(r.campaign_name, c.conv_use_case_cat)
               AND date_diff('day', CAST(r.contact_dt AS DATE), CAST(c.conversion_ts AS DATE)) BETWEEN 0 AND 14
               AND r.weight = r.best END AS conv_flg,
           CASE WHEN r.conv_flg THEN r.conv_use_case_cat ELSE c.conv_use_case_cat END AS conv_use_case_cat,
           CASE WHEN r.conv_flg THEN r.order_id ELSE c.order_id END AS order_id,
           CASE WHEN r.conv_flg THEN r.conversion_dt ELSE strftime(c.conversion_ts, '%Y-%m-%d %H:%M:%S') END
               AS conversion_dt,
           CASE WHEN r.conv_flg THEN r.conversion_type WHEN c.order_id IS NOT NULL THEN 'new' END AS conversion_type
    FROM ranked r LEFT JOIN conversions c ON r.account_id = c.account_id AND r.conv_flg IS NOT TRUE"""
WEIGHTS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}


@query(ATTRIBUTED, "contact_history", "conversions", name="attribute_conversions")
def attribute(t: Tables) -> DataFrame:
    return attribute_conversions(t.contact_history, typed_conversions(t.conversions), WEIGHTS)


@query(ATTRIBUTED, "contact_history", "conversions")
def attribute_conversions_again(t: Tables) -> DataFrame:
    """The operator over its own result gives that result."""
    found = typed_conversions(t.conversions)
    return credited_again(attribute_conversions(t.contact_history, found, WEIGHTS), found, weights=WEIGHTS)


CHANGED = ATTRIBUTED.replace("FROM contact_history)", "FROM parted)").replace("JOIN conversions c ON", "JOIN asked c ON")


@query(f"""
    , parted AS (SELECT *, strftime(contact_dt, '%Y%m') AS month FROM contact_history),
    asked AS (SELECT * FROM conversions WHERE account_id LIKE 'ACC_1%7'),
    touched AS (SELECT DISTINCT month, channel FROM parted WHERE account_id IN (SELECT account_id FROM asked)),
    credited AS (WITH nothing AS (SELECT 1) {CHANGED}),
    told AS (SELECT c.*, p.month FROM credited c JOIN parted p USING (comm_id))
    SELECT * FROM told SEMI JOIN touched USING (month, channel)
    UNION ALL BY NAME
    SELECT comm_id, account_id, channel, campaign_name, contact_dt, conv_flg, conv_use_case_cat, order_id, conversion_dt,
           conversion_type, month FROM parted ANTI JOIN touched USING (month, channel)""", "contact_history", "conversions")
def attribute_changed_partitions(t: Tables) -> DataFrame:
    """Conversions of a few accounts, credited in a table of versions: the whole table as it then is."""
    history = t.contact_history.withColumn("month", F.date_format("contact_dt", "yyyyMM"))
    table = jobs.history_table(t.spark, new_path(t.spark), history.schema, ("month", "channel"))
    jobs.store_history(table, history)
    jobs.attribute_changed(table, typed_conversions(t.conversions).where("account_id LIKE 'ACC_1%7'"), WEIGHTS)
    return table.read("rows")


@query("""
    SELECT o_orderkey, o_orderdate AS slashed, o_orderdate AS dashed,
           CASE WHEN day(o_orderdate) <= 12 THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate), 0, 0, 0)
           END AS taken_month_first FROM orders""")
def day_first_dates(t: Tables) -> DataFrame:
    """Day-first text by its own forms; by the common ones it is another day, or none if the day is above 12."""
    when = F.col("o_orderdate")
    text = t.orders.select("o_orderkey", F.date_format(when, "d/M/yyyy").alias("slash"), F.date_format(when, "d-M-yyyy").alias("dash"))
    return text.select(
        "o_orderkey", D.parse_timestamp(F.col("slash"), D.DAY_FIRST_PATTERNS).alias("slashed"),
        D.parse_timestamp(F.col("dash"), D.DAY_FIRST_PATTERNS).alias("dashed"), D.parse_timestamp(F.col("slash")).alias("taken_month_first"))


# --- audiences and contacts ------------------------------------------------------------------------------

BASE = {"org_cntry": "XX", "mkt": "FIXED"}


@query("SELECT DISTINCT 'ACC_' || o_custkey AS account_id, 'XX' AS org_cntry, 'FIXED' AS mkt FROM orders")
def base_audience(t: Tables) -> DataFrame:
    return audience.base_audience(t.orders, "o_custkey", "ACC_", BASE)


@query("""
    SELECT DISTINCT 'ACC_' || o_custkey AS account_id, 'XX' AS org_cntry, 'FIXED' AS mkt FROM (
        SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2000-06-30' UNION ALL SELECT c_custkey FROM customer)""")
def base_audience_with_winback(t: Tables) -> DataFrame:
    recent = S.slice_from(t.orders, "o_orderdate", dt.date(2000, 6, 30))
    winback = t.customer.select(F.col("c_custkey").cast("string"))
    return audience.base_audience(recent, "o_custkey", "ACC_", BASE, winback, "c_custkey")


@query("SELECT c_custkey AS user_id, c_name AS account_id, '19990630' AS process_day FROM customer")
def contact_ids(t: Tables) -> DataFrame:
    raw = t.customer.select(F.col("c_custkey").cast("string").alias("user id"), F.col("c_name").alias("account (key)"))
    return audience.contact_ids(raw, "user_id", "account__key_", "Customer#", RUN)


@query(f"SELECT c_custkey AS user_id, c_acctbal AS \"balance_usd_\", {STAMP_HOUR} FROM customer")
def contact_export(t: Tables) -> DataFrame:
    raw = t.customer.select(F.col("c_custkey").alias("user id"), F.col("c_acctbal").alias("balance usd)"))
    return audience.contact_export(raw, RUN)


@query(f"""
    SELECT c_custkey AS user_id, 'CALLCENTER' AS channel, c_mktsegment AS campaign_name, {STAMP_HOUR}
    FROM customer""")
def call_audience(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.col("c_custkey").alias("user id"),
        F.concat(F.lit("base_"), "c_mktsegment", F.lit("_CALLCENTER_export.csv")).alias("file_name"),
    )
    return audience.call_audience(raw, RUN)


@query("SELECT *, '199906' AS month, '19990630' AS day, '102030' AS hour FROM orders")
def conversion_archive(t: Tables) -> DataFrame:
    return audience.conversion_archive(t.orders, RUN)


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS number, strftime(o_orderdate, '%Y-%m-%d') AS disconnection_date,
           o_totalprice AS amount, CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END
           AS hasvideo, 'ACC_' || o_custkey AS account_id,
           CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS disconnection_date_ms FROM orders""")
def winback_load(t: Tables) -> DataFrame:
    raw = t.orders.selectExpr(
        "cast(o_custkey as string) as number", "date_format(o_orderdate, 'yyyy-MM-dd') as `disconnection date`",
        "cast(o_totalprice as string) as amount", "o_orderkey as line",
        "case o_orderstatus when 'F' then '1' when 'O' then 'N' else '?' end as hasvideo",
    )
    spec = Mirror("number string, disconnection_date string, amount double, hasvideo boolean",
                  {"disconnection_date": "disconnection date"}, slice_key=None, account_from="number",
                  ms_added=("disconnection_date",))
    return mirror(raw, spec, "ACC_")


# --- offers ----------------------------------------------------------------------------------------------

@query("""
    SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey)
           + (SELECT max(c_custkey) FROM customer) AS id_oferta_int FROM orders""")
def surrogate_ids(t: Tables) -> DataFrame:
    last = last_id(t.customer, "c_custkey")
    return dense_ids(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "id_oferta_int", last)


@query(f"""
    SELECT o.account AS "SUB_ACCT_NO_SBB", 'P' || (o.id_oferta_int % 7) AS "FROM_CSG_CODE",
           o.use_case AS "FROM_CSG_CODE_DESCRIPTION", 'R' || (o.id_oferta_int % 5) AS "TO_CSG_CODE",
           o.regime AS "TO_CSG_CODE_DESCRIPTION", o.o_totalprice AS "PAYMENT_DIF", r.last + 30 AS "LINK_EXPIRATION_DT",
           o.id_oferta_int AS "ID_OFERTA_INT", {STAMP_HOUR}
    FROM offers o JOIN (
        SELECT account, use_case, offer_type, channel, max(day) AS last FROM offers GROUP BY ALL) r
    ON o.account = r.account AND o.use_case = r.use_case AND o.offer_type = r.offer_type AND o.channel = r.channel
       AND o.day = r.last""", "offers")
def offers_links_in(t: Tables) -> DataFrame:
    asked = t.offers.groupBy("sub_acct_no", "use_case", "offer_type", "channel").agg(
        F.max("next_best_action_date").alias("last")
    )
    midnight = D.epoch_ms(F.col("last").cast("timestamp"))
    month = D.epoch_ms(F.date_add("last", 30).cast("timestamp"))
    requests = asked.select(
        F.col("sub_acct_no").alias("account"), midnight.cast("string").alias("action_ms"),
        month.cast("string").alias("expiration_ms"), "channel", "use_case", "offer_type",
    )
    rows = offers.offers_links_in(t.offers, requests, RUN)
    return rows.withColumns({
        "SUB_ACCT_NO_SBB": F.col("SUB_ACCT_NO_SBB").cast("long"), "PAYMENT_DIF": F.col("PAYMENT_DIF").cast("double")
    })


@query(f"""
    SELECT o.o_custkey AS "SUB_ACCT_NO_SBB", 'to/' || l.o_orderkey AS "LINK",
           CAST(l.o_orderdate AS DATE) AS "LINK_GENERATED_DT", CAST(l.o_orderdate AS DATE) + 7 AS "LINK_EXPIRATION_DT",
           o.o_orderkey AS id_oferta_int, {STAMP_HOUR}
    FROM orders o JOIN orders l ON o.o_custkey = l.o_custkey
         AND CAST(o.o_orderdate AS DATE) = CAST(l.o_orderdate AS DATE)
    QUALIFY row_number() OVER (PARTITION BY o.o_custkey
        ORDER BY o.o_orderdate DESC, o.o_orderkey DESC, 'to/' || l.o_orderkey DESC) = 1""")
def offers_links_out(t: Tables) -> DataFrame:
    offered = t.orders.selectExpr(
        "o_custkey as SUB_ACCT_NO_SBB", "o_orderkey as id_oferta_int", "date_format(o_orderdate, 'yyyyMMdd') as day",
        "date_format(o_orderdate, 'yyyyMMddHHmmss') as day_hour",
    )
    links = t.orders.selectExpr(
        "cast(o_custkey as string) as SUB_ACCT_NO", "concat('to/', o_orderkey) as LINK",
        "date_format(o_orderdate, 'M/d/yyyy h:mm:ss a') as CREATED_DATETIME",
        "date_format(o_orderdate + interval 7 day, 'yyyy-MM-dd') as LINK_EXPIRATION_DT",
    )
    return offers.offers_links_out(offered, offers.typed_links(links), RUN)


@query("""
    SELECT CAST(o.account AS VARCHAR) AS "SUB_ACCT_NO", 'P' || (o.id_oferta_int % 7) AS "PKG_CDE",
           o.use_case AS "HSD_SERVICE", o.o_totalprice AS "BUNDLECHARGE_CSG", o.regime AS "REGIME",
           format('{:,.2f}', o.o_totalprice) AS "REWARD"
    FROM offers o JOIN customer c ON o.account = c.c_custkey
         AND o.offer_type = CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'single' ELSE 'multi' END""", "offers")
def offers_rpp(t: Tables) -> DataFrame:
    requests = t.customer.selectExpr(
        "cast(c_custkey as string) as account", "if(c_mktsegment = 'BUILDING', 'single', 'multi') as offer_type"
    )
    rows = offers.packages_handoff(offers.offers_packages(t.offers, requests, RUN), digits=2)
    return rows.select("SUB_ACCT_NO", "PKG_CDE", "HSD_SERVICE", "BUNDLECHARGE_CSG", "REGIME", "REWARD")


@query("""
    SELECT o_custkey AS "SUB_ACCT_NO", o_orderpriority AS "OLD_SPEED", CAST(NULL AS BIGINT) AS "FROM_CSG_CODE",
           o_orderstatus AS "TO_CSG_CODE", 'fast' AS "NEW_SPEED", CAST(o_orderkey % 50 AS BIGINT) AS "PAYMENT_DIF",
           CAST(NULL AS BIGINT) AS "DISCOUNT", 's' AS "SUBLINE_1", 'c' AS "CALL_TO_ACTION", 'j' AS "SUBJECT_CODE",
           CAST(o_orderkey AS BIGINT) AS "TEMPLATE_TYPE", 't' AS "TIME_FRAME", o_orderstatus AS "REGIME",
           strftime(o_orderdate, '%Y-%m-%d') AS "DATE", 'N' AS "STB" FROM orders""")
def offer_file_typing(t: Tables) -> DataFrame:
    raw = t.orders.selectExpr(
        "cast(o_custkey as string) as SUB_ACCT_NO", "o_orderpriority as OLD_SPEED", "o_orderstatus as TO_CSG_CODE",
        "concat('x', o_orderkey) as FROM_CSG_CODE", "'fast' as NEW_SPEED",
        "cast(o_orderkey % 50 as string) as PAYMENT_DIF", "'12.7' as DISCOUNT", "'s' as SUBLINE_1",
        "'c' as CALL_TO_ACTION", "'j' as SUBJECT_CODE", "cast(o_orderkey as string) as TEMPLATE_TYPE",
        "'t' as TIME_FRAME", "o_orderstatus as REGIME", "date_format(o_orderdate, 'yyyy-MM-dd') as DATE", "'N' as STB",
    )
    return offers.offer_file_typing(raw)


# --- the rest --------------------------------------------------------------------------------------------

@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL AND o_orderstatus <> 'F'")
def snapshot_view(t: Tables) -> DataFrame:
    priced = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("o_totalprice")
    t.orders.select("o_orderkey", "o_orderstatus", priced).createOrReplaceTempView("current_offers_view")
    return S.scan(t.spark, "current_offers_view").where(F.col("o_totalprice").isNotNull())


@query("SELECT count(*) AS rows, count(o_totalprice) AS priced FROM orders")
def row_count(t: Tables) -> DataFrame:
    return t.orders.agg(F.count(F.lit(1)).alias("rows"), F.count("o_totalprice").alias("priced"))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 3")
def limit_preview(t: Tables) -> DataFrame:
    return t.orders.orderBy("o_orderkey").limit(3)


# --- delivered files -------------------------------------------------------------------------------------

def delivered(t: Tables):
    """Orders as a partner delivers them: three headers, torn rows, and totals that are no numbers."""
    key, cust, total = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.floor("o_totalprice").cast("string")
    total = F.when(F.col("o_orderkey") % 89 == 0, F.lit("n/a")).otherwise(total)
    lines = {
        "o_orderkey,o_custkey,o_totalprice": F.concat_ws(",", key, cust, total),
        "O_TOTALPRICE,remark,O_ORDERKEY,O_CUSTKEY": F.concat_ws(",", total, F.lit("r"), key, cust),
        "o_custkey,o_orderkey": F.concat_ws(",", cust, key),
    }
    folders = []
    for i, (header, line) in enumerate(lines.items()):
        torn = F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("torn"), key)).otherwise(line)
        folders.append(new_path(t.spark))
        rows = t.orders.where(F.col("o_orderkey") % 3 == i).select(torn.alias(header))
        rows.write.option("header", True).option("sep", "\t").option("quote", "").option("ignoreTrailingWhiteSpace", False).csv(folders[-1])
    return read_delivery(t.spark, folders, "o_orderkey int, o_custkey int, o_totalprice long")


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(floor(o_totalprice) AS BIGINT) END AS o_totalprice
          FROM orders WHERE o_orderkey % 97 <> 0 AND (o_orderkey % 3 = 2 OR o_orderkey % 89 <> 0)""")
def delivered_rows_by_header(t: Tables) -> DataFrame:
    return delivered(t).rows.drop("file_name")


@query("""SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'torn' ELSE 'type: o_totalprice' END AS reason,
                 CASE WHEN o_orderkey % 97 = 0 THEN 'torn' || o_orderkey
                      WHEN o_orderkey % 3 = 0 THEN o_orderkey || ',' || o_custkey || ',n/a'
                      ELSE 'n/a,r,' || o_orderkey || ',' || o_custkey END AS record
          FROM orders WHERE o_orderkey % 97 = 0 OR (o_orderkey % 3 < 2 AND o_orderkey % 89 = 0)""")
def delivered_rows_refused(t: Tables) -> DataFrame:
    return delivered(t).refused.drop("file_name")
