"""Domain views over the driver tables: events as messages, orders as offers and history, parts as campaigns.

Each view has its SQL counterpart in ``VIEWS_SQL``, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DAY = dt.date(1999, 6, 30)  # the day the whole events table is taken to be the load of


class Tables:
    """The driver tables of one folder, and the views."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def ev(self) -> DataFrame:
        """Events with the number in ``props`` as ``k``; ``load_time`` moves each to the run day."""
        return self.events.selectExpr(
            "event_id", "user_id as contact_id", "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k",
            "event_type", "value", "ts as event_time",
            f"timestamp_ntz'{RUN_DAY}' + (ts - cast(to_date(ts) as timestamp_ntz)) as load_time",
        )

    @cached_property
    def feed(self) -> DataFrame:
        """Events with every column a feed asks for; campaign ids are text. A tenth are of the day before the run day, and
        a tenth have no contact."""
        return self.ev.withColumn("load_time", F.expr("if(k % 10 = 3, load_time - interval 1 day, load_time)")).selectExpr(
            "if(k % 10 = 7, null, contact_id) as contact_id", "event_id as launch_id", "event_type as campaign_type", "cast(k as string) as campaign_id",
            "load_time as event_time", "date_sub(to_date(load_time), k % 20) as email_sent_at",
            "concat('mail', k) as domain", "k as message_id", "contact_id as customer_id",
            "concat('reason ', k) as reason", "concat('reason ', k) as dsn_reason",
            "if(value > 50, 'hard', 'soft') as bounce_type", "concat('link', k) as link_id", "event_type",
        )

    @cached_property
    def history(self) -> DataFrame:
        """Sent messages as history rows; some already have a status, some are of the call channel."""
        return self.ev.where("event_type = 'signup'").selectExpr(
            "event_id as comm_id", "contact_id", "event_id % 2 as campaign_id", "to_date(event_time) as comm_dt",
            "event_time as sent_dt", "if(value > 100, 'Outbound_call', 'email') as channel",
            "if(k < 20, event_time, null) as open_dt", "if(k < 10, event_time, null) as contact_dt",
            "if(k > 90, event_time, null) as click_dt", "if(k > 90, 3, null) as clicks_count",
            "if(k between 40 and 50, event_time, null) as bounce_dt",
            "if(k between 40 and 50, 'soft', null) as bounce_type",
            "if(k between 40 and 50, 'earlier', null) as dsn_reason",
        )

    def answers(self, event_type: str) -> DataFrame:
        """Events of one type as answers to messages sent up to 19 days before."""
        return self.ev.where(f"event_type = '{event_type}'").selectExpr(
            "event_id", "contact_id", "cast(event_id % 2 as string) as campaign_id", "event_time",
            "date_sub(to_date(event_time), k % 20) as email_sent_at",
            "if(value > 50, 'hard', 'soft') as bounce_type", "concat('code ', k) as dsn_reason",
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        """Campaign versions: a hundred ids, the brand number as program; ids from 50 on are all of program 55."""
        return self.part.selectExpr(
            "p_partkey % 100 as id", "p_name as name",
            "if(p_partkey % 100 < 50, cast(substring(p_brand, 7, 4) as long), 55L) as program_id",
            "timestamp_ntz'1999-01-01' + make_dt_interval(p_size) as event_time", "p_partkey", "p_type as type",
            "cast(p_partkey as string) as version_name",
        )

    @cached_property
    def programs(self) -> DataFrame:
        return self.part.selectExpr("substring(p_brand, 7, 4) as id", "p_brand as name").distinct()

    @cached_property
    def contacts(self) -> DataFrame:
        """Contact to account, every row twice."""
        ids = self.customer.selectExpr("c_custkey as user_id", "concat('ACC_', c_custkey) as account_id")
        return ids.unionAll(ids)

    @cached_property
    def offers(self) -> DataFrame:
        return self.orders.selectExpr(
            "cast(o_custkey as string) as sub_acct_no", "o_orderpriority as use_case",
            "if(o_orderstatus = 'F', 'single', 'multi') as offer_type",
            "if(o_totalprice > 100000, 'email', 'sms') as channel", "date_format(o_orderdate, 'yyyy-MM-d') as date",
            "o_orderkey as id_oferta_int", "o_orderstatus as regime", "to_date(o_orderdate) as next_best_action_date",
            "concat('P', o_orderkey % 7) as pkg_cde", "o_orderpriority as hsd_service",
            "concat('R', o_orderkey % 5) as recommendedpkg", "o_orderstatus as tocsgcodefriendlyname",
            "cast(o_totalprice as string) as delta_arpu", "'online' as online_descr_pkg", "'short' as smt_descr_pkg",
            "o_totalprice as bundlecharge_csg", "cast(o_custkey % 10 as string) as discount",
            "cast(o_custkey % 3 as string) as rank", "o_orderstatus as pkg_type", "'Y' as stb",
            "o_totalprice / 4 as additional_charge", "o_totalprice as reward",
        )

    @cached_property
    def links(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "l_orderkey as id_oferta_int", "concat('to/', l_partkey, '/', l_linenumber) as link",
            "to_date(l_shipdate) as link_generated_dt", "date_add(to_date(l_shipdate), 7) as link_expiration_dt",
        )

    @cached_property
    def calls(self) -> DataFrame:
        """Call feedback: up to three attempts per order from the ship dates of its first three lines."""
        return self.lineitem.groupBy("l_orderkey").agg(
            *[F.max(F.when(F.col("l_linenumber") == n, F.to_date("l_shipdate"))).alias(f"Intento_discado_{n}")
              for n in (1, 2, 3)],
            F.max("l_returnflag").alias("Disposicion"),
        ).selectExpr(
            "concat('ACC_', l_orderkey) as account_id", "l_orderkey as cuenta", "Intento_discado_1",
            "Intento_discado_2", "Intento_discado_3", "Disposicion",
        )

    @cached_property
    def contact_history(self) -> DataFrame:
        """Orders as a history to attribute conversions over."""
        return self.orders.selectExpr(
            "o_orderkey as comm_id", "concat('ACC_', o_custkey) as account_id", "o_orderpriority as channel",
            "o_orderstatus as campaign_name", "o_orderdate as contact_dt",
            "case o_orderkey % 5 when 0 then true when 1 then false end as conv_flg",
            "if(o_orderkey % 5 = 0, 'kept', null) as conv_use_case_cat",
            "if(o_orderkey % 5 = 0, cast(o_orderkey as string), null) as order_id",
            "if(o_orderkey % 5 = 0, date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), null) as conversion_dt",
            "if(o_orderkey % 5 = 0, 'old', null) as conversion_type",
        )

    @cached_property
    def conversions(self) -> DataFrame:
        """A conversion per customer and status, five days after its last order; the time is text."""
        return self.orders.groupBy("o_custkey", "o_orderstatus").agg(
            F.max("o_orderdate").alias("last"), F.max("o_orderkey").alias("key")
        ).selectExpr(
            "concat('ACC_', o_custkey) as account_id", "o_orderstatus as conv_use_case_cat",
            "cast(key as string) as order_id", "cast((unix_timestamp(last) + 432000) * 1000 as string) as conv_dte",
            "'new' as conv_type",
        )


VIEWS_SQL = {
    "ev": f"""
        SELECT event_id, user_id AS contact_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, event_type,
               value, ts AS event_time, TIMESTAMP '{RUN_DAY}' + (ts - date_trunc('day', ts)) AS load_time
        FROM events""",
    "feed": """
        SELECT CASE WHEN k % 10 <> 7 THEN contact_id END AS contact_id, event_id AS launch_id, event_type AS campaign_type, CAST(k AS BIGINT) AS campaign_id,
               load_day AS event_time, CAST(load_day AS DATE) - (k % 20) AS email_sent_at, 'mail' || k AS domain,
               k AS message_id, contact_id AS customer_id, 'reason ' || k AS reason, 'reason ' || k AS dsn_reason,
               CASE WHEN value > 50 THEN 'hard' ELSE 'soft' END AS bounce_type, 'link' || k AS link_id, event_type
        FROM (SELECT *, CASE WHEN k % 10 = 3 THEN load_time - INTERVAL 1 DAY ELSE load_time END AS load_day FROM ev)""",
    "history": """
        SELECT event_id AS comm_id, contact_id, event_id % 2 AS campaign_id, CAST(event_time AS DATE) AS comm_dt,
               event_time AS sent_dt, CASE WHEN value > 100 THEN 'Outbound_call' ELSE 'email' END AS channel,
               CASE WHEN k < 20 THEN event_time END AS open_dt, CASE WHEN k < 10 THEN event_time END AS contact_dt,
               CASE WHEN k > 90 THEN event_time END AS click_dt, CASE WHEN k > 90 THEN 3 END AS clicks_count,
               CASE WHEN k BETWEEN 40 AND 50 THEN event_time END AS bounce_dt,
               CASE WHEN k BETWEEN 40 AND 50 THEN 'soft' END AS bounce_type,
               CASE WHEN k BETWEEN 40 AND 50 THEN 'earlier' END AS dsn_reason
        FROM ev WHERE event_type = 'signup'""",
    "answers": """
        SELECT event_id, event_type, contact_id, event_id % 2 AS campaign_id, event_time,
               CAST(event_time AS DATE) - (k % 20) AS email_sent_at,
               CASE WHEN value > 50 THEN 'hard' ELSE 'soft' END AS bounce_type, 'code ' || k AS dsn_reason
        FROM ev""",
    "campaigns": """
        SELECT p_partkey % 100 AS id, p_name AS name,
               CASE WHEN p_partkey % 100 < 50 THEN CAST(substring(p_brand, 7, 4) AS BIGINT) ELSE 55 END AS program_id,
               TIMESTAMP '1999-01-01' + to_days(p_size) AS event_time, p_partkey, p_type AS type,
               CAST(p_partkey AS VARCHAR) AS version_name
        FROM part""",
    "programs": "SELECT DISTINCT CAST(substring(p_brand, 7, 4) AS BIGINT) AS id, p_brand AS name FROM part",
    "contacts": "SELECT c_custkey AS user_id, 'ACC_' || c_custkey AS account_id FROM customer",
    "offers": """
        SELECT o_custkey AS account, o_orderpriority AS use_case,
               CASE WHEN o_orderstatus = 'F' THEN 'single' ELSE 'multi' END AS offer_type,
               CASE WHEN o_totalprice > 100000 THEN 'email' ELSE 'sms' END AS channel,
               CAST(o_orderdate AS DATE) AS day, o_orderkey AS id_oferta_int, o_orderstatus AS regime, o_totalprice
        FROM orders""",
    "links": """
        SELECT l_orderkey AS id_oferta_int, 'to/' || l_partkey || '/' || l_linenumber AS link,
               CAST(l_shipdate AS DATE) AS link_generated_dt, CAST(l_shipdate AS DATE) + 7 AS link_expiration_dt
        FROM lineitem""",
    "calls": """
        SELECT 'ACC_' || l_orderkey AS account_id, CAST(l_orderkey AS VARCHAR) AS sub_acct_no_sbb,
               max(CASE WHEN l_linenumber = 1 THEN CAST(l_shipdate AS DATE) END) AS a1,
               max(CASE WHEN l_linenumber = 2 THEN CAST(l_shipdate AS DATE) END) AS a2,
               max(CASE WHEN l_linenumber = 3 THEN CAST(l_shipdate AS DATE) END) AS a3,
               max(l_returnflag) AS disposition
        FROM lineitem GROUP BY l_orderkey""",
    "contact_history": """
        SELECT o_orderkey AS comm_id, 'ACC_' || o_custkey AS account_id, o_orderpriority AS channel,
               o_orderstatus AS campaign_name, o_orderdate AS contact_dt,
               CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false END AS conv_flg,
               CASE WHEN o_orderkey % 5 = 0 THEN 'kept' END AS conv_use_case_cat,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
               CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS conversion_dt,
               CASE WHEN o_orderkey % 5 = 0 THEN 'old' END AS conversion_type
        FROM orders""",
    "conversions": """
        SELECT 'ACC_' || o_custkey AS account_id, o_orderstatus AS conv_use_case_cat,
               CAST(max(o_orderkey) AS VARCHAR) AS order_id, max(o_orderdate) + INTERVAL 5 DAY AS conversion_ts
        FROM orders GROUP BY o_custkey, o_orderstatus""",
}
