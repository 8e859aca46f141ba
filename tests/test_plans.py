"""Physical plans: what reaches the scan, and what must not be in a plan that is to run on a cluster."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.conftest import SMALL
from touchline.functions import dates as D
from touchline.operators import status
from touchline.operators.mirror import mirror
from touchline.plans.queries import ORDER_MIRROR
from touchline.plans.registry import QUERIES
from touchline.plans.views import Tables
from touchline.sources import tables as S


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_no_cross_join_no_one_task_window(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    assert "Window" not in text
    if name not in ("row_count", "limit_preview"):
        assert "SinglePartition" not in text


def test_partition_predicates_prune(spark, frame, root):
    rows = frame("id int, day string", (1, "20240101"), (2, "20240102"), (3, "20240103"))
    rows.write.partitionBy("day").parquet(root)
    table = spark.read.parquet(root)
    for df in (S.slice_eq(table, day="20240102"), S.slice_from(table, "day", "20240102", inclusive=False),
               S.slice_between(table, "day", "20240101", "20240102")):
        assert "PartitionFilters: [isnotnull(day" in plan(df)
        assert len(df.inputFiles()) == 3 and df.count() < 3


def test_day_predicate_reaches_the_scan(spark):
    events = Tables(spark, SMALL).events
    for df in (events.where(D.on_day(F.col("ts"), dt.date(2024, 1, 5))),
               events.where(D.trailing_days(F.col("ts"), dt.date(2024, 1, 5), 14))):
        assert "GreaterThanOrEqual(ts" in plan(df) and "LessThan" in plan(df)


def test_scan_reads_only_what_is_asked(spark):
    text = plan(contract.queries()["latest_offers_with_ties"](spark, SMALL))
    assert "o_totalprice" not in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate" in text


def test_status_shuffles_each_side_once(spark):
    t = Tables(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(status.apply_status(t.history, t.answers("view"), t.answers("click"), t.answers("error")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    body = text.split("\n\n")[0]
    # history, opens with clicks, bounces; only the bounces carry text and need a sorted aggregate
    assert body.count("Exchange") == 3 and body.count("HashAggregate") == 2 and body.count("SortAggregate") == 2


def test_attribution_shuffles_the_history_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        body = plan(contract.queries()["attribute_conversions"](spark, SMALL)).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # history, best weight per account, conversions (aggregated from orders, then by account)
    assert body.count("Exchange") == 4


def test_mirror_dedups_before_the_shuffle(spark):
    text = plan(mirror(Tables(spark, SMALL).orders.withColumn("dt", F.lit("2024-01-01")), ORDER_MIRROR, "ACC_"))
    assert text.split("\n\n")[0].count("HashAggregate") == 2
