"""Every registered query against its SQL, on whole tables of the smallest set."""

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as contract
from touchline.operators import feeds
from touchline.plans.registry import ORACLES, QUERIES
from touchline.plans.views import RUN_DAY, Tables
from tests.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert difference(df, duck, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql_and_is_listed():
    assert set(QUERIES) == set(ORACLES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("drop", ["event_time", "contact_id", "campaign"])
def test_each_filter_of_a_feed_drops_rows(spark, drop):
    """Without any one of its filters a feed would hold more rows, so none of them is idle on the driver's tables."""
    t = Tables(spark, SMALL)
    ids = feeds.program_campaigns(t.campaigns, feeds.tagged_programs(t.programs, "#1"))
    rows = t.feed
    kept = feeds.event_feed("opens", rows, RUN_DAY, campaign_ids=ids).count()
    if drop == "event_time":
        rows = rows.withColumn("event_time", F.lit(RUN_DAY).cast("timestamp_ntz"))
    elif drop == "contact_id":
        rows = rows.withColumn("contact_id", F.lit(1))
    assert 0 < kept < feeds.event_feed("opens", rows, RUN_DAY, campaign_ids=None if drop == "campaign" else ids).count()


def test_lookups_and_filters_are_not_idle(spark):
    """Each of these queries would give other rows without its operator."""
    t, rows = Tables(spark, SMALL), lambda name: QUERIES[name](spark, SMALL)
    assert 0 < rows("snapshot_view").count() < t.orders.count()
