"""The queries with joins, with nearly every key treated as hot, still equal their SQL."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tests.conftest import SMALL
from touchline.operators import joins

JOINED = ("status_combined first_bounce left_lookup_on_literal left_lookup_dedup existence_semi "
          "latest_offers_with_ties semi_join_campaigns feed_opens compose_simple compose_full attribute_conversions "
          "offers_links_in offers_rpp").split()


@pytest.mark.parametrize("name", JOINED)
def test_split_joins_equal_sql(spark, monkeypatch, name):
    calls = []

    def eager(df, keys, share=None, min_rows=None):
        found = found_by(df, keys, 1 / 500, 2)
        calls.append(len(found))
        return found

    found_by = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", eager)
    monkeypatch.setattr("touchline.operators.compose.hot_keys", eager)
    monkeypatch.setattr(joins, "small", lambda df: df)
    assert difference(contract.queries()[name](spark, SMALL), connect(SMALL), contract.oracle_sql()[name]) is None
    assert sum(calls) > 0
