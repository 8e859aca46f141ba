"""Queries that once read a part of their tables: all rows of the tables take part, and the operator still decides."""

import datetime as dt

import pytest

import __spark_entry__ as contract
from tests.conftest import rows_of

CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
NOON = dt.datetime(2024, 1, 10, 12)


@pytest.fixture
def result(spark, frame, tmp_path):
    """result(query, table=(schema, rows), …): the query's rows over these tables."""
    def run(query, **tables):
        for name, (schema, rows) in tables.items():
            frame(schema, *rows).write.parquet(f"{tmp_path}/{name}.parquet")
        return rows_of(contract.queries()[query](spark, str(tmp_path)))
    return run


def customers(*names):
    return CUSTOMER, [(i, name, 1, 10.0 * i, "A") for i, name in enumerate(names, 1)]


def test_paged_contacts_of_all_customers(result):
    found = result("paged_contacts_distinct", customer=customers("Customer#000000001", "Customer#000099999", "Supplier#000000001"))
    assert found == [("A", "Customer#000000001"), ("A", "Customer#000099999")]


MESSAGES = EVENTS, [(1, NOON, 1, "signup", 1.0, '{"k": 5}'), (2, NOON, 5, "signup", 1.0, '{"k": 5}'),
                    (3, NOON, 9, "signup", 1.0, '{"k": 5}'), (4, NOON, 5, "signup", 200.0, '{"k": 5}')]


def test_lookup_finds_every_contact_there_is(result):
    found = result("left_lookup_dedup", customer=customers(*"abcde"), events=MESSAGES)
    assert found == [(1, 1, "ACC_1", "1"), (2, 5, "ACC_5", "5"), (3, 9, None, None), (4, 5, "ACC_5", "5")]


def test_lookup_on_a_literal_finds_every_contact_there_is(result):
    found = result("left_lookup_on_literal", customer=customers(*"abcde"), events=MESSAGES)
    assert found == [(1, "email", "ACC_1"), (2, "email", "ACC_5"), (3, "email", None), (4, "Outbound_call", None)]


def test_answers_to_any_message_exist(result):
    sent = [(1, NOON, 7, "signup", 1.0, '{"k": 5}'), (2, NOON, 7, "signup", 1.0, '{"k": 45}')]  # the second has bounced
    views = [(11, NOON, 7, "view", 1.0, '{"k": 1}'), (12, NOON, 7, "view", 1.0, '{"k": 1}'), (13, NOON, 8, "view", 1.0, '{"k": 1}')]
    assert result("existence_semi", events=(EVENTS, sent + views)) == [(11, "view"), (12, "view")]


def test_winback_list_is_all_customers(result):
    recent, past = dt.datetime(2000, 7, 1), dt.datetime(1999, 7, 1)
    orders = [(1, 8, "O", 1.0, recent, "P"), (2, 9, "O", 1.0, past, "P"), (3, 1, "O", 1.0, recent, "P")]
    found = result("base_audience_with_winback", customer=customers("a", "b"), orders=(ORDERS, orders))
    assert found == [(f"ACC_{i}", "XX", "FIXED") for i in (1, 2, 8)]


def test_contact_ids_of_all_customers(result):
    found = result("contact_ids", customer=customers("Customer#000000001", "Customer#000099999", "Supplier#000000001"))
    assert [r[:2] for r in found] == [(1, "Customer#000000001"), (2, "Customer#000099999")]
