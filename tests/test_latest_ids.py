import random

import pytest

from tests.conftest import rows_of
from touchline.operators.ids import dense_ids, last_id
from touchline.operators.latest import first_per_key, latest_per_key, latest_with_ties


def test_one_row_per_key_and_ties(frame):
    df = frame("k string, t int, id int", ("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), (None, 5, 5))
    assert rows_of(latest_per_key(df, ["k"], ["t", "id"])) == [("a", 2, 3), ("b", None, 4), (None, 5, 5)]
    assert rows_of(first_per_key(df, ["k"], ["t", "id"])) == [("a", 1, 1), ("b", None, 4), (None, 5, 5)]
    # a missing key or order is equal to nothing
    assert rows_of(latest_with_ties(df, ["k"], "t")) == [("a", 2, 2), ("a", 2, 3)]


@pytest.mark.parametrize("seed", range(3))
def test_ids_are_dense_and_ordered(frame, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]), rng.randrange(5)) for _ in range(rng.randrange(1, 300))]
    df = frame("acct string, v int", *rows).repartition(5)
    got = [tuple(r) for r in dense_ids(df, ["acct"], "id", start=41).orderBy("id").collect()]
    assert [r[2] for r in got] == list(range(42, 42 + len(rows)))
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    assert [key(r) for r in got] == sorted(map(key, rows))


def test_copies_spread_over_partitions(spark):
    df = spark.range(20000).selectExpr("'same' as acct").repartition(8)
    assert dense_ids(df, ["acct"], "id").selectExpr("min(id)", "max(id)", "count(distinct id)").first()[:] == (
        1, 20000, 20000)


def test_last_id(frame):
    assert last_id(frame("id int"), "id") == 0
    assert last_id(frame("id int", (3,), (9,), (None,)), "id") == 9


def test_no_rows(frame):
    assert dense_ids(frame("acct string"), ["acct"], "id").count() == 0
