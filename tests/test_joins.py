"""The split join gives what the plain join gives, for any distribution of keys."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from touchline.operators import joins
from touchline.operators.joins import hot_keys, key_hash, small, spread_join

SPLIT = {"share": 1 / 30, "min_rows": 5}


def skewed(rng, n, keys):
    third = n // 3
    return [None] * third + [7] * third + [rng.choice(keys) for _ in range(n - 2 * third)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("gated", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_join(frame, how, gated, seed):
    rng = random.Random(seed)
    left = frame("id int, k int, m int", *[(i, k, i % 3) for i, k in enumerate(skewed(rng, 200, range(40)))])
    right = frame("k int, v int", *[(k, i) for i, k in enumerate(skewed(rng, 90, range(5, 60)))])
    gate = F.when(F.col("id") % 11 != 0, F.col("m") == 1) if gated else None
    plain = spread_join(left, right, ["k"], how, only_when=gate, hot={}, hot_right={})
    split = spread_join(left, right, ["k"], how, only_when=gate, right_repeats=True, **SPLIT)
    assert split.columns == plain.columns
    assert rows_of(split) == rows_of(plain)


def test_keys_said_to_be_hot_need_not_be_there(frame):
    left = frame("a int, b int, id int", *[(i % 5, i % 3, i) for i in range(40)], (None, 1, 99))
    right = frame("a int, b int, v int", *[(1, 0, i) for i in range(20)], (2, 1, 77))
    plain = rows_of(left.join(right, ["a", "b"], "left").select("a", "b", "id", "v"))
    keys = [r[0] for r in left.select(key_hash(left, ["a"])).distinct().collect()]
    said = {key: 0.2 for key in keys}
    for hot in ({}, said):
        got = spread_join(left, right, ["a", "b"], by=["a"], hot=hot, hot_right=said, right_repeats=True)
        assert rows_of(got) == plain


def test_several_right_sides(frame):
    rng = random.Random(3)
    left = frame("id int, k int", *enumerate(skewed(rng, 150, range(40))))
    one = frame("k int, v int", *[(k, -k) for k in range(30)])
    many = frame("k int, w int", *[(k, i) for i, k in enumerate(skewed(rng, 60, range(5, 60)))])
    plain = left.join(one, ["k"], "left").join(many, ["k"], "left").select("id", "k", "v", "w")
    for options in (SPLIT, {"hot": {}, "hot_right": {}}):
        assert rows_of(spread_join(left, [one, many], ["k"], right_repeats=True, **options)) == rows_of(plain)


def test_composite_key_found_by_one_part(frame):
    left = frame("a int, b int, id int", *[(1, i % 2, i) for i in range(60)], *[(i, 0, i) for i in range(60, 90)])
    right = frame("a int, b int, v string", (1, 0, "x"), (1, 1, "y"), (1, None, "n"), (70, 0, "z"))
    split = spread_join(left, right, ["a", "b"], by=["a"], **SPLIT)
    assert rows_of(split) == rows_of(left.join(right, ["a", "b"], "left").select("a", "b", "id", "v"))
    assert "explode" in split._jdf.queryExecution().toString().lower()


def test_hot_keys_are_few_and_bounded(frame):
    df = frame("k int", *[(1,)] * 50, *[(None,)] * 30, *[(i,) for i in range(2, 22)])
    assert sorted(hot_keys(df, ["k"], share=0.1, min_rows=1).values()) == [0.3, 0.5]
    assert hot_keys(df, ["k"], share=0.1, min_rows=40) == {df.select(key_hash(df, ["k"])).first()[0]: 0.5}
    assert 0 in hot_keys(df, ["k"], share=0.1, min_rows=1)
    assert hot_keys(df.where("k > 100"), ["k"]) == {}


def test_a_key_that_fills_three_partitions_is_split(spark):
    """With the settings of production: no share, no row bound and no monkeypatch."""
    fixed = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in fixed}
    for k, v in fixed.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 6_000_000, 1, 4).selectExpr("if(id < 1200000, 7, id) as k", "id")
        right = spark.range(0, 100, 1, 2).selectExpr("id as k", "id as v").groupBy("k").agg(F.max("v").alias("v"))
        assert set(hot_keys(left, ["k"])) == {spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]}
        joined = spread_join(left, right, ["k"], "left")
        assert "_left" in joined._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        per_task = [n for (n,) in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(per_task) == 6_000_000 and max(per_task) < 3 * sum(per_task) / 16
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_whole_numbers_of_any_width_are_one_key(frame):
    left, right = frame("k int, id int", *[(7, i) for i in range(50)], (8, 99)), frame("k long, v int", (7, 1), (8, 2))
    assert rows_of(spread_join(left, right, ["k"], **SPLIT), "id", "v") == sorted([(i, 1) for i in range(50)] + [(99, 2)], key=repr)
    with pytest.raises(TypeError, match="key k"):
        spread_join(left, frame("k string", ("7",)), ["k"])


def test_same_salts_when_run_again(frame):
    left = frame("id int, k int", *[(i, 7) for i in range(100)])
    right = frame("k int, v int", (7, 1))
    split = spread_join(left, right, ["k"], **SPLIT)
    assert rows_of(split) == rows_of(split.repartition(3))


def test_unknown_join_refused(frame):
    df = frame("k int", (1,))
    with pytest.raises(ValueError):
        spread_join(df, df, ["k"], "right")


def test_lookup_in_a_short_and_a_long_list(frame, monkeypatch):
    left = frame("id int, k int", *enumerate(skewed(random.Random(5), 120, range(40))))
    right = frame("k int, v int", *[(k, -k) for k in range(30)])
    short = joins.lookup_join(left, right, ["k"])
    monkeypatch.setattr(joins, "small", lambda df: df)
    long = joins.lookup_join(left, right, ["k"], probe=left.select("k"))
    assert rows_of(short) == rows_of(long) == rows_of(left.join(right, ["k"], "left").select("id", "k", "v"))
    assert "BroadcastHashJoin" in short._jdf.queryExecution().executedPlan().toString()


def test_small_checks_the_bytes(frame):
    df = frame("s string", ("x" * 100,), ("y" * 100,))
    assert small(df, 2, 1000) is not df and small(df, 2, 100) is df


def test_small_checks_the_size(frame):
    df = frame("k int", (1,), (2,), (3,))
    assert small(df, 2) is df
    assert "broadcast" in small(df, 3)._jdf.queryExecution().toString().lower()


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_that_fail_the_predicate_stay_spread(spark, frame):
    left, right = spark.range(4_000).selectExpr("id", "id % 500 as k"), frame("k long, v int", (1, 1), (2, 2))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = spread_join(left, right, ["k"], only_when=F.col("id") % 10 == 1)
        assert max(rows_by_task(found)) < 1_500 and found.count() == 4_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_grow_with_the_rows(spark, frame):
    left, right = spark.range(4_000).selectExpr("id", "id % 500 as k"), frame("k long, v int", (1, 1), (2, 2))
    found = spread_join(left, right, ["k"], min_rows=1_000, task_rows=100)
    assert len(rows_by_task(found)) > 20 and max(rows_by_task(found)) < 400
    assert rows_of(found) == rows_of(left.join(right, ["k"], "left").select("id", "k", "v"))
