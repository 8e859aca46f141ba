import pathlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from touchline.operators.attribution import credited_again, typed_conversions
from touchline.plans import jobs
from touchline.schemas import CONVERSIONS, HISTORY
from touchline.functions.columns import conform


@pytest.fixture
def table(spark, root):
    """Twenty days of two channels, forty partitions; account n is reached on day n by one channel or by both."""
    rows = spark.range(400).selectExpr(
        "concat('A', id % 20) AS account_id", "concat('offer u', id) AS campaign_name", "id AS contact_id",
        "timestamp'2024-01-01 12:00:00' + make_dt_interval(cast(id % 20 AS int)) AS contact_dt",
        "'202401' AS month", "concat('202401', lpad(id % 20 + 1, 2, '0')) AS day", "if(id % 40 < 20, 'email', 'Outbound call') AS channel")
    t = jobs.history_table(spark, root)
    jobs.store_history(t, conform(rows, HISTORY))
    return t


def arrived(frame, *rows):
    return typed_conversions(frame(CONVERSIONS, *[(a, use, order, "1705795200000", "web") for a, use, order in rows]))  # 21 January


def test_two_of_forty_partitions_are_written(frame, table, root):
    before = table.partitions()
    conversions = arrived(frame, ("A7", "u7", "o1"))
    whole = rows_of(credited_again(table.read("rows"), conversions).where("conv_flg"))
    assert len(before) == 40
    assert jobs.attribute_changed(table, conversions) == [("202401", "20240108", "Outbound call"), ("202401", "20240108", "email")]
    after = table.partitions()
    assert sum(after[key] != before[key] for key in after) == 2 and set(after) == set(before)
    written = {p.parent.name for p in pathlib.Path(root).rglob(f"{after[('202401', '20240108', 'email')]}/rows/**/*.parquet")}
    assert written == {"channel=email", "channel=Outbound call"}
    assert rows_of(table.read("rows").where("conv_flg")) == whole and whole


def test_run_after_run_equals_runs_over_the_whole_history(spark, frame, table):
    """Rows that a run paired and did not credit are stripped by the next, wherever they are."""
    whole = table.read("rows")
    for conversions in (arrived(frame, ("A7", "u7", "o1"), ("A3", "none", "o2")), arrived(frame, ("A7", "u27", "o3")), arrived(frame, ("A19", "u", "o4"), ("B", "u", "o5"))):
        whole = credited_again(whole, conversions)
        jobs.attribute_changed(table, conversions)
        concerned = lambda df: df.withColumn("conv_flg", F.coalesce("conv_flg", F.lit(False)))
        assert rows_of(concerned(table.read("rows"))) == rows_of(concerned(whole))


def test_nothing_to_do_writes_nothing(frame, table):
    last = table.last()
    assert jobs.attribute_changed(table, arrived(frame, ("nobody", "u", "o"), (None, "u", "o"))) == []
    assert table.last() == last


def test_wide_rows_are_read_from_touched_partitions_only(frame, table):
    rows = table.read("rows", [("202401", "20240108", "email")])
    assert rows.count() == 10 and len(rows.inputFiles()) == len({f for f in rows.inputFiles() if "20240108" in f and "email" in f})
