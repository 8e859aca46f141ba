"""Guards that count what a write sees: the input of a sink is computed once, whatever is decided by it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from touchline.plans import jobs
from touchline.sinks import partitions as sink

T = "id int, month string, day string"


@pytest.fixture
def counting(spark):
    """counting(df) -> the same rows, and an accumulator of how many have been computed."""
    def watch(df):
        computed = spark.sparkContext.accumulator(0)

        def passed(batches):
            for batch in batches:
                computed.add(len(batch))
                yield batch
        return df.mapInPandas(passed, df.schema), computed
    return watch


def days(spark, n, month="202401"):
    return spark.range(n).select(F.col("id").cast("int"), F.lit(month).alias("month"), F.concat(F.lit(month), F.lpad(F.col("id") % 5 + 1, 2, "0")).alias("day"))


@pytest.mark.parametrize("write", [
    lambda df, root: sink.replace_where(df, root, ["month", "day"], F.col("month") == "202401"),
    lambda df, root: sink.replace_slice(df, root, "month", "202401"),
    lambda df, root: sink.publish(df, root, ["month", "day"]),
    lambda df, root: sink.write_if_rows(df, lambda rows: sink.write_partitions(rows, root, ["month"])),
    lambda df, root: sink.append_batch(df, root, ["month"], "one"),
])
def test_input_is_computed_once(spark, counting, root, write):
    df, computed = counting(days(spark, 100))
    write(df, root)
    assert computed.value == 100 and spark.read.parquet(root).count() == 100


def test_strays_are_refused_before_anything_is_written(spark, counting, root):
    sink.write_partitions(days(spark, 10), root, ["month", "day"])
    before = rows_of(spark.read.schema(T).parquet(root))
    strays = days(spark, 100).unionByName(days(spark, 1, "202402"))
    for write in (lambda df: sink.replace_where(df, root, ["month", "day"], F.col("month") == "202401"),
                  lambda df: sink.replace_slice(df, root, "month", "202401")):
        df, computed = counting(strays)
        with pytest.raises(ValueError, match="outside"):
            write(df)
        assert computed.value == 101 and rows_of(spark.read.schema(T).parquet(root)) == before
    nulls = days(spark, 3).withColumn("month", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="outside"):
        sink.replace_where(nulls, root, ["month", "day"], F.col("month") == "202401")


@pytest.mark.parametrize("empty", [lambda s: s.createDataFrame([], T), lambda s: days(s, 9).where("id < 0"), lambda s: days(s, 0)])
def test_no_rows_however_they_come_about(spark, root, empty):
    """The optimizer sees through some of these and leaves no plan to count by."""
    sink.write_partitions(days(spark, 10), root, ["month", "day"])
    assert not sink.write_if_rows(empty(spark), lambda rows: pytest.fail("written"))
    sink.publish(empty(spark), root, ["month", "day"])
    assert spark.read.parquet(root).count() == 10
    sink.replace_where(empty(spark), root, ["month", "day"], F.col("month") == "202401")
    assert spark.read.schema(T).parquet(root).count() == 0


def test_call_audience_reads_its_file_once(spark, frame, counting, tmp_path, monkeypatch):
    columns = ["account_id", "name", "file_name"]
    df, computed = counting(spark.createDataFrame([(f"A{i}", "x", "calls_20240101.csv") for i in range(30)], columns))
    monkeypatch.setattr(jobs, "read_export", lambda *a, **k: df)
    monkeypatch.setattr(jobs.audience, "call_audience", lambda rows, run: rows.withColumns(
        {"month": F.lit("202401"), "day": F.lit("20240101"), "day_hour": F.lit("20240101000000"), "channel": F.lit("c"), "campaign_name": F.lit("n")}))
    jobs.load_call_audience(spark, "calls.csv", f"{tmp_path}/t", f"{tmp_path}/out", dt.datetime(2024, 1, 1))
    assert computed.value == 30 and spark.read.parquet(f"{tmp_path}/t").count() == 30
    df, computed = counting(spark.createDataFrame([], "account_id string, name string, file_name string"))
    with pytest.raises(ValueError, match="calls.csv is empty"):
        jobs.load_call_audience(spark, "calls.csv", f"{tmp_path}/none", f"{tmp_path}/out2", dt.datetime(2024, 1, 1))
    assert not (tmp_path / "none").exists()
