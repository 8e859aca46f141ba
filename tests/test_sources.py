import json

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import rows_of
from touchline.sources import files, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "offers_20230817_a.csv").write_text("ID,Name\n1,x\n2,\n")
    (tmp_path / "offers_20230817_b.csv").write_text("ID,Name\n3,z\n")
    (tmp_path / "offers_20230818.csv").write_text("ID,Name\n4,w\n")
    (tmp_path / "notes_20230817.txt").write_text("ID,Name\n5,v\n")
    return str(tmp_path)


def test_csv_is_text_and_chosen_by_name(spark, folder):
    df = files.read_csv(spark, folder, name_glob="*20230817*.csv", with_name=True)
    assert df.dtypes == [("ID", "string"), ("Name", "string"), ("file_name", "string")]
    assert rows_of(df) == [("1", "x", "offers_20230817_a.csv"), ("2", None, "offers_20230817_a.csv"),
                           ("3", "z", "offers_20230817_b.csv")]


def test_export_is_typed_with_clean_names(spark, tmp_path):
    (tmp_path / "e.csv").write_text("user id;Name (full);amount\n1;x;2.5\n")
    df = files.read_export(spark, str(tmp_path / "e.csv"))
    assert df.dtypes == [("user_id", "int"), ("Name__full_", "string"), ("amount", "double")]


def test_pages_are_one_frame(spark, tmp_path):
    for page in range(3):
        (tmp_path / f"p{page}.json").write_text("\n".join(
            json.dumps({"id": str(page), "864": f"ACC_{n}"}) for n in range(2)))
    assert files.read_pages(spark, str(tmp_path), "id string, `864` string").count() == 6


def test_optional_takes_only_a_missing_path(spark, tmp_path):
    missing = tables.optional(lambda: files.read_csv(spark, f"{tmp_path}/none.csv"), "k string", spark)
    assert missing.columns == ["k"] and missing.count() == 0
    with pytest.raises(AnalysisException):
        tables.optional(lambda: spark.sql("select nothing"), "k string", spark)


def test_file_or_slice(spark, folder, tmp_path):
    assert tables.file_or_slice(spark, path=folder, read=files.read_csv).count() > 0
    stored = f"{tmp_path}/stored/t"
    spark.createDataFrame([(1, "202401", "20240105", "10"), (2, "202401", "20240106", "10")],
                          "id int, month string, day string, hour string").write.parquet(stored)
    keys = {"month": "202401", "day": "20240105", "hour": "10"}
    assert rows_of(tables.file_or_slice(spark, table=stored, keys=keys), "id") == [(1,)]
    with pytest.raises(ValueError):
        tables.file_or_slice(spark)


def test_partition_keys_stay_text(spark, root):
    spark.sql("select 1 id, '202309' month").write.partitionBy("month").parquet(root)
    assert dict(spark.read.parquet(root).dtypes)["month"] == "string"
