import datetime as dt

import pytest

from tests.conftest import rows_of
from touchline.functions.dates import as_datetime
from touchline.plans import jobs
from touchline.sources.delivered import headers, read_delivery

DDL = "id int, x string, y double"


@pytest.fixture
def folder(tmp_path):
    put = lambda name, text: (tmp_path / name).write_text(text)
    put("a.csv", "id,x,y\n1,x1,1.5\n2,x2,2.5\n")
    put("b.csv", "y,id,x\n3.5,3,x3\n4.5,4,\n")
    put("c.csv", "ID,extra,X\n5,e,x5\n6,e\n7,e,x7,more\n")
    put("d.csv", "\ufeffid,x,y\r\n8,x8,n/a\r\nnine,x9,9\r\n")
    put("empty.csv", "")
    put("only.csv", "x,id\n")
    return str(tmp_path)


def test_columns_are_found_by_name_and_no_row_is_lost(spark, folder):
    got = read_delivery(spark, folder, DDL)
    assert got.rows.dtypes == [("id", "int"), ("x", "string"), ("y", "double"), ("file_name", "string")]
    assert rows_of(got.rows) == sorted([(1, "x1", 1.5, "a.csv"), (2, "x2", 2.5, "a.csv"), (3, "x3", 3.5, "b.csv"), (4, None, 4.5, "b.csv"),
                                        (5, "x5", None, "c.csv")], key=repr)
    assert rows_of(got.refused) == sorted([("c.csv", "torn", "6,e"), ("c.csv", "torn", "7,e,x7,more"), ("d.csv", "type: y", "8,x8,n/a"),
                                           ("d.csv", "type: id", "nine,x9,9")], key=repr)


def test_few_columns_of_the_rows_may_be_asked_for(spark, folder):
    """A scan for one column still tells torn rows by all their fields."""
    got = read_delivery(spark, folder, DDL)
    assert got.rows.count() == 5 and got.refused.count() == 4
    assert rows_of(got.rows, "y") == sorted([(1.5,), (2.5,), (3.5,), (4.5,), (None,)], key=repr)
    assert rows_of(got.refused.where("reason = 'torn'"), "file_name") == [("c.csv",), ("c.csv",)]


def test_required_columns(spark, folder):
    got = read_delivery(spark, folder, DDL, required=("x", "y"))
    assert got.rows.count() == 3
    assert rows_of(got.refused.where("reason LIKE 'empty%'"), "reason", "record") == [("empty: x", "4.5,4,"), ("empty: y", "5,e,x5")]


def test_files_of_one_header_share_a_scan(spark, folder, tmp_path):
    for i in range(30):
        (tmp_path / f"more{i}.csv").write_text(f"id,x,y\n{100 + i},m,1\n")
    assert len(headers(spark, folder)) == 4
    assert read_delivery(spark, folder, DDL).rows.where("x = 'm'").count() == 30


def test_nothing_delivered(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    got = read_delivery(spark, str(tmp_path), DDL)
    assert got.rows.columns == ["id", "x", "y", "file_name"] and got.rows.count() == got.refused.count() == 0


def test_a_header_with_a_column_twice_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,ID\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_delivery(spark, str(tmp_path), DDL)


def test_offer_files_of_a_day_leave_refused_rows_in_a_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "o_20230817_a.csv").write_text("SUB_ACCT_NO,REGIME,DISCOUNT\n1,r,5\n2,r,lots\n")
    (tmp_path / "in" / "o_20230817_b.csv").write_text("DISCOUNT,SUB_ACCT_NO\n6,3\n7\n")
    (tmp_path / "in" / "o_20230818.csv").write_text("SUB_ACCT_NO\n9\n")
    run, root = as_datetime(dt.datetime(2023, 8, 17, 1, 2, 3)), f"{tmp_path}/refused"
    for _ in range(2):
        rows = jobs.typed_offer_files(spark, f"{tmp_path}/in", dt.date(2023, 8, 17), root, run)
        assert rows_of(rows, "SUB_ACCT_NO", "REGIME", "DISCOUNT") == [(1, "r", 5), (3, None, 6)]
    assert rows_of(spark.read.parquet(root), "file_name", "reason", "record", "day") == [
        ("o_20230817_a.csv", "type: DISCOUNT", "2,r,lots", "20230817"), ("o_20230817_b.csv", "torn", "7", "20230817")]
