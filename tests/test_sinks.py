import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from touchline.sinks import handoff
from touchline.sinks import partitions as sink
from touchline.session import shared_folder, stage

T = "id int, month string, day string"
A, B, C = (1, "202401", "20240105"), (2, "202401", "20240106"), (3, "202402", "20240201")


def read(spark, root, schema=T):
    return spark.read.schema(schema).parquet(root)


def test_overwrites_only_what_comes(spark, frame, root):
    sink.write_partitions(frame(T, A, B, C), root, ["month", "day"])
    sink.write_partitions(frame(T, (9, *B[1:])), root, ["month", "day"])
    sink.write_partitions(frame(T), root, ["month", "day"], gather=False)
    assert rows_of(read(spark, root)) == [A, C, (9, *B[1:])]


def test_table_can_be_rewritten_from_itself(spark, frame, root):
    sink.write_partitions(frame(T, A, B, C), root, ["month", "day"])
    for _ in range(2):
        rows = read(spark, root).where("month = '202401'").withColumn("id", F.lit(7))
        sink.write_partitions(rows, root, ["month", "day"])
    assert rows_of(read(spark, root)) == [C, (7, *A[1:]), (7, *B[1:])]


def test_slice_replaced_even_by_nothing(spark, frame, root):
    S = "id int, dt string"
    sink.write_partitions(frame(S, (1, "2024-01-05"), (2, "2024-01-06")), root, ["dt"])
    for _ in range(2):
        sink.replace_slice(frame(S, (8, "2024-01-05")), root, "dt", "2024-01-05")
        assert rows_of(read(spark, root, S)) == [(2, "2024-01-06"), (8, "2024-01-05")]
    for other in ("2024-01-06", None):
        with pytest.raises(ValueError, match="outside the slice"):
            sink.replace_slice(frame(S, (8, "2024-01-05"), (9, other)), root, "dt", "2024-01-05")
        assert rows_of(read(spark, root, S)) == [(2, "2024-01-06"), (8, "2024-01-05")]
    sink.replace_slice(frame(S), root, "dt", "2024-01-05")
    assert rows_of(read(spark, root, S)) == [(2, "2024-01-06")]


def test_range_replaced(spark, frame, root):
    S = "id int, day string"
    old = [(i, f"202401{i:02d}") for i in range(1, 8)]
    sink.replace_range(frame(S, *old), root, "day", "20240101", "20240107")
    for _ in range(2):
        sink.replace_range(frame(S, (50, "20240105"), (90, "20240109")), root, "day", "20240103", "20240109")
    assert rows_of(read(spark, root, S)) == [old[0], old[1], (50, "20240105"), (90, "20240109")]
    with pytest.raises(ValueError, match="outside"):
        sink.replace_range(frame(S, (1, "20240101")), root, "day", "20240103", "20240109")


def test_batch_comes_once(spark, frame, root):
    schema = T + ", batch string"
    sink.append_batch(frame(T, A, B), root, ["month", "day"], "one")
    sink.append_batch(frame(T, A), root, ["month", "day"], "two")
    sink.append_batch(frame(T, C), root, ["month", "day"], "one")
    assert rows_of(read(spark, root, schema)) == [(*A, "two"), (*C, "one")]


def test_batch_among_others(spark, frame, root):
    schema = "id int, file string, month string, day string"
    row = lambda id, file, key: (id, file, *key[1:])
    sink.write_partitions(frame(schema, row(1, "f", A), row(2, "g", A), row(3, "f", B), row(4, "g", C)), root,
                          ["month", "day"])
    for _ in range(2):
        sink.merge_batch(frame(schema, row(8, "f", A), row(9, "f", C)), root, ["month", "day"], "file", "f")
    assert rows_of(read(spark, root, schema)) == [row(2, "g", A), row(4, "g", C), row(8, "f", A), row(9, "f", C)]


def test_rows_counted_by_the_write(spark, frame, root):
    df, count = sink.observed(frame(T, A, B, C))
    sink.snapshot(df, root)
    assert count.get == {"rows": 3}


def test_odd_partition_values(spark, frame, root):
    S = "id int, k string"
    sink.write_partitions(frame(S, (1, "a/b=c"), (2, "x y")), root, ["k"])
    sink.replace_slice(frame(S, (3, "a/b=c")), root, "k", "a/b=c")
    assert rows_of(read(spark, root, S)) == [(2, "x y"), (3, "a/b=c")]


def test_publish_rewrites_the_table_it_reads(spark, frame, root):
    sink.write_partitions(frame(T, A, B, C), root, ["month", "day"])
    sink.publish(read(spark, root).where("id > 1"), root, ["month", "day"])
    assert rows_of(read(spark, root)) == [B, C]
    sink.publish(read(spark, root).where("id > 100"), root, ["month", "day"])
    assert rows_of(read(spark, root)) == [B, C]


def test_a_broken_publish_is_restored(spark, frame, root, tmp_path, monkeypatch):
    sink.write_partitions(frame(T, A, B), root, ["month", "day"])

    def dies(df, root, keys):
        df.limit(0).write.mode("overwrite").parquet(root)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sink, "_overwrite", dies)
        with pytest.raises(OSError):
            sink.publish(read(spark, root).unionByName(frame(T, C)), root, ["month", "day"], f"{tmp_path}/aside")
    assert read(spark, root).count() == 0
    sink.restore(spark, f"{tmp_path}/aside", root, ["month", "day"])
    assert rows_of(read(spark, root)) == [A, B, C]


def test_snapshot_append_and_guards(spark, frame, root):
    sink.snapshot(frame("id int", (1,), (2,)), root)
    sink.snapshot(frame("id int", (3,)), root)
    sink.append(frame("id int", (4,)), root)
    assert rows_of(read(spark, root, "id int")) == [(3,), (4,)]
    assert not sink.write_if_rows(frame("id int"), lambda df: sink.snapshot(df, root))
    assert sink.write_if_rows(frame("id int", (5,)), lambda df: sink.snapshot(df, root))
    assert rows_of(read(spark, root, "id int")) == [(5,)]
    with pytest.raises(ValueError, match="f.csv is empty"):
        sink.require_rows(frame("id int"), "f.csv")


def test_partitions_registered(spark, frame, root):
    spark.sql(f"create table registered (id int, month string) using parquet partitioned by (month) location '{root}'")
    sink.write_partitions(frame("id int, month string", (1, "202401")), root, ["month"])
    sink.register_partitions(spark, "registered")
    assert spark.table("registered").count() == 1
    spark.sql("drop table registered")


def test_run_in_one_partition_is_written_by_many_tasks(spark, root):
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "'202401' as month")
    sink.write_partitions(df, root, ["month"], gather=False)
    assert len(glob.glob(f"{root}/month=202401/*.parquet")) == 4


def test_csv_handoff(spark, frame, root):
    df = frame("id int, t string, month string", (1, " x ", "202401"), (2, "y", "202401")).repartition(2)
    handoff.write_csv(df, root, drop=["month"], files=1)
    (file,) = glob.glob(f"{root}/*.csv")
    lines = open(file).read().splitlines()
    assert lines[0] == "id,t" and sorted(lines[1:]) == ["1,x", "2,y"]
    handoff.write_csv(df, root, drop=["month"], files=None)
    assert len(glob.glob(f"{root}/*.csv")) == 2


def test_dated_csv_and_archive(spark, frame, tmp_path):
    path = handoff.write_dated_csv(frame("a int", (1,)), str(tmp_path), "fixed_base", dt.date(2023, 9, 1))
    assert path.endswith("/fixed_base_2023_09_01") and spark.read.csv(path, header=True).count() == 1
    handoff.archive_tsv(frame("a int, b string", (1, "x")), f"{tmp_path}/arch", "20230901")
    archived = spark.read.csv(f"{tmp_path}/arch", header=True, sep="\t")
    assert archived.columns == ["a", "b", "upload_date"] and rows_of(archived) == [("1", "x", "20230901")]


def test_stage_uses_the_folder_the_session_names(spark, frame):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    copy = stage(frame("id int", (1,), (2,)))
    assert rows_of(copy) == [(1,), (2,)]
    assert all(folder in f for f in copy.inputFiles())


def test_many_partitions_are_emptied_without_a_job_each(spark, root):
    rows = spark.range(520).selectExpr("id", "lpad(id, 4, '0') AS day")
    sink.write_partitions(rows, root, ["day"], gather=False)
    tracker, group = spark.sparkContext.statusTracker(), "emptied"
    spark.sparkContext.setJobGroup(group, "emptying 500 partitions")
    try:
        sink.replace_range(rows.where("id = 3"), root, "day", "0000", "0499")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) < 20
    assert rows_of(spark.read.parquet(root), "id") == sorted([(3,), *((i,) for i in range(500, 520))], key=repr)


def test_a_batch_reads_the_folders_it_touches(spark, frame, root):
    ddl = "id int, name string, day string"
    sink.write_partitions(frame(ddl, *[(i, "other", f"{i:03d}") for i in range(40)], (100, "mine", "007")), root, ["day"])
    sink.merge_batch(frame(ddl, (101, "mine", "009")), root, ["day"], "name", "mine")
    got = rows_of(spark.read.schema(ddl).parquet(root), "id")
    assert got == sorted([*((i,) for i in range(40)), (101,)], key=repr)
    plan = sink._read_partitions(spark, root, ["day"], spark.read.schema(ddl).parquet(root).schema, [("007",), ("009",)])
    assert {f.split("day=")[1][:3] for f in plan.inputFiles()} == {"007", "009"}
