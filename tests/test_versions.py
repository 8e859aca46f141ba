import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from touchline.sinks.versions import ConcurrentWrite, Table

DDL = "id int, v string"
KEYS = ("month", "channel")
ROWS = DDL + ", month string, channel string"


@pytest.fixture
def table(spark, frame, root):
    t = Table(spark, root, KEYS, {"rows": DDL})
    t.commit(rows=frame(ROWS, (1, "a", "01", "x y"), (2, "b", "01", "z"), (3, "c", "02", None)))
    return t


def test_partitions_give_way_one_by_one(frame, table):
    table.commit([("01", "z")], rows=frame(ROWS, (4, "d", "03", "w")))
    assert rows_of(table.read("rows")) == sorted([(1, "a", "01", "x y"), (3, "c", "02", None), (4, "d", "03", "w")], key=repr)
    assert rows_of(table.read("rows", number=1), "id") == [(1,), (2,), (3,)]
    assert rows_of(table.read("rows", only=[("02", None), ("09", "x")]), "id") == [(3,)]
    table.commit(rows=frame(ROWS))
    assert table.read("rows").count() == 0 and table.read("rows").columns == ["id", "v", *KEYS]


def test_only_what_changes_is_written(frame, table, root):
    import pathlib
    before = {str(p) for p in pathlib.Path(root).rglob("*.parquet")}
    table.commit([], rows=frame(ROWS, (9, "new", "02", None)))
    after = {str(p) for p in pathlib.Path(root).rglob("*.parquet")} - before
    assert len(after) == 1 and rows_of(table.read("rows"), "id") == [(1,), (2,), (9,)]


def test_a_write_that_dies_leaves_the_old_table(spark, frame, table):
    """Killed while rows are written: half of the tasks have written, the others fail."""
    def broken(batches):
        for batch in batches:
            if batch.column(0)[0].as_py() >= 500:
                raise RuntimeError("killed")
            yield batch
    rows = spark.range(0, 1000, numPartitions=2).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("v"), F.lit("01").alias("month"), F.lit("z").alias("channel"))
    with pytest.raises(Exception, match="killed"):
        table.commit(rows=rows.mapInArrow(broken, ROWS))
    assert rows_of(table.read("rows"), "id") == [(1,), (2,), (3,)]
    table.commit([("01", "z")], rows=frame(ROWS))
    assert rows_of(table.read("rows"), "id") == [(1,), (3,)]


def test_a_commit_that_dies_leaves_the_old_table(frame, table, monkeypatch):
    """Killed between the rows and the commit, and while the commit is written."""
    for step in ("write", "rename"):
        with monkeypatch.context() as patch:
            def killed(*_):
                raise RuntimeError("killed")
            patch.setattr(table.commits, step, killed)
            with pytest.raises(RuntimeError, match="killed"):
                table.commit(rows=frame(ROWS, (9, "n", "01", "z")))
        assert rows_of(table.read("rows"), "id") == [(1,), (2,), (3,)]
    assert len(table.expire()) == 2 and rows_of(table.read("rows"), "id") == [(1,), (2,), (3,)]


def test_the_second_of_two_runs_is_refused(frame, table):
    start = table.last()
    table.commit([], since=start, rows=frame(ROWS, (8, "first", "01", "z")))
    with pytest.raises(ConcurrentWrite):
        table.commit([], since=start, rows=frame(ROWS, (9, "second", "01", "z")))
    assert rows_of(table.read("rows"), "id") == [(1,), (3,), (8,)]


def test_a_reader_keeps_what_it_began_with(frame, table):
    """Readers between, before and after commits see a whole state, never a mixture."""
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            seen.append(tuple(r[0] for r in rows_of(table.read("rows"), "id")))
    held = table.read("rows")
    thread = threading.Thread(target=look)
    thread.start()
    for n in range(3):
        table.commit(rows=frame(ROWS, *[(10 * n + i, "n", f"0{i}", "z") for i in range(3)]))
    stop.set()
    thread.join()
    assert set(seen) <= {(1, 2, 3), (0, 1, 2), (10, 11, 12), (20, 21, 22)}
    assert rows_of(held, "id") == [(1,), (2,), (3,)]
    assert rows_of(table.read("rows"), "id") == [(20,), (21,), (22,)]


def test_old_versions_go(frame, table):
    for n in range(3):
        table.commit(rows=frame(ROWS, (n, "n", "01", "z")))
    assert len(table.expire(keep=2)) == 2
    assert rows_of(table.read("rows"), "id") == [(2,)] and rows_of(table.read("rows", number=3), "id") == [(1,)]
