import datetime as dt
import json

from tests.conftest import rows_of
from touchline.streaming.arrivals import arriving_csv, ingest_arrivals, once_within

DDL = "id int, v string, at timestamp"


def put(folder, name, *rows):
    (folder / name).write_text("id,v,at\n" + "".join(f"{i},{v},{at}\n" for i, v, at in rows))


def load(spark, folder, root, checkpoint):
    """One run over what has arrived; the progress of its batches."""
    stream = once_within(arriving_csv(spark, str(folder), DDL, name_glob="*.csv"), "at", "2 days")
    before = {q.id for q in spark.streams.active}
    ingest_arrivals(stream, root, ["month", "day"], checkpoint, "copies")
    assert {q.id for q in spark.streams.active} == before
    return spark.read.parquet(root)


def day(n):
    return (dt.datetime(2024, 1, 1, 10) + dt.timedelta(days=n)).isoformat(sep=" ")


def test_a_file_that_comes_again_under_another_name_adds_nothing(spark, tmp_path, root):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    folder.mkdir()
    rows = [(i, "v", day(0)) for i in range(50)]
    put(folder, "a_20240101.csv", *rows)
    assert load(spark, folder, root, checkpoint).count() == 50
    put(folder, "b_20240101.csv", *rows)
    put(folder, "c_20240101.csv", *rows[:10], (99, "", day(0)), (98, "w", day(1)))
    got = load(spark, folder, root, checkpoint)
    assert rows_of(got, "id") == sorted([(i,) for i in range(50)] + [(99,), (98,)], key=repr)
    assert got.where("id = 99 AND v IS NULL").count() == 1


def test_state_is_bounded_by_the_delay(spark, tmp_path, root):
    """Each day's rows leave the state when the days after it have come."""
    folder, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    folder.mkdir()
    held = []
    for n in range(0, 24, 3):
        put(folder, f"d{n:02d}_20240101.csv", *[(1000 * n + i, "v", day(n)) for i in range(40)])
        stream = once_within(arriving_csv(spark, str(folder), DDL), "at", "2 days")
        query = (stream.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        held += [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if json.loads(p.json)["stateOperators"]]
    assert max(held) <= 120 and held[-1] <= 80
