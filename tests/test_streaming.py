import datetime as dt

from tests.conftest import rows_of
from touchline.streaming.late_feedback import first_answers

T0 = dt.datetime(2024, 1, 1, 10)
SENDS = "contact_id long, campaign_id long, sent_dt timestamp"
ANSWERS = "contact_id long, campaign_id long, email_sent_at date, event_time timestamp"


def run(spark, tmp_path, name):
    read = lambda schema, kind: spark.readStream.schema(schema).parquet(f"{tmp_path}/{kind}")
    out = first_answers(read(SENDS, "sends"), read(ANSWERS, "answers"))
    query = (out.writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/ck").outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def test_first_answer_once_when_no_more_can_come(spark, frame, tmp_path):
    put = lambda df, kind: df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{kind}")
    day = lambda n, h=0: T0 + dt.timedelta(days=n, hours=h)
    sent = T0.date()
    put(frame(SENDS, (1, 7, T0), (2, 7, T0), (3, 7, T0)), "sends")
    put(frame(ANSWERS, (1, 7, sent, day(5)), (1, 7, sent, day(3)), (2, 7, sent, day(14)), (2, 8, sent, day(1))), "answers")
    run(spark, tmp_path, "a")
    # a later run brings an earlier answer, one past the window, and time enough to close the first messages
    put(frame(SENDS, (9, 9, day(40))), "sends")
    put(frame(ANSWERS, (1, 7, sent, day(2, 20)), (3, 7, sent, day(16)), (9, 9, day(40).date(), day(40, 1))), "answers")
    run(spark, tmp_path, "b")
    put(frame(SENDS, (9, 9, day(80))), "sends")
    put(frame(ANSWERS, (9, 9, day(80).date(), day(80, 1))), "answers")
    run(spark, tmp_path, "c")
    run(spark, tmp_path, "d")
    got = rows_of(spark.read.parquet(f"{tmp_path}/out"), "contact_id", "first_answer")
    assert got[:2] == [(1, day(2, 20)), (2, day(14))]
    assert 3 not in [r[0] for r in got] and len({r[0] for r in got}) == len(got)
