"""First answers to messages from two streams, with the day window as the bound on state, and what came too late for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.operators.joins import lookup_join
from touchline.operators.status import WINDOW_DAYS

MESSAGE = ["contact_id", "campaign_id", "sent_dt"]
KINDS = ("given", "send", "answer")


def answers_message(days: int, sent: str = "s", answer: str = "a") -> Column:
    """The answer is one to the message: its day of sending, and an event within the window of days."""
    return F.expr(
        f"{sent}.contact_id = {answer}.contact_id AND {sent}.campaign_id = {answer}.campaign_id"
        f" AND to_date({sent}.sent_dt) = {answer}.email_sent_at"
        f" AND {answer}.event_time >= {sent}.sent_dt - interval 1 day"
        f" AND {answer}.event_time < {sent}.sent_dt + interval {days + 1} days"
        f" AND datediff(to_date({answer}.event_time), {answer}.email_sent_at) BETWEEN 0 AND {days}"
    )


def first_answers(
    sends: DataFrame, answers: DataFrame, days: int = WINDOW_DAYS, late: str = "1 day", unanswered: bool = False
) -> DataFrame:
    """First answer of each message, from the day of sending to ``days`` days after it.

    ``sends`` has contact_id, campaign_id and sent_dt; ``answers`` has contact_id, campaign_id, email_sent_at (a
    date) and event_time. A message is given out, once, when the watermark says no answer can follow; its state
    is dropped then. ``unanswered`` also gives out, with NULL, the messages that nobody has answered by then. Unlike the
    batch update this form needs the lower bound, or state could never be dropped.
    """
    sent = sends.withWatermark("sent_dt", late).alias("s")
    events = answers.withWatermark("event_time", late).alias("a")
    joined = sent.join(events, answers_message(days), "left" if unanswered else "inner")
    return (
        joined.groupBy("s.contact_id", "s.campaign_id", "s.sent_dt")
        .agg(F.min("a.event_time").alias("first_answer"))
    )


def ingest_answers(
    sends: DataFrame, answers: DataFrame, root: str, checkpoint: str, days: int = WINDOW_DAYS, late: str = "1 day"
) -> None:
    """Run :func:`first_answers` over what has arrived and store, beside its rows, every row that came too late for it.

    Spark drops rows behind the watermark without a word. The same micro-batch therefore carries the arriving rows next
    to the join, and those older than the watermark can be (``late`` behind the newest send and the newest answer of
    earlier batches, whichever is older) are stored as late. A batch is one write, and a batch run again replaces its
    own folder. Rows without a key or a time can answer nothing and are not stored; an unanswered message is given out
    with NULL. :func:`settled` joins what is stored.
    """
    spark = sends.sparkSession
    given = first_answers(sends, answers, days, late, unanswered=True)
    empty = F.lit(None)
    rows = given.select(F.lit("given").alias("kind"), "contact_id", "campaign_id", F.col("sent_dt").alias("time"),
                        empty.cast("date").alias("email_sent_at"), "first_answer")
    rows = rows.unionByName(sends.select(
        F.lit("send").alias("kind"), "contact_id", "campaign_id", F.col("sent_dt").alias("time"),
        empty.cast("date").alias("email_sent_at"), empty.cast("timestamp").alias("first_answer")))
    rows = rows.unionByName(answers.select(
        F.lit("answer").alias("kind"), "contact_id", "campaign_id", F.col("event_time").alias("time"),
        F.col("email_sent_at"), empty.cast("timestamp").alias("first_answer")))

    def store(batch: DataFrame, batch_id: int) -> None:
        before = read_clock(spark, root, batch_id - 1) if batch_id else (None, None)
        seen = Observation()
        newest = [F.max(F.when(F.col("kind") == kind, F.col("time"))).alias(kind) for kind in KINDS[1:]]
        kept = F.col("kind") == "given"
        if None not in before:  # Spark drops what is not newer than the watermark
            kept = kept | (F.col("time") <= F.lit(min(before)) - F.expr(f"interval {late}"))
        watched = batch.observe(seen, *newest)
        watched.where(kept).dropna(subset=["contact_id", "campaign_id", "time"]).write.partitionBy("kind").mode(
            "overwrite").parquet(f"{root}/rows/batch={batch_id}")
        now = [max(filter(None, (old, seen.get.get(kind))), default=None) for old, kind in zip(before, KINDS[1:], strict=True)]
        spark.createDataFrame([tuple(now)], "send timestamp, answer timestamp").write.mode("overwrite").parquet(
            f"{root}/clock/batch={batch_id}")

    query = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_clock(spark: SparkSession, root: str, batch_id: int) -> tuple:
    """Newest send and newest answer up to a batch; one row, carried from batch to batch."""
    return tuple(spark.read.parquet(f"{root}/clock/batch={batch_id}").first())


def settled(sends: DataFrame, answers: DataFrame, root: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Messages given out or come too late, each with its first answer, late answers included; NULL without one.

    ``sends`` is read for messages not yet given out that a late answer is for, ``answers`` for late messages: both are
    the arrived rows as stored, and only rows of those keys take part. Equal to the batch result for every message
    given out; a message that is still open is left out, unless a late row is its.
    """
    spark = sends.sparkSession
    schema = "contact_id long, campaign_id long, time timestamp, email_sent_at date, first_answer timestamp, kind string, batch int"
    stored = spark.read.schema(schema).parquet(f"{root}/rows")
    given = stored.where("kind = 'given'").select("contact_id", "campaign_id", F.col("time").alias("sent_dt"), "first_answer")
    late_sends = stored.where("kind = 'send'").select("contact_id", "campaign_id", F.col("time").alias("sent_dt")).distinct()
    late_answers = stored.where("kind = 'answer'").select(
        "contact_id", "campaign_id", "email_sent_at", F.col("time").alias("event_time"))
    key = ["contact_id", "campaign_id"]

    def matched(messages: DataFrame, events: DataFrame, how: str) -> DataFrame:
        joined = messages.alias("s").join(events.alias("a"), answers_message(days), how)
        return joined.select(*[f"s.{c}" for c in MESSAGE], F.col("a.event_time").alias("first_answer"))

    concerned = lookup_join(sends.select(*MESSAGE), late_answers.select(*key).distinct(), key, "left_semi")
    wanted = lookup_join(answers.select(*late_answers.columns), late_sends.select(*key).distinct(), key, "left_semi")
    found = given.unionByName(matched(concerned, late_answers, "inner")).unionByName(matched(late_sends, wanted, "left"))
    return found.groupBy(*MESSAGE).agg(F.min("first_answer").alias("first_answer"))
