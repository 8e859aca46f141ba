"""The jobs end to end on small files and folders."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from touchline import schemas
from touchline.functions.columns import conform
from touchline.operators.mirror import mirror
from touchline.plans import jobs, mirrors
from touchline.streaming import arrivals

DAY = dt.date(2024, 1, 5)
RUN = dt.datetime(2024, 1, 5, 1, 2, 3)
T0 = dt.datetime(2024, 1, 5, 10)


@pytest.mark.parametrize("name", [n for n in dir(mirrors) if n.isupper()])
def test_every_mirror_runs_on_its_columns(spark, name):
    spec = getattr(mirrors, name)
    from touchline.functions.columns import read_ddl
    from touchline.operators.mirror import mirror
    source = spark.range(2).select(*[
        F.lit("5").try_cast(f.dataType).alias(spec.sources.get(f.name, f.name)) for f in read_ddl(spec.columns).fields
    ])
    got = mirror(source, spec, "ACC_")
    assert got.count() == 1
    if spec.account_from:
        assert got.select("account_id").first()[0] in ("ACC_5", "ACC_5.0")
    if spec.timestamps_as_ms or spec.ms_instead:
        assert not [c for c, t in got.dtypes if t == "timestamp"]


def test_mirror_jobs(spark, frame, tmp_path):
    source, root = f"{tmp_path}/in/assets", f"{tmp_path}/out/assets"
    rows = [("p", 1.5, "2024-01-04"), ("p", 1.5, "2024-01-04"), ("q", 2.5, "2024-01-05"), ("r", 0.5, "2024-01-06")]
    assets = conform(frame("pkg_cde_pks string, chrg_pks double, dt string", *rows), mirrors.ASSETS.columns)
    assets.write.partitionBy("dt").parquet(source)
    for _ in range(2):
        jobs.mirror_slice(spark, source, root, mirrors.ASSETS, "2024-01-04", "ACC_", "dt")
        jobs.mirror_since(spark, source, root, mirrors.ASSETS, "2024-01-04", "ACC_", "dt")
    got = spark.read.parquet(root)
    assert rows_of(got, "pkg_cde_pks", "dt", "dt_ms") == [
        ("p", "2024-01-04", 1704326400000), ("q", "2024-01-05", 1704412800000), ("r", "2024-01-06", 1704499200000)]
    jobs.mirror_slice(spark, source, root, mirrors.ASSETS, "2024-01-07", "ACC_", "dt")
    assert spark.read.parquet(root).count() == 3


def test_window_mirror(spark, frame, tmp_path):
    source, root = f"{tmp_path}/in/h", f"{tmp_path}/out/h"
    days = [f"{DAY - dt.timedelta(n):%Y%m%d}" for n in range(16)]
    conform(frame("account_id string, conversion_dt string, day string", *[("a", "2024-01-01 00:00:00", d) for d in days]),
            schemas.HISTORY).write.partitionBy("month", "day", "channel").parquet(source)
    for run in (DAY - dt.timedelta(1), DAY, DAY):
        jobs.mirror_window(spark, source, root, mirrors.HISTORY_WINDOW, run, "ACC_")
    got = spark.read.parquet(root)
    assert sorted(r[0] for r in got.select("dt").collect()) == sorted(days[:15])
    assert got.select("conv_dt_ms").first()[0] == 1704067200000


def test_price_book_load_comes_once(spark, frame, tmp_path):
    source, root = f"{tmp_path}/in/p", f"{tmp_path}/out/p"
    conform(frame("csg_codes string", ("a",), ("a",), ("b",)), mirrors.PRICE_BOOK.columns).write.parquet(source)
    for load in ("1", "1", "2"):
        jobs.price_book(spark, source, root, load)
    assert spark.read.parquet(root).count() == 4


def test_feeds_to_history_to_status(spark, frame, tmp_path):
    roots = {k: f"{tmp_path}/{k}" for k in schemas.FEEDS}
    history = f"{tmp_path}/history"
    event = "contact_id long, campaign_id string, event_time timestamp, email_sent_at timestamp, bounce_type string"
    sources = {
        "campaigns": frame("id long, program_id long, event_time timestamp", (7, 5, T0), (8, 6, T0)),
        "sends": frame("contact_id long, campaign_id long, event_time timestamp", (1, 7, T0), (2, 7, T0), (3, 8, T0)),
        "cancels": frame("contact_id long, campaign_id long, event_time timestamp, reason string", (2, 7, T0, "r")),
        "opens": frame(event, (1, "7", T0 + dt.timedelta(hours=1), T0, None)),
        "clicks": frame(event, *[(1, "7", T0 + dt.timedelta(hours=2), T0, None)] * 2),
        "bounces": frame(event, (2, "7", T0 + dt.timedelta(hours=1), T0, "hard")),
    }
    programs = frame("id string, name string", ("5", "x_TAG"), ("6", "y"))
    read = lambda k: spark.read.schema(schemas.FEEDS[k] + ", month string, day string").parquet(roots[k])
    for _ in range(2):
        jobs.load_feeds(sources, roots, programs, DAY, "_TAG")
    assert read("sends").count() == 2 and read("clicks").count() == 2
    jobs.compose_and_store(
        history, DAY, sends=read("sends"), cancels=read("cancels"),
        contact_ids=frame("user_id long, account_id string", (1, "ACC_1")),
        offers=frame("sub_acct_no string, offer_type string, channel string, use_case string, date string, "
                     "id_oferta_int long, regime string, day string"),
        links=frame("id_oferta_int long, link string, link_generated_dt date, link_expiration_dt date"),
        campaigns=read("campaigns"), programs=programs, prefix="ACC_")
    for _ in range(2):
        jobs.refresh_status(spark, history, DAY, read("opens"), read("clicks"), read("bounces"), days=14)
    got = spark.read.schema(schemas.HISTORY).parquet(history)
    assert rows_of(got, "contact_id", "sent_dt", "cancel_reason", "open_dt", "clicks_count", "bounce_type") == sorted([
        (1, T0, None, T0 + dt.timedelta(hours=1), 2, None), (2, T0, None, None, None, "hard"),
        (2, None, "r", None, None, "hard")], key=repr)

    conversions = frame(schemas.CONVERSIONS, ("ACC_1", "TAG", "o", "1704672000000", "web"))
    got = lambda: spark.read.schema(schemas.HISTORY).parquet(history)
    for _ in range(2):
        jobs.attribute(spark, history, conversions)
        assert rows_of(got(), "contact_id", "conv_flg", "order_id") == [(1, True, "o"), (2, None, None), (2, None, None)]
    more = frame(schemas.CONVERSIONS, ("ACC_1", "TAG", "p", "1704672000000", "web"), ("ACC_1", "other", "q", "1704672000000", "web"))
    for _ in range(2):
        jobs.refresh_status(spark, history, DAY, read("opens"), read("clicks"), read("bounces"), days=14)
        jobs.attribute(spark, history, more)
        assert rows_of(got(), "contact_id", "conv_flg", "order_id") == [(1, True, "o"), (2, None, None), (2, None, None)]


def test_conversions_come_from_a_file_or_the_archive(spark, frame, tmp_path):
    history = f"{tmp_path}/history"
    conform(frame("account_id string, campaign_name string, channel string, contact_dt timestamp, month string, day string",
                  ("A", "x u y", "email", T0, "202401", "20240105"), ("A", "v", "email", T0, "202401", "20240105")), schemas.HISTORY
            ).write.partitionBy(*schemas.HISTORY_KEYS).parquet(history)
    archive = frame(schemas.CONVERSIONS + ", day string", ("A", "u", "o", "1704672000000", "web", "20240106"), ("A", "v", "p", "1704672000000", "web", "20240107"))
    got = lambda: rows_of(spark.read.schema(schemas.HISTORY).parquet(history), "campaign_name", "conv_flg", "order_id")
    archive.write.partitionBy("day").parquet(f"{tmp_path}/archive")
    for _ in range(2):
        jobs.attribute(spark, history, archive=f"{tmp_path}/archive", keys={"day": "20240106"})
        assert got() == [("v", False, "o"), ("x u y", True, "o")]
    (tmp_path / "c.csv").write_text("account_id,conv_use_case_cat,order_id,conv_dte,conv_type\nA,v,f,1704672000000,web\n")
    jobs.attribute(spark, history, arrived=f"{tmp_path}/c.csv")
    assert got() == [("v", True, "f"), ("x u y", True, "o")]


def test_calls(spark, frame, tmp_path):
    (tmp_path / "outbound_feedback_autumn.csv").write_text(
        "Cuenta,Intento_discado_1,Intento_discado_2,Intento_discado_3,Hora_llamada,Disposicion,Comentarios\n"
        "11,1/5/2024,01/06/2024,,10:00,OFITi- Cliente acepta oferta,\n12,1/5/2024,,,10:00,busy,\n")
    feedback, history = f"{tmp_path}/feedback", f"{tmp_path}/history"
    other = ("m", "spring", "202401", "20240105")
    conform(frame("account_id string, campaign_name string, month string, day string, channel string",
                  (*other, "email"), (*other, "Outbound_call")), schemas.HISTORY
            ).write.partitionBy(*schemas.HISTORY_KEYS).parquet(history)
    for _ in range(2):
        jobs.load_calls(spark, f"{tmp_path}/outbound_feedback_autumn.csv", feedback, history, RUN, "ACC_", "autumn")
    whole = spark.read.schema(schemas.HISTORY).parquet(history)
    assert rows_of(whole.where("campaign_name = 'spring'"), "account_id", "channel") == [
        ("m", "Outbound_call"), ("m", "email")]
    got = whole.where("campaign_name = 'autumn'")
    assert rows_of(got, "account_id", "comm_dt", "contact_dt", "day") == sorted([
        ("ACC_11", DAY, None, "20240105"), ("ACC_11", dt.date(2024, 1, 6), dt.datetime(2024, 1, 6), "20240106"),
        ("ACC_12", DAY, None, "20240105")], key=repr)
    calls = spark.read.schema(schemas.CALL_FEEDBACK + ", month string, day string, day_hour string").parquet(feedback)
    assert calls.count() == 2 and calls.select("csv_origen").first()[0] == "outbound_feedback_autumn.csv"

    audience = f"{tmp_path}/audience"
    got.write.partitionBy(*schemas.HISTORY_KEYS).parquet(audience)
    jobs.refresh_call_contact(spark, audience, calls, DAY)
    rows = spark.read.schema(schemas.HISTORY).parquet(audience)
    assert rows_of(rows.where(F.col("comm_dt") == DAY), "account_id", "contact_dt") == [
        ("ACC_11", dt.datetime(2024, 1, 5)), ("ACC_12", None)]


def test_offers_and_links(spark, frame, tmp_path):
    names = [c.split(" ")[0] for c in schemas.OFFERS_IN.split(", ")]
    line = lambda number, **v: ",".join({"sub_acct_no": number, **v}.get(n, "") for n in names)
    given = {"channel": "email", "use_case": "up", "offer_type": "single", "next_best_action_date": "2024-01-05",
             "reward": "bad"}
    (tmp_path / "o.csv").write_text("\n".join([",".join(names), line("12", **given), line("11", **given)]) + "\n")
    root = f"{tmp_path}/offers"
    jobs.load_offers(spark, f"{tmp_path}/o.csv", root, RUN)
    jobs.load_offers(spark, f"{tmp_path}/o.csv", root, RUN + dt.timedelta(hours=1))
    stored = spark.read.parquet(root)
    assert rows_of(stored, "sub_acct_no", "id_oferta_int", "reward") == [
        ("11", 1, None), ("11", 3, None), ("12", 2, None), ("12", 4, None)]

    ms = str(int(dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc).timestamp() * 1000))
    asked = frame("account string, action_ms string, expiration_ms string, channel string, use_case string, offer_type string",
                  ("11", ms, ms, "email", "up", "single"), ("12", ms, ms, "sms", "up", "single"))
    jobs.request_links(stored, asked, f"{tmp_path}/asked", f"{tmp_path}/csv", RUN)
    assert rows_of(spark.read.parquet(f"{tmp_path}/asked"), "SUB_ACCT_NO_SBB", "ID_OFERTA_INT", "day_hour") == [
        ("11", 1, "20240105010203"), ("11", 3, "20240105010203")]
    assert spark.read.csv(f"{tmp_path}/csv", header=True).columns[-1] == "LINK_EXPIRATION_DT"

    (tmp_path / "l.csv").write_text(
        "SUB_ACCT_NO,LINK,CREATED_DATETIME,LINK_EXPIRATION_DT\n11,u,1/5/2024 9:00:00 AM,2024-02-01\n")
    jobs.store_links(spark, f"{tmp_path}/l.csv", f"{tmp_path}/asked", f"{tmp_path}/links", RUN)
    assert rows_of(spark.read.parquet(f"{tmp_path}/links"), "LINK", "id_oferta_int") == [("u", 3)]

    jobs.request_packages(stored, frame("account string, offer_type string", ("12", "single")), f"{tmp_path}/rpp",
                          f"{tmp_path}/rppcsv", RUN)
    assert spark.read.csv(f"{tmp_path}/rppcsv", header=True).count() == 2


def test_accounts_and_contacts(spark, frame, tmp_path):
    accounts = frame("sub_acct_no_sbb long", (1,), (2,))
    args = (spark, accounts, "sub_acct_no_sbb", "ACC_", {"mkt": "FIXED"}, str(tmp_path), DAY)
    (tmp_path / "w.csv").write_text("sub_acct_no_sbb,disconnection date,hasvideo,bef_value_amt\n2,2024-01-02,Y,x\n3,,N,2.5\n")
    assert spark.read.csv(jobs.export_base(*args, f"{tmp_path}/none.csv"), header=True).count() == 2
    assert spark.read.csv(jobs.export_base(*args, f"{tmp_path}/w.csv"), header=True).count() == 3

    (tmp_path / "base_Autumn_CALLCENTER_x_export.csv").write_text("user id;acct (key)\n1;ACC_1\n2;other\n")
    export = f"{tmp_path}/base_Autumn_CALLCENTER_x_export.csv"
    jobs.load_contact_ids(spark, export, f"{tmp_path}/ids", "user_id", "acct__key_", "ACC_", RUN)
    assert rows_of(spark.read.parquet(f"{tmp_path}/ids")) == [(1, "ACC_1", "20240105")]
    jobs.load_contact_export(spark, export, f"{tmp_path}/exp", RUN)
    assert spark.read.parquet(f"{tmp_path}/exp").count() == 2
    jobs.load_call_audience(spark, export, f"{tmp_path}/aud", f"{tmp_path}/audcsv", RUN)
    assert rows_of(spark.read.parquet(f"{tmp_path}/aud"), "channel", "campaign_name") == [("CALLCENTER", "Autumn")] * 2
    assert spark.read.csv(f"{tmp_path}/audcsv", header=True).columns == ["user_id", "acct__key_"]
    (tmp_path / "empty_export.csv").write_text("user id;acct (key)\n")
    with pytest.raises(ValueError, match="empty"):
        jobs.load_call_audience(spark, f"{tmp_path}/empty_export.csv", f"{tmp_path}/aud", f"{tmp_path}/audcsv", RUN)

    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text('{"id":"1","864":"ACC_1"}\n{"id":"1","864":"ACC_1"}\n{"id":"2","864":"B"}')
    jobs.load_paged_contacts(spark, f"{tmp_path}/pages", f"{tmp_path}/paged", "864", "ACC_")
    assert spark.read.parquet(f"{tmp_path}/paged").count() == 1


def test_winback_conversions_offer_files_snapshot(spark, frame, tmp_path):
    names = [mirrors.WINBACK.sources.get(c.split(" ")[0], c.split(" ")[0]) for c in mirrors.WINBACK.columns.split(", ")]
    value = {"sub_acct_no_sbb": "2", "disconnection date": "2024-01-02", "hasvideo": "Y", "bef_value_amt": "x"}
    (tmp_path / "w.csv").write_text(",".join(names) + "\n" + ",".join(value.get(n, "") for n in names) + "\n")
    for _ in range(2):
        jobs.load_winback(spark, f"{tmp_path}/w.csv", f"{tmp_path}/wb", f"{tmp_path}/arch", "20240101", "ACC_")
    assert rows_of(spark.read.parquet(f"{tmp_path}/wb"), "account_id", "hasvideo", "bef_value_amt",
                   "disconnection_date_ms") == [("ACC_2", True, None, 1704153600000)]

    (tmp_path / "c.csv").write_text("account_id,conv_dte\nA,1\n")
    for run in (RUN, RUN, RUN + dt.timedelta(seconds=1)):
        jobs.archive_conversions(spark, f"{tmp_path}/c.csv", f"{tmp_path}/conv", run)
    assert rows_of(spark.read.parquet(f"{tmp_path}/conv"), "month", "hour") == [("202401", "010203"), ("202401", "010204")]

    (tmp_path / "of").mkdir()
    header = ",".join(c.split(" ")[0] for c in schemas.OFFER_FILE.split(", "))
    for day in ("20240105", "20240106"):
        (tmp_path / "of" / f"offers_{day}.csv").write_text(f"{header}\n7{',x' * 14}\n")
    assert rows_of(jobs.typed_offer_files(spark, f"{tmp_path}/of", DAY), "SUB_ACCT_NO", "DISCOUNT", "STB") == [(7, None, "x")]

    frame("a int", (1,)).createOrReplaceTempView("some_view")
    jobs.snapshot_view(spark, "some_view", f"{tmp_path}/snap")
    assert spark.read.parquet(f"{tmp_path}/snap").count() == 1


def test_arrivals_once_each(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    run = lambda: arrivals.ingest_arrivals(
        arrivals.arriving_csv(spark, str(folder), "a string, b string"), f"{tmp_path}/out", ["month", "day"], f"{tmp_path}/ck", "first")
    (folder / "x_20240105.csv").write_text("a,b\n1,x\n2,y\n")
    run()
    (folder / "x_20240106.csv").write_text("a,b\n3,z\n")
    run()
    run()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(got, "a", "month", "day") == [
        ("1", "202401", "20240105"), ("2", "202401", "20240105"), ("3", "202401", "20240106")]
    assert glob.glob(f"{tmp_path}/out/month=202401/day=20240106/batch=*")
    other = tmp_path / "other"
    other.mkdir()
    (other / "y_20240105.csv").write_text("a,b\n9,w\n")
    for _ in range(2):
        arrivals.ingest_arrivals(arrivals.arriving_csv(spark, str(other), "a string, b string"), f"{tmp_path}/out", ["month", "day"], f"{tmp_path}/ck2", "second")
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("a").collect()) == ["1", "2", "3", "9"]


def test_day_first_dates_of_arrived_offers(spark, frame, tmp_path):
    source, root = f"{tmp_path}/in/o", f"{tmp_path}/out/o"
    rows = [("a", "05/08/2023", "13/08/2023"), ("b", "5-8-2023", "2023-08-05"), ("c", "2023-08-05", "x")]
    day = conform(frame("sub_acct_no string, date string, next_best_action_date string", *rows), schemas.OFFERS_IN + ", day string")
    day.drop("next_best_action_date").join(frame("sub_acct_no string, date string, next_best_action_date string", *rows).drop("date"), "sub_acct_no").withColumn(
        "id_oferta_int", F.lit(1).cast("long")).withColumn("day", F.lit("20230805")).write.partitionBy("day").parquet(source)
    got = mirror(spark.read.parquet(source), mirrors.OFFERS_ARRIVED, "ACC_")
    assert rows_of(got, "sub_acct_no", "dt_ms", "next_best_action_date_ms") == sorted([
        ("a", 1691193600000, 1691884800000), ("b", 1691193600000, 1691193600000), ("c", 1691193600000, None)], key=repr)


def test_offers_loaded_again_keep_their_ids(spark, tmp_path):
    header = ",".join(c.split(" ")[0] for c in schemas.OFFERS_IN.split(", "))
    (tmp_path / "o.csv").write_text("\n".join([header, *(f"{i}{',' * header.count(',')}" for i in (3, 1, 2))]) + "\n")
    ids = []
    for run in (RUN, RUN, RUN + dt.timedelta(days=1), RUN):
        jobs.load_offers(spark, f"{tmp_path}/o.csv", f"{tmp_path}/offers", run)
        ids.append(sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/offers").select("id_oferta_int").collect()))
    assert ids[0] == ids[1] == [1, 2, 3] and ids[2] == [1, 2, 3, 4, 5, 6] and len(set(ids[3])) == 6


def test_simple_history_is_stored_and_registered(spark, frame, tmp_path):
    event = "contact_id long, campaign_id long, event_time timestamp, launch_id long"
    campaigns = frame("id long, name string, event_time timestamp", (7, "old", T0), (7, "new", T0 + dt.timedelta(1)))
    root = f"{tmp_path}/simple"
    spark.sql(f"create table simple_history ({schemas.SIMPLE_HISTORY}, month string, day string) using parquet "
              f"partitioned by (month, day) location '{root}'")
    try:
        for day, sends in ((DAY, [(1, 7, T0, 3)] * 2), (DAY, [(1, 7, T0, 3)]), (DAY + dt.timedelta(1), [(5, 8, T0 + dt.timedelta(1), 4)])):
            jobs.store_simple_history(root, day, frame(event, *sends), frame(event, (2, 7, T0, 3)), frame(event, (None, 7, T0, 3)),
                                      campaigns, table="simple_history")
        got = rows_of(spark.table("simple_history"), "contact_id", "campaign_name", "channel", "day")
        assert got == [(1, "new", "email", f"{DAY:%Y%m%d}"), (2, "new", "email", f"{DAY:%Y%m%d}"),
                       (5, None, "email", f"{DAY + dt.timedelta(1):%Y%m%d}")]
    finally:
        spark.sql("drop table simple_history")


def test_offers_are_known_to_the_catalog(spark, tmp_path):
    names = [c.split(" ")[0] for c in schemas.OFFERS_IN.split(", ")]
    (tmp_path / "o.csv").write_text(",".join(names) + "\n" + "5" + "," * (len(names) - 1) + "\n")
    root = f"{tmp_path}/offers"
    spark.sql(f"create table offers_in ({schemas.OFFERS_IN}, id_oferta_int long, month string, day string, day_hour string) "
              f"using parquet partitioned by (month, day, day_hour) location '{root}'")
    try:
        for hours in (0, 1):
            jobs.load_offers(spark, f"{tmp_path}/o.csv", root, RUN + dt.timedelta(hours=hours), table="offers_in")
        assert spark.table("offers_in").count() == 2
    finally:
        spark.sql("drop table offers_in")
