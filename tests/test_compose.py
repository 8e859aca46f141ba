import datetime as dt

from tests.conftest import rows_of
from touchline import schemas
from touchline.operators import audience, compose, feeds, offers

DAY = dt.date(2024, 1, 5)
T0 = dt.datetime(2024, 1, 5, 10)
RUN = dt.datetime(2024, 1, 5, 1, 2, 3)
SEND = "contact_id long, campaign_id long, event_time timestamp, launch_id long, reason string"
OFFER = "sub_acct_no string, offer_type string, channel string, use_case string, date string, id_oferta_int long, regime string, day string"


def offer(number, id, date="2024-01-2", use="up", kind="single", channel="email", day="20240102"):
    return (number, kind, channel, use, date, id, "r", day)


def composed(frame, sends, cancels=(), offered=(), links=(), campaigns=(), programs=(("5", "autumn_TAG_x"),), ids=None):
    return compose.compose_day(
        frame(SEND, *sends), frame(SEND, *cancels),
        frame("user_id long, account_id string", *(ids or [(1, "ACC_11"), (1, "ACC_11"), (2, None)])),
        frame(OFFER, *offered),
        frame("id_oferta_int long, link string, link_generated_dt date, link_expiration_dt date", *links),
        frame("id long, name string, program_id long, event_time timestamp", *campaigns),
        frame("id string, name string", *programs), DAY, "ACC_", offers_since="20230817",
    )


def test_row_per_status_and_lookup(frame):
    got = composed(frame, [(1, 7, T0, 1, None), (1, 7, T0, 1, None), (2, 7, T0, 1, None), (None, 7, T0, 1, None),
                           (1, 7, T0 - dt.timedelta(days=1), 1, None)], cancels=[(1, 7, T0, 1, "why")],
                   campaigns=[(7, "n", 4, T0 - dt.timedelta(1)), (7, "n", 5, T0)])
    assert got.columns == [f.split(" ")[0] for f in schemas.HISTORY.split(", ")]
    assert rows_of(got, "account_id", "sub_acct_no_sbb", "contact_id", "sent_dt", "cancel_dt", "cancel_reason",
                   "campaign_name", "program_id", "month", "day", "channel") == sorted([
        ("ACC_11", "11", 1, T0, None, None, "autumn_TAG_x", 5, "202401", "20240105", "email"),
        ("ACC_11", "11", 1, None, T0, "why", "autumn_TAG_x", 5, "202401", "20240105", "email"),
        (None, None, 2, T0, None, None, "autumn_TAG_x", 5, "202401", "20240105", "email")], key=repr)


def test_newest_offers_by_date_not_by_text(frame):
    offered = [offer("11", 1, "2024-01-2"), offer("11", 2, "2023-12-31"), offer("11", 3, "2024-01-10"),
               offer("11", 4, use="down"), offer("11", 5, use="down"), offer("11", 6, use="sms", channel="sms"),
               offer("11", 7, use="old", day="20230817"), offer("11", 8, use="multi", kind="multi"),
               offer("12", 9)]
    links = [(1, "a", dt.date(2024, 1, 1), None), (1, "b", dt.date(2024, 1, 2), None), (4, "c", None, None)]
    got = composed(frame, [(1, 7, T0, 1, None)], offered=offered, links=links)
    # the same newest date keeps both offers of a use case; the newest link of an offer wins
    assert rows_of(got, "use_case", "id_oferta_int", "rec_date", "link") == [
        ("down", 4, dt.date(2024, 1, 2), "c"), ("down", 5, dt.date(2024, 1, 2), None), ("up", 1, dt.date(2024, 1, 2), "b")]


def test_simple_history_keeps_every_event(frame):
    event = (1, 7, T0, 3, None)
    got = compose.compose_simple(
        frame(SEND, event, event), frame(SEND, event), frame(SEND, (2, 8, T0, 3, None), (None, 7, T0, 3, None)),
        frame("id long, name string, event_time timestamp", (7, "old", T0), (7, "new", T0 + dt.timedelta(1)),
              (7, "newer", T0 + dt.timedelta(1))), DAY)
    assert rows_of(got, "contact_id", "campaign_name") == [(1, "newer")] * 3 + [(2, None)]


def test_attempts(frame):
    d = lambda n: n and dt.date(2024, 1, n)
    ok = compose.CONTACTED_DISPOSITIONS[0]
    call = lambda a, x, y, z, why=ok: (a, int(a[1:]), d(x), d(y), d(z), why)
    calls = frame("account_id string, cuenta int, Intento_discado_1 date, Intento_discado_2 date, Intento_discado_3 date, "
                  "Disposicion string", call("a1", 1, None, None), call("a2", 1, 2, 3), call("a3", 2, 2, 2),
                  call("a4", 1, None, 3), call("a5", 3, 1, 1, "busy"), call("a6", None, 2, 3), call("a7", 1, 2, 3, None),
                  call("a1", 1, None, None))
    got = rows_of(compose.attempts_to_communications(calls, "c"), "account_id", "comm_dt", "contact_dt")
    assert got == sorted([
        ("a1", d(1), d(1)),
        ("a2", d(1), None), ("a2", d(2), None), ("a2", d(3), d(3)),
        ("a3", d(2), d(2)),
        ("a4", d(1), None),
        ("a5", d(3), None), ("a5", d(1), None),
        ("a6", d(3), d(3)),
        ("a7", d(1), None), ("a7", d(2), None), ("a7", d(3), None)], key=repr)
    history = compose.call_rows(compose.attempts_to_communications(calls, "c"))
    assert rows_of(history.where("account_id = 'a1'"), "sub_acct_no_sbb", "month", "day", "channel", "conv_flg") == [
        ("1", "202401", "20240101", "Outbound_call", False)]


def test_audience_once_per_account_and_campaign(frame):
    got = compose.audience_to_communications(
        frame("n long, campaign_name string", (1, "c"), (1, "c"), (1, "d")), DAY, "ACC_", "n")
    assert rows_of(got, "account_id", "campaign_name", "comm_dt", "day") == [
        ("ACC_1", "c", DAY, "20240105"), ("ACC_1", "d", DAY, "20240105")]


def test_feed_of_allowed_programs(frame):
    programs = feeds.tagged_programs(frame("id string, name string", ("5", "a_TAG_b"), ("6", "aTAGb")), "_TAG")
    assert rows_of(programs) == [(5, "a_TAG_b")]
    campaigns = frame("id long, program_id long, event_time timestamp", (7, 5, T0), (7, 6, T0), (8, 6, T0))
    ids = feeds.program_campaigns(campaigns, programs)
    events = frame("contact_id long, campaign_id string, event_time timestamp",
                   (1, "7", T0), (None, "7", T0), (1, "8", T0), (1, "x", T0), (1, "7", T0 - dt.timedelta(days=1)))
    got = feeds.event_feed("clicks", events, DAY, ids)
    assert len(got.columns) == 29 and rows_of(got, "contact_id", "campaign_id", "day") == [(1, "7", "20240105")]
    assert feeds.event_feed("clicks", events, DAY).count() == 3
    assert feeds.event_feed("clicks", events, DAY, ids, days=2).count() == 2
    wanted = programs.selectExpr("id as program_id")
    assert rows_of(feeds.event_feed("campaigns", campaigns, DAY, program_ids=wanted), "id", "program_id") == [(7, 5)]


def test_paged_contacts(frame):
    pages = frame("id string, `864` string", ("1", "ACC_1"), ("1", "ACC_1"), ("2", "ACCX1"), ("3", None))
    assert rows_of(feeds.paged_contacts(pages, "864", "ACC_")) == [("1", "ACC_1")]


def test_base_audience_once_per_account(frame):
    accounts = frame("k long, other int", (1, 1), (1, 2), (2, 1), (None, 1))
    winback = frame("k string", ("2",), ("x9",))
    got = audience.base_audience(accounts, "k", "ACC_", {"mkt": "FIXED"}, winback)
    assert rows_of(got) == [("ACC_1", "FIXED"), ("ACC_2", "FIXED"), ("ACC_x9", "FIXED"), (None, "FIXED")]


def test_contact_ids_prefix_is_literal(frame):
    raw = frame("`user id` string, acct string", ("1", "ACC_1"), ("2", "ACCX2"), ("x", "ACC_3"), ("4", None))
    assert rows_of(audience.contact_ids(raw, "user_id", "acct", "ACC_", RUN)) == [
        (1, "ACC_1", "20240105"), (None, "ACC_3", "20240105")]


def test_links_out_takes_the_newest_batch(frame):
    offered = frame("SUB_ACCT_NO_SBB string, id_oferta_int long, day string, day_hour string",
                    ("1", 10, "20240105", "20240105080000"), ("1", 11, "20240105", "20240105090000"),
                    ("1", 12, "20240105", "20240105090000"), ("1", 13, "20240104", "20240104090000"),
                    ("x", 14, "20240105", "20240105090000"))
    links = offers.typed_links(frame("SUB_ACCT_NO string, LINK string, CREATED_DATETIME string, LINK_EXPIRATION_DT string",
                                     ("1", "u", "1/5/2024 3:04:05 PM", "2024-02-01"), ("2", "v", "1/5/2024 3:04:05 PM", None)))
    got = offers.offers_links_out(offered, links, RUN)
    assert rows_of(got) == [("1", "u", dt.date(2024, 1, 5), dt.date(2024, 2, 1), 12, "202401", "20240105", "20240105010203")]


def test_number_format_of_the_reward(frame):
    row = frame(", ".join(f"{c} double" if c == "REWARD" else f"{c} string" for c in offers.PACKAGE_COLUMNS),
                tuple(1234.5 if c == "REWARD" else "x" for c in offers.PACKAGE_COLUMNS))
    assert rows_of(offers.packages_handoff(row), "REWARD") == [("1,234.500000000000000",)]
