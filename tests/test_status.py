import datetime as dt
import random

import pytest

from tests.conftest import rows_of
from touchline.operators import status

H = ("account_id string, contact_id long, campaign_id long, comm_dt date, channel string, open_dt timestamp, "
     "contact_dt timestamp, click_dt timestamp, clicks_count int, bounce_dt timestamp, bounce_type string, "
     "dsn_reason string")
E = "contact_id long, campaign_id string, email_sent_at timestamp, event_time timestamp"
B = E + ", bounce_type string, dsn_reason string"
D0 = dt.date(2024, 1, 1)


def at(day, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day)


def row(contact=1, campaign=1, day=0, channel="email", open_dt=None, contact_dt=None, click_dt=None, clicks=None,
        bounce_dt=None, bounce_type=None, reason=None, account="A"):
    return (account, contact, campaign, D0 + dt.timedelta(day), channel, open_dt, contact_dt, click_dt, clicks, bounce_dt,
            bounce_type, reason)


def test_first_open_within_the_window(frame):
    history = frame(H, row(1), row(2), row(3), row(4))
    opens = frame(E, (1, "1", at(0, 9), at(3)), (1, "1", at(0, 15), at(2)), (2, "1", at(0), at(14, 23)),
                  (3, "1", at(0), at(15)), (4, "x", at(0), at(1)))
    got = status.apply_first_open(history, opens).select("contact_id", "open_dt", "contact_dt")
    # both opens of contact 1 answer the same message though the sent time differs within the day
    assert rows_of(got) == [(1, at(2), at(2)), (2, at(14, 23), at(14, 23)), (3, None, None), (4, None, None)]


def test_event_before_the_send_counts_unless_bounded(frame):
    history, opens = frame(H, row(1)), frame(E, (1, "1", at(0, 9), at(-1)))
    assert rows_of(status.apply_first_open(history, opens), "open_dt") == [(at(-1),)]
    assert rows_of(status.apply_first_open(history, opens, least=0), "open_dt") == [(None,)]


def test_dates_kept_counts_refreshed(frame):
    history = frame(H, row(1, open_dt=at(1), contact_dt=at(1), click_dt=at(1), clicks=9, bounce_dt=at(1),
                           bounce_type="old", reason="old"), row(2, clicks=4, bounce_type="kept"))
    event = (1, "1", at(0), at(2))
    got = status.apply_status(history, frame(E, event), frame(E, event, event), frame(B, (*event, "hard", None)))
    assert rows_of(got) == rows_of(frame(H, row(1, open_dt=at(1), contact_dt=at(1), click_dt=at(1), clicks=2,
                                                bounce_dt=at(1), bounce_type="hard"), row(2, clicks=4, bounce_type="kept")))


def test_contact_date_left_alone_on_demand(frame):
    got = status.apply_first_open(frame(H, row(1)), frame(E, (1, "1", at(0), at(2))), open_is_contact=False)
    assert rows_of(got, "open_dt", "contact_dt") == [(at(2), None)]


def test_first_bounce_gives_its_own_reason(frame):
    bounces = frame(B, (1, "1", at(0), at(3), "soft", "late"), (1, "1", at(0), at(2), "hard", "first"))
    got = status.apply_first_bounce(frame(H, row(1)), bounces)
    assert rows_of(got, "bounce_dt", "bounce_type", "dsn_reason") == [(at(2), "hard", "first")]


def test_click_count_does_not_grow_with_the_history(frame):
    history = frame(H, row(1), row(1, day=5), row(1, channel="Outbound_call"))
    clicks = frame(E, (1, "1", at(0), at(1)), (1, "1", at(0), at(2)), (1, "1", at(5), at(6)))
    got = status.apply_clicks(history, clicks)
    assert rows_of(got, "channel", "comm_dt", "clicks_count") == [
        ("Outbound_call", D0, None), ("email", D0, 2), ("email", D0 + dt.timedelta(5), 1)]
    assert got.columns == history.columns


@pytest.mark.parametrize("seed", [1, 2])
def test_twice_is_once_and_rows_stay(frame, seed):
    rng = random.Random(seed)
    pick = lambda n: rng.choice([None, *range(n)])
    history = frame(H, *[row(pick(4), pick(3), rng.randrange(3), rng.choice(["email", "call"])) for _ in range(60)])
    event = lambda: (pick(4), str(pick(3)), at(rng.randrange(3)), at(rng.randrange(20), rng.randrange(24)))
    opens, clicks = frame(E, *[event() for _ in range(50)]), frame(E, *[event() for _ in range(50)])
    bounces = frame(B, *[(*event(), rng.choice(["a", "b"]), rng.choice(["x", None])) for _ in range(50)])
    once = status.apply_status(history, opens, clicks, bounces)
    assert rows_of(status.apply_status(once, opens, clicks, bounces)) == rows_of(once)
    keys = ["contact_id", "campaign_id", "comm_dt", "channel"]
    assert rows_of(once, *keys) == rows_of(history, *keys)


def test_call_contact_on_the_day_of_the_first_reaching_call(frame):
    history = frame(H, row(account="A"), row(account="A", day=1), row(account="B", contact_dt=at(9)), row(account="C"))
    calls = frame("account_id string, Intento_discado_1 date, Disposicion string",
                  ("A", D0, "x OFITi- Cliente acepta oferta y"), ("A", D0 + dt.timedelta(1), "Cliente no acepta ninguna oferta"),
                  ("B", D0, "Cliente no acepta ninguna oferta"), ("C", D0, "busy"), ("C", None, "Cliente no acepta ninguna oferta"))
    got = status.apply_call_contact(history, calls)
    assert rows_of(got, "account_id", "comm_dt", "contact_dt") == [
        ("A", D0, at(0)), ("A", D0 + dt.timedelta(1), None), ("B", D0, at(9)), ("C", D0, None)]
