import datetime as dt

from tests.conftest import rows_of
from touchline.operators.attribution import attribute_conversions, typed_conversions
from touchline.schemas import CONVERSIONS

H = ("id int, account_id string, channel string, campaign_name string, contact_dt timestamp, conv_flg boolean, "
     "conv_use_case_cat string, order_id string, conversion_dt string, conversion_type string")
T0 = dt.datetime(2024, 1, 1, 12)


def row(id, account="A", channel="email", campaign="offer upsell", contact=T0, flag=None, old=(None,) * 4):
    return (id, account, channel, campaign, contact, flag, *old)


def conv(frame, *rows):
    day = lambda n: str(int((T0 + dt.timedelta(days=n)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
    return typed_conversions(frame(CONVERSIONS, *[(a, use, o, day(n) if isinstance(n, int) else n, "web")
                                                  for a, use, o, n in rows]))


def flags(df):
    return {r.id: r.conv_flg for r in df.collect()}


def test_time_as_text(frame):
    assert rows_of(conv(frame, ("A", "u", "o", 0), ("B", "u", "o", "junk")), "account_id", "conversion_dt") == [
        ("A", "2024-01-01 12:00:00"), ("B", None)]


def test_window_campaign_and_best_channel(frame):
    history = frame(H, row(1), row(2, campaign="other"), row(3, channel="WhatsApp"), row(4, account="B", channel="WhatsApp"),
                    row(5, account="C", contact=T0 + dt.timedelta(days=4)), row(6, account="D", contact=T0 - dt.timedelta(days=12)))
    conversions = conv(frame, ("A", "upsell", "1", 3), ("B", "upsell", "2", 14), ("C", "upsell", "3", 3), ("D", "upsell", "4", 3))
    assert flags(attribute_conversions(history, conversions)) == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}


def test_three_values(frame):
    history = frame(H, row(1, account="none"), row(2, channel="fax"), row(3, account="B", campaign=None),
                    row(4, account="C", contact=None), row(5, account=None), row(6, account="D", campaign="other", contact=None))
    conversions = conv(frame, ("A", "upsell", "1", 1), ("B", "upsell", "2", 1), ("C", "upsell", "3", 1), ("D", "upsell", "4", 1))
    # an unlisted channel has no weight; no conversion, campaign, contact date or account leaves the flag open,
    # unless another condition already says no
    assert flags(attribute_conversions(history, conversions)) == {1: None, 2: None, 3: None, 4: None, 5: None, 6: False}


def test_converted_rows_stay_and_still_set_the_best_channel(frame):
    old = ("kept", "77", "2023-01-01 00:00:00", "old")
    history = frame(H, row(1, flag=True, old=old), row(2, channel="Outbound_call", flag=False, old=old))
    got = attribute_conversions(history, conv(frame, ("A", "upsell", "1", 1)))
    assert rows_of(got.where("id = 1")) == [row(1, flag=True, old=old)]
    assert rows_of(got.where("id = 2"), "conv_flg", "order_id", "conversion_type") == [(False, "1", "web")]


def test_both_spellings_of_the_call_channel(frame):
    history = frame(H, row(1, account="A", channel="Outbound call"), row(2, account="B", channel="Outbound_call"),
                    row(3, account="C", channel="CALLCENTER"))
    got = attribute_conversions(history, conv(frame, *[(a, "upsell", a, 0) for a in "ABC"]))
    assert flags(got) == {1: True, 2: True, 3: True}


def test_a_row_per_conversion(frame):
    got = attribute_conversions(frame(H, row(1)), conv(frame, ("A", "upsell", "1", 1), ("A", "else", "2", 1)))
    assert rows_of(got, "id", "order_id", "conv_flg") == [(1, "1", True), (1, "2", False)]


def test_next_run_takes_open_and_false_flags_again(frame):
    history = frame(H, row(1), row(2, account="B", flag=False))
    first = attribute_conversions(history, conv(frame, ("B", "nothing", "9", 1)))
    assert flags(first) == {1: None, 2: False}
    second = attribute_conversions(first, conv(frame, ("A", "upsell", "1", 1), ("B", "upsell", "2", 2)))
    assert flags(second) == {1: True, 2: True}
