"""Date and time expressions: tolerant parsing, epoch milliseconds, partition keys."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text forms found in the input files. One-letter fields accept padded and un-padded digits.
DATE_PATTERNS = ("yyyy-M-d", "yyyyMMdd", "M/d/yyyy")
DAY_FIRST_PATTERNS = ("d/M/yyyy", "d-M-yyyy")  # named per column: the text alone does not tell day from month
TIMESTAMP_PATTERNS = ("yyyy-M-d H:m:s", "yyyy-M-d", "yyyyMMdd", "M/d/yyyy h:m:s a", "M/d/yyyy")

RunTime = dt.date | dt.datetime


def form_of(pattern: str) -> str:
    """Regular expression of the texts a date pattern can parse."""
    form = ""
    for run in re.findall(r"y+|M+|d+|H+|h+|m+|s+|a|.", pattern):
        if run == "a":
            form += "(?i:am|pm)"
        elif run[0] in "yMdHhms":
            form += r"\d{1,2}" if len(run) == 1 else rf"\d{{{len(run)}}}"
        else:
            form += re.escape(run)
    return f"^{form}$"


def _try(text: Column, pattern: str) -> Column:
    # a parse that fails throws inside; the form keeps other texts away from it
    return F.when(text.rlike(form_of(pattern)), F.try_to_timestamp(text, F.lit(pattern)))


def parse_date(text: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First pattern that fits; text that fits none becomes NULL (also under ANSI)."""
    return F.to_date(parse_timestamp(text, patterns))


def parse_timestamp(text: Column, patterns: Sequence[str] = TIMESTAMP_PATTERNS) -> Column:
    return F.coalesce(*[_try(text, p) for p in patterns])


def as_timestamp(col: Column, kind: T.DataType, patterns: Sequence[str] = TIMESTAMP_PATTERNS) -> Column:
    """Timestamp from a column of any date-like type; only text is parsed."""
    if isinstance(kind, T.StringType):
        return parse_timestamp(col, patterns)
    return col.cast("timestamp")


def epoch_ms(ts: Column) -> Column:
    """Whole seconds since the epoch, in milliseconds: the sub-second part is dropped."""
    return F.unix_timestamp(ts) * F.lit(1000)


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ms_to_date(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def ms_to_text(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of epoch milliseconds."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def month_key(col: Column) -> Column:
    return F.date_format(col, "yyyyMM")


def day_key(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd")


def within_days(event: Column, start: Column, most: int, least: int | None = None) -> Column:
    """Whole days from ``start`` to ``event`` are at most ``most`` (and at least ``least``, when given)."""
    days = F.datediff(F.to_date(event), F.to_date(start))
    return days <= most if least is None else days.between(least, most)


def on_day(ts: Column, day: dt.date) -> Column:
    """``ts`` falls on ``day``. Catalyst turns it into a timestamp range that reaches the parquet scan."""
    return F.to_date(ts) == F.lit(day)


def trailing_days(col: Column, run_day: dt.date, days: int) -> Column:
    """``col`` (a date) lies in the ``days`` days that end on the run day."""
    return F.to_date(col).between(F.lit(run_day - dt.timedelta(days=days - 1)), F.lit(run_day))


def as_datetime(run: RunTime) -> dt.datetime:
    return run if isinstance(run, dt.datetime) else dt.datetime(run.year, run.month, run.day)
