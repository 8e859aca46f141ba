"""Facts carried by file names, as column expressions, so many files are handled in one scan."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates as they appear in file names, with and without separators.
DASHED_DATE = r"\d{4}\D+\d{2}\D+\d{2}"
COMPACT_DATE = r"\d{8}"


def dashed_date(name: Column) -> Column:
    """``yyyyMMdd`` from a name like ``x_2023-08-17.csv``; NULL when there is none."""
    return F.regexp_replace(F.regexp_substr(name, F.lit(DASHED_DATE)), r"\D", "")


def compact_date(name: Column) -> Column:
    """``yyyyMMdd`` from a name like ``x_20230817.csv``; NULL when there is none."""
    return F.regexp_substr(name, F.lit(COMPACT_DATE))


def campaign_of_export(name: Column, channel: str, skip: int = 5) -> Column:
    """The text between a lead of ``skip`` characters and ``_<channel>``; empty when the mark is missing."""
    return F.regexp_extract(name, f"^.{{{skip}}}(.*?)_{re.escape(channel)}", 1)


def mask_of_export(name: Column) -> Column:
    """The name up to and with the underscore before ``export``; empty when there is none."""
    return F.regexp_extract(name, "^(.*?_)export", 1)


def between_marks(name: Column, lead: str, tail: str = ".csv") -> Column:
    """The name without a known lead and extension."""
    return F.replace(F.replace(name, F.lit(lead), F.lit("")), F.lit(tail), F.lit(""))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)$", 1)
