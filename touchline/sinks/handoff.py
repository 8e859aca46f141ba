"""Delimited files handed to partner systems."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, folder: str, drop: Sequence[str] = (), files: int | None = None, sep: str = ",") -> None:
    """A folder of CSV files with header and trimmed text.

    ``files`` is how many files the partner takes at most: 1 always gives one, whatever the size. Without it each
    task writes its own.
    """
    rows = df.drop(*drop)
    if files is not None:
        rows = rows.coalesce(files)
    (
        rows.write.mode("overwrite")
        .option("header", True).option("sep", sep)
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        .csv(folder)
    )


def write_dated_csv(df: DataFrame, folder: str, name: str, run_day: dt.date, **options) -> str:
    """The same under a dated name; returns the folder written."""
    path = f"{folder.rstrip('/')}/{name}_{run_day:%Y_%m_%d}"
    write_csv(df, path, **options)
    return path


def archive_tsv(df: DataFrame, folder: str, upload_date: str) -> None:
    """Tab-separated archive copy with the upload date as last column."""
    stamped = df.select("*", F.lit(upload_date).alias("upload_date"))
    stamped.write.mode("overwrite").option("header", True).option("sep", "\t").csv(folder)
