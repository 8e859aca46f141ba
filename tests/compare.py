"""Row-by-row comparison of a Spark query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple((type(v).__name__, v) for v in (normal(row[i]) for i in order)) for row in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql):
    result = con.execute(sql)
    return bag([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both sides give the same columns and the same bag of rows."""
    (names, got), (expected_names, expected) = spark_bag(df), duck_bag(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if got != expected:
        return f"{sum(got.values())} rows vs {sum(expected.values())}; only Spark {list((got - expected).items())[:2]}; " \
               f"only SQL {list((expected - got).items())[:2]}"
    if not got:
        return "no rows on either side"
    return None
