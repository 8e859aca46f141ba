"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.plans.views import VIEWS_SQL, Tables
from touchline.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(body: str, *views: str) -> str:
    """``body`` with the named views, and ``ev`` that most of them read, as common table expressions."""
    needed = [v for v in VIEWS_SQL if v in views or (v == "ev" and {"feed", "history", "answers"} & set(views))]
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS_SQL[v]})" for v in needed) + "\n" + body.strip()


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the driver tables hold them."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(sql: str | None = None, *views: str, name: str | None = None):
    """Register a function of :class:`Tables`; ``sql`` is its oracle, over the named views."""
    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(pin(spark), folder)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_views(sql, *views)
        return build
    return register
