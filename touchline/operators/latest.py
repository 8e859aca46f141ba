"""Latest and first row per key, as aggregates.

The greatest or least row is combined on the map side, so a key with a third of all rows ships one row per task; a
ranking window would sort that whole group in one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.joins import spread_join


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], best: Callable[[Column], Column]) -> DataFrame:
    ranked = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    picked = df.groupBy(*keys).agg(best(F.struct(*ranked)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, one per key; the other columns decide between equals."""
    return _pick(df, list(keys), list(order), F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` per key, one per key; the other columns decide between equals."""
    return _pick(df, list(keys), list(order), F.min)


def latest_with_ties(
    df: DataFrame, keys: Sequence[str], order: str, by: Sequence[str] | None = None, hot: dict | None = None
) -> DataFrame:
    """Every row that has the greatest ``order`` of its key; ``by`` and ``hot`` as in :func:`spread_join`."""
    keys = list(keys)
    newest = df.groupBy(*keys).agg(F.max(order).alias(order))
    return spread_join(df, newest, [*keys, order], "left_semi", by=by or keys, hot=hot)
