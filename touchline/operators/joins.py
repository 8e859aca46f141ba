"""Joins that stay balanced when one key, or NULL, holds a large part of a side.

Adaptive execution splits a skewed join partition only when both sides come straight from a shuffle. Here the
right side is mostly an aggregate on the join key, which hides its shuffle, so the split is made explicit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import quoted

HOT_PARTITIONS = 3       # a key is hot that alone fills so many shuffle partitions of mean size
MOST_HOT = 6_667         # at most so many keys are looked for, which the size of the sketch allows
HOT_ROWS = 1_000_000     # smaller groups are never worth splitting
TASK_ROWS = 250_000      # a left side of more than HOT_ROWS rows is cut so that a task gets about so many at most
BROADCAST_ROWS = 50_000  # most rows a side may have to be broadcast by hint
BROADCAST_BYTES = 16 << 20  # and most bytes, as text
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_MERGERS = 256           # tasks that merge the sketches of the scan tasks
NO_KEY = 0               # stands for a key with a NULL in it


def key_kind(df: DataFrame, key: str) -> str:
    kind = df.schema[key].dataType
    return "whole number" if isinstance(kind, WHOLE) else kind.simpleString()


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """One number per key, the same for whole numbers of any width; a key with a NULL has the number 0."""
    parts = [quoted(k).cast("long") if isinstance(df.schema[k].dataType, WHOLE) else quoted(k) for k in keys]
    known = parts[0].isNotNull()
    for part in parts[1:]:
        known = known & part.isNotNull()
    return F.when(known, F.xxhash64(*parts)).otherwise(F.lit(NO_KEY).cast("long"))


def hot_share(spark: SparkSession) -> float:
    """The share of the rows above which a key is hot: it follows the number of shuffle partitions."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(HOT_PARTITIONS / parts, 1 / 2), 1 / MOST_HOT)


class Hot(dict[int, float]):
    """Hashes of hot keys with their shares; ``rows`` is the number of all rows, 0 if it is small or not known."""

    rows = 0


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float | None = None, min_rows: int = HOT_ROWS
) -> Hot:
    """Hashes of the keys that hold more than ``share`` of the rows, each with its share; see :func:`hot_share`.

    A sketch of the most frequent keys per scan task, merged by a few tasks: one pass over the key columns and no
    shuffle of them. Counts may be a little off; they only decide how rows are spread. No more than ``1/share``
    keys qualify, so what reaches the driver is bounded whatever the data. The result's ``rows`` is the number of
    all rows, if it is ``min_rows`` or more.
    """
    share = share or hot_share(df.sparkSession)
    most = math.ceil(1 / share)
    merged = (
        df.select(key_hash(df, keys).alias("_key"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("_merger"))
        .agg(F.expr(f"approx_top_k(_key, {2 * most}, {16 * most})").alias("_top"), F.count(F.lit(1)).alias("_all"))
    )
    # the count of all rows rides along as the item NULL
    everything = F.struct(F.lit(None).cast("long").alias("item"), F.col("_all").alias("count"))
    counts = merged.select(F.inline(F.array_append("_top", everything))).groupBy("item").agg(F.sum("count").alias("rows"))
    top = {row["item"]: row["rows"] for row in
           counts.where(F.col("rows") >= min_rows).orderBy(F.desc("rows")).limit(most + 1).collect()}
    total = top.pop(None, 0)
    found = Hot({key: rows / total for key, rows in top.items() if rows > total * share})
    found.rows = total
    return found


def spread_join(
    left: DataFrame,
    right: DataFrame | Sequence[DataFrame],
    on: Sequence[str],
    how: str = "left",
    only_when: Column | None = None,
    by: Sequence[str] | None = None,
    hot: dict[int, float] | None = None,
    hot_right: dict[int, float] | None = None,
    right_repeats: bool = False,
    share: float | None = None,
    min_rows: int = HOT_ROWS,
    task_rows: int | None = None,
) -> DataFrame:
    """Equi-join on the columns ``on`` (present on both sides), with hot keys split; the result is that of a join.

    The rows of a hot key are dealt to as many salts as the key's share of the shuffle partitions, and the other
    side's rows of that key alone are copied to each salt. NULL keys match nothing and are just spread. Salts
    hash the row, so a task that is run again puts every row where it was. Without a hot key this is the plain
    join.

    ``right`` may be several frames, joined in turn on the same keys; the left side is shuffled once for all.
    ``how`` is left, inner, left_semi or left_anti. ``only_when`` is a predicate on the left side that belongs
    to the join condition: rows that fail it stay, unmatched, in a left join.

    ``by`` names the key columns to look for hot values in, where some of ``on`` say enough: a composite key can
    only be hot if each of its parts is. ``right_repeats`` says the (last) right side may hold many rows per key
    and is to be looked at too. ``hot`` and ``hot_right`` give the hot values of a side if the caller has them;
    they decide how rows are dealt, never which rows come out.

    With ``task_rows`` a left side of ``min_rows`` rows or more, as counted with its hot keys, is cut into as many
    partitions as leave a task about so many rows, so that what a task holds does not grow with the table.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    on = list(on)
    by = on if by is None else list(by)
    rights = [right] if isinstance(right, DataFrame) else list(right)
    one_sided = how in ("left_semi", "left_anti")
    gate = F.lit(True) if only_when is None else F.coalesce(only_when, F.lit(False))
    for r in rights:
        for k in by:
            if key_kind(left, k) != key_kind(r, k):
                raise TypeError(f"key {k} is {key_kind(left, k)} on the left, {key_kind(r, k)} on the right")
    kept = [*left.columns, *([] if one_sided else [c for r in rights for c in r.columns if c not in on])]
    joins = [f"_on_{k}" for k in on]
    hot_left = hot_keys(left, by, share, min_rows) if hot is None else hot
    if one_sided or not right_repeats:
        hot_right = {}
    elif hot_right is None:
        hot_right = hot_keys(rights[-1].dropna(subset=by), by, share, min_rows)

    if not hot_left and not hot_right:
        # The predicate is part of the condition, not of the key: rows that fail it stay where their keys put them.
        keyed = left if only_when is None else left.withColumn("_gate", gate)
        if task_rows and (rows := getattr(hot_left, "rows", 0)):
            parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            keyed = keyed.repartition(max(parts, math.ceil(rows / task_rows)), *map(quoted, on))
        for i, r in enumerate(rights):
            keys = [f"_on{i}_{k}" for k in on]
            same = [quoted(k) == quoted(j) for k, j in zip(on, keys)] + [F.col("_gate")] * (only_when is not None)
            keyed = keyed.join(r.withColumnsRenamed(dict(zip(on, keys))), reduce(and_, same), how)
        return keyed.select(*map(quoted, kept))

    if hot_right and len(rights) > 1:
        first = spread_join(left, rights[:-1], on, how, only_when, by, hot_left, {}, False, share, min_rows)
        return spread_join(first, rights[-1], on, how, only_when, by, hot_left, hot_right, True, share, min_rows)

    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def salts(found: dict[int, float], key: int) -> int:
        return max(2, math.ceil(parts * found[key])) if key in found else 1

    tags = left.sparkSession.createDataFrame(
        [(key, salts(hot_left, key), salts(hot_right, key)) for key in {**hot_left, **hot_right} if key != NO_KEY],
        "_key long, _lefts int, _rights int",
    )

    def tagged(df: DataFrame) -> DataFrame:
        # at most 2/share rows, by the way hot_keys selects them
        marked = df.withColumn("_key", key_hash(df, by)).join(F.broadcast(tags), "_key", "left").drop("_key")
        one = F.lit(1)
        return marked.withColumns({"_lefts": F.coalesce("_lefts", one), "_rights": F.coalesce("_rights", one)})

    def dealt(count: str, columns: Sequence[str]) -> Column:
        salt = F.pmod(F.xxhash64(*[quoted(c) for c in columns]), F.col(count).cast("long")).cast("int")
        return F.when(F.col(count) > 1, salt).otherwise(0)

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def copies(df: DataFrame, deal: bool) -> DataFrame:
        salted = tagged(df.dropna(subset=on)).withColumn(
            "_right", dealt("_rights", df.columns) if deal else each("_rights")
        )
        return salted.withColumn("_left", each("_lefts")).drop("_lefts", "_rights").withColumnsRenamed(
            dict(zip(on, joins))
        )

    alone = ~gate | F.expr(" or ".join(f"`{k}` is null" for k in on))
    keyed = (
        tagged(left)
        .withColumns({j: F.when(gate, quoted(k)) for j, k in zip(joins, on)})
        .withColumns({
            "_lefts": F.when(alone, F.lit(parts)).otherwise(F.col("_lefts")),
            "_rights": F.when(alone, F.lit(1)).otherwise(F.col("_rights")),
        })
        .withColumn("_left", dealt("_lefts", left.columns))
        .withColumn("_right", each("_rights"))
    )
    for r in rights:
        last = r is rights[-1]
        side = copies(r, deal=last)
        keyed = keyed.join(side.withColumn("_hit", F.lit(True)) if last else side, [*joins, "_left", "_right"], how)
    if how != "left" or not hot_right:
        return keyed.select(*kept)

    # A left row copied to the salts of a hot right key is unmatched under some of them though it has a match under
    # another. Such rows go, and the copied rows whose whole key is missing on the right come back once.
    matched = keyed.where((F.col("_rights") == 1) | F.col("_hit")).select(*kept)
    copied = tagged(left).where(~alone & (F.col("_rights") > 1)).select(*left.columns)
    present = tagged(rights[0]).where(F.col("_rights") > 1).select(*on).distinct()
    missing = spread_join(copied, present, on, "left_anti", by=by, hot=hot_left)
    return matched.unionByName(missing, allowMissingColumns=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has no more than ``rows`` rows and ``most_bytes`` bytes, else unchanged.

    The count stops at the bound, so it never runs over a large table to the end.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["rows"] <= rows and found["bytes"] <= most_bytes else df


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", probe: DataFrame | None = None
) -> DataFrame:
    """Join to a list that is mostly short, such as campaigns: broadcast if its counted size allows, so that the left
    side stays where it is; :func:`spread_join` beyond that, hot keys being looked for in ``probe``."""
    side = small(right)
    if side is not right:
        return spread_join(left, side, on, how, hot={}, hot_right={})
    return spread_join(left, right, on, how, hot=hot_keys(left if probe is None else probe, on))
