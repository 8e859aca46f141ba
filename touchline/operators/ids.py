"""Dense surrogate ids that continue an existing sequence, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import stage, staged

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the partition below


def last_id(df: DataFrame, column: str) -> int:
    """The greatest id so far; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("last")).first()["last"]


def dense_ids(df: DataFrame, order: Sequence[str], id_column: str, start: int = 0) -> DataFrame:
    """Append ``start+1, start+2, …`` in the order of ``order``, then of the other columns.

    The rows are staged with their arrival position, range-partitioned and sorted; the position also splits a
    group of exact copies, which no column could. A second staged copy fixes partition and row number; the
    partition sizes (one number per shuffle partition) then give the offsets.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in order]
    with staged(df.withColumn("_arrival", F.monotonically_increasing_id())) as arrived:
        sort_keys = [*[F.col(c) for c in [*order, *rest]], F.col("_arrival")]
        placed = stage(
            arrived.repartitionByRange(*sort_keys)
            .sortWithinPartitions(*sort_keys)
            .drop("_arrival")
            .withColumn("_place", F.monotonically_increasing_id())
        )
    block = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_rows")).orderBy("_block").collect()
    before = accumulate((row["_rows"] for row in sizes), initial=start)
    offsets = spark.createDataFrame(
        [(row["_block"], offset) for row, offset in zip(sizes, before)], "_block long, _offset long"
    )
    row_number = F.col("_place") - F.shiftleft(block, _ROW_BITS) + 1
    return (
        placed.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")  # one row per shuffle partition
        .select(*df.columns, (F.col("_offset") + row_number).alias(id_column))
    )
