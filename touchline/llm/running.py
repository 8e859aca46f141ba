"""Running sums over a table sorted across tasks: no group, however large, is gathered in one of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import stage

#: ``place`` holds the task's number above these bits and the row's number in the task below.
PLACE_BITS = 33


def running(df: DataFrame, group: Sequence[str], order: Sequence[Column], add: Sequence[str] = (), xor: Sequence[str] = (),
            before: Sequence[str] = ()) -> DataFrame:
    """``df`` sorted by ``group`` and ``order`` with running values, and ``place``, a long that rises in that order.

    ``group`` and all columns of ``df`` are longs without NULL; ``group`` and ``order`` together should tell rows apart.
    Columns ``add`` and ``xor`` give ``<column>_so_far``: sum, or exclusive or, over the group's rows up to this one.
    Columns ``before`` give ``before_<column>``: the value of the group's row before this one, NULL for the first.

    Rows are range-partitioned, so a hot group takes several tasks. Each task goes through its rows once and holds a
    batch; the result is staged, and the driver sees the last values of each task, one row a task, to carry them on.
    """
    names, carried = df.columns, [*(f"{c}_so_far" for c in (*add, *xor)), *(f"before_{c}" for c in before)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, key, rows, groups = dict.fromkeys(carried), None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = {name: column.to_numpy(zero_copy_only=False) for name, column in zip(names, batch.columns, strict=True)}
            begins = np.zeros(n, bool)
            begins[0] = key is None or any(values[g][0] != k for g, k in zip(group, key))
            for g in group:
                begins[1:] |= values[g][1:] != values[g][:-1]
            goes_on = np.cumsum(begins) == 0  # rows of a group that began before the batch
            head = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
            out = {}
            for c in add:
                total = np.cumsum(values[c])
                out[f"{c}_so_far"] = total - np.where(goes_on, -(held[f"{c}_so_far"] or 0), (total - values[c])[head])
            for c in xor:
                total = np.bitwise_xor.accumulate(values[c])
                out[f"{c}_so_far"] = total ^ np.where(goes_on, held[f"{c}_so_far"] or 0, (total ^ values[c])[head])
            columns = [pa.array(out[c]) for c in out]
            for c in before:
                last = held[f"before_{c}"]
                columns.append(pa.array(np.concatenate([[0 if last is None else last], values[c][:-1]]), mask=begins))
            first = groups + np.cumsum(begins) <= 1
            place = (part << PLACE_BITS) + rows + np.arange(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(place), pa.array(first)], names=[*names, *carried, "place", "of first group"])
            rows, groups, key = rows + n, groups + int(begins.sum()), [values[g][-1] for g in group]
            held = {c: out[c][-1] for c in out} | {f"before_{c}": values[c][-1] for c in before}

    keys = [*(F.col(g) for g in group), *order]
    schema = ", ".join([*(f"`{c}` long" for c in (*names, *carried, "place")), "`of first group` boolean"])
    placed = stage(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(scan, schema))

    part, of = F.shiftright("place", PLACE_BITS).alias("part"), F.struct(F.lit(0).alias("_"), *group)
    ends = placed.groupBy(part).agg(
        F.min_by(of, "place").alias("first"), F.max_by(of, "place").alias("last"),
        F.max_by(F.struct(F.lit(0).alias("_"), *(f"{c}_so_far" for c in (*add, *xor)), *before), "place").alias("values"))
    carries, key, held = [], None, ()
    for row in sorted(ends.collect(), key=lambda r: r["part"]):  # one row a task
        sums, seen = row["values"][1:1 + len(add) + len(xor)], row["values"][1 + len(add) + len(xor):]
        if row["first"] == key:
            carries.append((row["part"], *held))
            if row["first"] == row["last"]:
                sums = tuple(a + b if i < len(add) else a ^ b for i, (a, b) in enumerate(zip(held, sums)))
        key, held = row["last"], (*sums, *seen)
    if not carries:
        return placed.drop("of first group")
    columns = [f"carried {c}" for c in carried]
    table = df.sparkSession.createDataFrame(carries, ", ".join(["part long", *(f"`{c}` long" for c in columns)]))
    whole = placed.withColumn("part", F.shiftright("place", PLACE_BITS)).join(F.broadcast(table), "part", "left")
    applies = F.col("of first group") & F.col(f"`{columns[0]}`").isNotNull()
    told = []
    for i, (c, x) in enumerate(zip(carried, columns)):
        value = F.col(c) + F.col(f"`{x}`") if i < len(add) else F.col(c).bitwiseXOR(F.col(f"`{x}`")) if i < len(add) + len(xor) else F.coalesce(c, F.col(f"`{x}`"))
        told.append(F.when(applies, value).otherwise(F.col(c)).alias(c))
    return whole.select(*names, *told, "place")
