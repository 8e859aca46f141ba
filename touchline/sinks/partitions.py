"""Partitioned parquet sinks. Each write names its overwrite mode; running one again gives the same table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.session import stage, staged
from touchline.sinks.folders import Folder
from touchline.sources.tables import optional


def balanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gather rows by partition key before a write, letting Spark split large keys into several tasks."""
    return df.hint("rebalance", *keys)


def write_partitions(df: DataFrame, root: str, keys: Sequence[str], gather: bool = True) -> None:
    """Overwrite the partitions that occur in ``df``; the others, and all of them if ``df`` is empty, stay.

    The new files are moved in when all are written, so ``df`` may be read from ``root`` itself. ``gather=False``
    saves the shuffle when ``df`` holds one partition only, as a stamped run does.
    """
    rows = balanced(df, keys) if gather else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)


def _stored(spark: SparkSession, root: str, schema) -> DataFrame:
    return optional(lambda: spark.read.schema(schema).parquet(root), schema, spark)


# Characters Spark escapes in partition folder names.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


def partition_folder(root: str, keys: Sequence[str], values: Sequence[object]) -> str:
    parts = []
    for key, value in zip(keys, values):
        text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else "".join(
            f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value)
        )
        parts.append(f"{key}={text}")
    return "/".join([root.rstrip("/"), *parts])


def replace_where(df: DataFrame, root: str, keys: Sequence[str], where: Column) -> None:
    """Replace what ``where`` (a predicate on the partition keys) selects in ``root`` by ``df``.

    Partitions with new rows are overwritten by one write; selected ones without are removed, however many, without a
    Spark job of their own. The list of selected partitions comes from partition values alone, no data column is read
    for it.
    """
    spark = df.sparkSession
    with guarded(df, outside=~F.coalesce(where, F.lit(False))) as (rows, seen):
        if seen["outside"]:
            raise ValueError("new rows lie outside the range to replace")
        old = _stored(spark, root, df.schema).where(where).select(*keys).distinct().collect()
        _replace(rows, root, list(keys), [tuple(row) for row in old])


def _replace(rows: DataFrame, root: str, keys: list[str], selected: Sequence[tuple]) -> None:
    """Overwrite the partitions of the staged ``rows`` and empty the other ``selected`` ones."""
    fresh = {tuple(row) for row in rows.select(*keys).distinct().collect()}
    write_partitions(rows, root, keys)
    gone = [values for values in selected if values not in fresh]
    if not gone:
        return
    # An empty file goes to the first of them, so that a table left without any row can still be read.
    nothing = rows.sparkSession.createDataFrame([], rows.drop(*keys).schema)
    nothing.write.mode("overwrite").parquet(partition_folder(root, keys, gone[0]))
    folder = Folder(rows.sparkSession, root)
    for values in gone[1:]:
        folder.delete(partition_folder(root, keys, values))


def replace_slice(df: DataFrame, root: str, key: str, value: object) -> None:
    """Replace one slice of a table partitioned by ``key``, also when there are no new rows.

    The slice is one folder, so this is one plain overwrite of it. Rows of another slice, or of none, are refused
    before anything is written.
    """
    with guarded(df, outside=~F.col(key).eqNullSafe(F.lit(value))) as (rows, seen):
        if seen["outside"]:
            raise ValueError(f"new rows lie outside the slice {key} = {value!r}")
        rows.drop(key).write.mode("overwrite").parquet(partition_folder(root, [key], [value]))


def replace_range(df: DataFrame, root: str, key: str, low: object, high: object) -> None:
    replace_where(df, root, [key], F.col(key).between(F.lit(low), F.lit(high)))


def append_batch(df: DataFrame, root: str, keys: Sequence[str], batch: str, batch_key: str = "batch") -> None:
    """Add rows as a named batch: running the same batch again replaces it instead of doubling it."""
    tagged = df.withColumn(batch_key, F.lit(batch))
    replace_where(tagged, root, [*keys, batch_key], F.col(batch_key) == F.lit(batch))


def merge_batch(
    df: DataFrame, root: str, keys: Sequence[str], batch_column: str, batch: str, scope: Column | None = None
) -> None:
    """Add rows to partitions shared with other batches; rows of the same batch from an earlier run give way.

    ``batch_column`` is a column of the table that names the batch; ``scope`` (on the partition keys) bounds where
    its earlier rows are looked for. Only partitions with old or new rows of the batch are rewritten.
    """
    spark = df.sparkSession
    keys = list(keys)
    stored = _stored(spark, root, df.schema)
    earlier = stored.where(F.col(batch_column) == F.lit(batch))
    if scope is not None:
        earlier = earlier.where(scope)
    with staged(df) as new:
        # partition values only, as many as the batch has days
        touched = [tuple(row) for row in earlier.select(*keys).union(new.select(*keys)).distinct().collect()]
        others = _read_partitions(spark, root, keys, df.schema, touched).where(~F.col(batch_column).eqNullSafe(F.lit(batch)))
        with staged(others.unionByName(new)) as rows:
            _replace(rows, root, keys, touched)


def _read_partitions(spark: SparkSession, root: str, keys: Sequence[str], schema, values: Sequence[tuple]) -> DataFrame:
    """The rows of some partitions, read from their folders alone."""
    folder = Folder(spark, root)
    there = [f for f in (partition_folder(root, keys, v) for v in values) if folder.has(f)]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*there)


def append(df: DataFrame, root: str, keys: Sequence[str] = ()) -> None:
    """Plain append; the caller sees to it that a batch comes once."""
    writer = df.write.mode("append")
    (writer.partitionBy(*keys) if keys else writer).parquet(root)


def snapshot(df: DataFrame, root: str) -> None:
    """Replace a whole unpartitioned table."""
    df.write.mode("overwrite").parquet(root)


def publish(df: DataFrame, root: str, keys: Sequence[str], aside: str | None = None) -> DataFrame:
    """Replace a whole partitioned table that ``df`` may itself be read from: write aside, then copy over.

    Returns the copy written to ``aside``, a folder that does not exist yet; the shared folder is used without one.
    If the second write dies, the table is whole in ``aside`` and :func:`restore` brings it back, so a caller that
    must not lose it names the folder. The copy keeps its file layout, so the second write does not shuffle. An empty
    ``df`` leaves the table as it is.
    """
    counted, seen = observed(balanced(df, keys))
    copy = stage(counted, aside)
    if seen.get["rows"]:
        _overwrite(copy, root, keys)
    return copy


def restore(spark: SparkSession, aside: str, root: str, keys: Sequence[str]) -> None:
    """Write the table again from the copy that a broken-off :func:`publish` left."""
    _overwrite(spark.read.parquet(aside), root, keys)


def _overwrite(df: DataFrame, root: str, keys: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(root)


def write_if_rows(df: DataFrame, write) -> bool:
    """Run ``write`` on a copy of ``df`` unless that is empty; says whether it did. ``df`` is computed once, by the copying."""
    with guarded(df) as (rows, seen):
        if seen["rows"]:
            write(rows)
        return bool(seen["rows"])


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and its row count, which is known once the frame has been written: no pass of its own."""
    count = Observation()
    return df.observe(count, F.count(F.lit(1)).alias("rows")), count


@contextmanager
def guarded(df: DataFrame, **facts: Column) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """A staged copy of ``df`` and, counted by the write of it, its ``rows`` and the rows of which each of ``facts`` holds.

    What is decided by these numbers is decided before the target is touched, and ``df`` is computed once.
    """
    seen = Observation()
    counts = [F.count_if(fact).alias(name) for name, fact in facts.items()]
    with staged(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)) as rows:
        yield rows, seen.get


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written by path known to a catalog table over that path."""
    spark.catalog.recoverPartitions(table)
