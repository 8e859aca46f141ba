"""Table scans. Filters are plain predicates, so partition keys prune and the rest reaches the scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import conform, read_ddl


def scan(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table or view by name, or a parquet folder by path."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def slice_eq(df: DataFrame, **keys: object) -> DataFrame:
    """Rows whose columns equal the given values; several keys make a composite slice."""
    for name, value in keys.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def slice_from(df: DataFrame, key: str, value: object, inclusive: bool = True) -> DataFrame:
    """Open range: ``key >= value``, or ``key > value``."""
    return df.where(F.col(key) >= F.lit(value) if inclusive else F.col(key) > F.lit(value))


def slice_between(df: DataFrame, key: str, low: object, high: object) -> DataFrame:
    return df.where(F.col(key).between(F.lit(low), F.lit(high)))


def from_sql(spark: SparkSession, sql: str, schema: str | T.StructType, **args: object) -> DataFrame:
    """The result of a query over tables and views, in a declared schema; ``:name`` in it stands for an argument."""
    return conform(spark.sql(sql, args=args), schema)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from rows the caller wrote down, such as a program list."""
    return spark.createDataFrame(list(rows), schema)


def optional(read: Callable[[], DataFrame], schema: str | T.StructType, spark: SparkSession) -> DataFrame:
    """``read()`` if its path exists, else no rows of ``schema``. Any other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], read_ddl(schema))


def file_or_slice(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    keys: dict[str, object] | None = None,
    read: Callable[[SparkSession, str], DataFrame] | None = None,
) -> DataFrame:
    """The arriving file when ``path`` is given, else the stored slice ``keys`` of ``table``; else an error."""
    if path and read:
        return read(spark, path)
    if table and keys:
        return slice_eq(scan(spark, table), **keys)
    raise ValueError("give either path and read, or table and keys")
