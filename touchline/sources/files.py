"""Delimited and JSON file sources. Each call reads any number of files in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import clean_header, read_ddl


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    infer: bool = False,
    schema: str | T.StructType | None = None,
    name_glob: str | None = None,
    with_name: bool = False,
) -> DataFrame:
    """Delimited files with a header; all columns are text unless ``infer`` or ``schema`` says otherwise.

    ``name_glob`` selects files by name (``*20230817*.csv``). ``with_name`` appends ``file_name``.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if infer:
        reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(read_ddl(schema))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    df = reader.csv(path)
    return df.select("*", F.col("_metadata.file_name").alias("file_name")) if with_name else df


def read_export(spark: SparkSession, path: str | list[str], with_name: bool = False) -> DataFrame:
    """A semicolon export with free-text headers: inferred types, cleaned names."""
    return clean_header(read_csv(spark, path, sep=";", infer=True, with_name=with_name))


def read_pages(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """All landed pages of a paged result, one JSON object per line, as one frame."""
    return spark.read.schema(read_ddl(schema)).json(path)
