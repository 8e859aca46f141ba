"""Delivered files: headers may differ from file to file, and rows may be torn or hold what the schema cannot take.

Files are united by column name, and no row is lost: what the declared schema takes is in one frame, everything else,
as it came and with the reason, in another.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import clean_name, lenient, quoted, read_ddl

TORN = "_torn"
REFUSED = "file_name string, reason string, record string"


@dataclass(frozen=True)
class Delivery:
    """``rows`` in the declared schema, and ``file_name``; ``refused`` rows as they came."""

    rows: DataFrame
    refused: DataFrame


def headers(spark: SparkSession, path: str | list[str], name_glob: str | None = None) -> dict[str, list[str]]:
    """Header line -> files that begin with it. One pass over the lines, in which a file gives one row to a shuffle.

    The driver holds a row per file, as it does when it lists them. Empty files have no header.
    """
    reader = spark.read.option("pathGlobFilter", name_glob) if name_glob else spark.read
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                     F.monotonically_increasing_id().alias("line"))
    # Within the first block of a file, ids rise from line to line.
    firsts = lines.where("at = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    found = defaultdict(list)
    for row in firsts.collect():
        found[row["header"].removeprefix("\ufeff").rstrip("\r")].append(row["file"])
    return {header: sorted(files) for header, files in sorted(found.items())}


def header_names(header: str, sep: str) -> list[str]:
    names = [clean_name(name.strip()).lower() for name in next(csv.reader([header], delimiter=sep))]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"a header names columns twice: {twice}")
    return names


def read_delivery(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    sep: str = ",",
    name_glob: str | None = None,
    required: tuple[str, ...] = (),
    strict: bool = True,
) -> Delivery:
    """Delimited files with headers of their own, in the declared schema.

    Columns are found by name (blanks and brackets as underscores, letters in either case), wherever they stand; one
    that a file does not have is NULL, others are not taken over. A row is refused if it has more or fewer fields than
    its file's header ("torn"), if a text does not fit its column's type ("type: <columns>"), or if a ``required`` column
    is empty or missing ("empty: <columns>"). A refused row stands in ``refused`` as it came, the first reason counting.
    Without ``strict`` no row is refused: what does not fit, or is not there, is NULL.
    No files, or only empty ones, give no rows; a header that names a column twice is an error.

    Files of one header are read by one scan; their number, and with it the plan, grows with the different headers
    only. Reading ``rows`` and ``refused`` takes a pass each; stage the source first where that costs too much.
    """
    target = read_ddl(schema)
    frames = [parsed(spark, files, header_names(header, sep), target, sep, required) for header, files in headers(spark, path, name_glob).items()]
    if not frames:
        return Delivery(spark.createDataFrame([], T.StructType([*target.fields, T.StructField("file_name", T.StringType())])),
                        spark.createDataFrame([], REFUSED))
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    if not strict:
        whole = whole.withColumn("reason", F.lit(None).cast("string"))
    taken = [F.col("taken").getField(f.name).alias(f.name) for f in target.fields]
    return Delivery(whole.where("reason IS NULL").select(*taken, "file_name"),
                    whole.where("reason IS NOT NULL").select("file_name", "reason", "record"))


def parsed(spark: SparkSession, files: list[str], names: list[str], target: T.StructType, sep: str, required: tuple[str, ...]) -> DataFrame:
    """(taken, file_name, reason, record) of files that share a header."""
    raw = T.StructType([T.StructField(name or f"_c{i}", T.StringType()) for i, name in enumerate(names)])
    with_torn = T.StructType([*raw.fields, T.StructField(TORN, T.StringType())])
    reader = spark.read.schema(with_torn).option("header", True).option("sep", sep).option("enforceSchema", True)
    # a pruned scan would not count the fields of a row
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", TORN).option("columnPruning", False)
    lines = reader.csv(files).withColumn("file_name", F.col("_metadata.file_name"))

    have = set(raw.names)
    values = {f.name: lenient(quoted(f.name.lower()), T.StringType(), f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)
              for f in target.fields}
    unfit = [F.when(quoted(f.name.lower()).isNotNull() & values[f.name].isNull(), F.lit(f.name)) for f in target.fields if f.name.lower() in have]
    empty = [F.when(values[name].isNull(), F.lit(name)) for name in required]
    listed = lambda kind, found: F.when(F.concat_ws(",", *found) != "", F.concat(F.lit(f"{kind}: "), F.concat_ws(",", *found)))
    reason = F.coalesce(F.when(F.col(TORN).isNotNull(), "torn"), listed("type", unfit), listed("empty", empty))
    record = F.coalesce(F.col(TORN), F.to_csv(F.struct(*[quoted(n) for n in raw.names]), {"sep": sep}))
    return lines.select(F.struct(*[v.alias(n) for n, v in values.items()]).alias("taken"), "file_name", reason.alias("reason"), record.alias("record"))
