"""File-arrival ingestion: every run handles the files that came since the last one, each once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.columns import quoted, read_ddl
from touchline.functions.names import compact_date
from touchline.sinks.partitions import append_batch


def arriving_csv(
    spark: SparkSession, folder: str, schema: str, sep: str = ",", name_glob: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Stream of the delimited files landing in a folder, with ``file_name``."""
    reader = spark.readStream.schema(read_ddl(schema)).option("header", True).option("sep", sep)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.csv(folder).select("*", F.col("_metadata.file_name").alias("file_name"))


def stamped_by_name(df: DataFrame) -> DataFrame:
    """Month and day keys from the date in the file name, so a replay stamps the same."""
    day = compact_date(F.col("file_name"))
    return df.withColumns({"month": F.substring(day, 1, 6), "day": day})


def once_within(stream: DataFrame, time: str, delay: str, ignore: Sequence[str] = ("file_name",)) -> DataFrame:
    """Rows of a stream, each once however often it is delivered within ``delay`` of event time.

    Rows are the same if all columns but ``ignore`` are, as in a file that comes again under another name; they are known
    by two 64-bit hashes. State holds the hashes of rows whose ``time`` (a timestamp) is not yet ``delay`` behind the
    newest, and no more, so a copy that comes later than that is taken for a new row. Rows without ``time`` would never
    leave the state, so they are left out here; a batch load takes them.
    """
    row = F.to_json(F.struct(*[quoted(c) for c in stream.columns if c not in ignore]), {"ignoreNullFields": "false"})
    marked = stream.where(quoted(time).isNotNull()).withColumns({"_hash": F.xxhash64(row), "_other": F.xxhash64(F.lit(1), row)})
    timed = marked.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_hash", "_other"])
    return timed.drop("_hash", "_other")


def ingest_arrivals(
    stream: DataFrame, root: str, keys: Sequence[str], checkpoint: str, name: str,
    transform: Callable[[DataFrame], DataFrame] = stamped_by_name,
) -> None:
    """Run ``transform`` over what has arrived and store it; ends when all of it is stored.

    ``name`` is the ingestion's own and stays the same from run to run. A micro-batch that is run again after a failure
    replaces what it had written; batches of other ingestions into the same table are told apart by the name. A new
    checkpoint starts a new ingestion: it reads every file again, so it needs a new name and another table.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        append_batch(transform(batch), root, keys, f"{name}-{batch_id:010d}")

    query = (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
