"""Session settings the operators rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Run-time settings. Partition keys such as 202309 must stay text, and a skewed join is worth an extra shuffle.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "touchline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the pinned settings; ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Apply the pinned settings to a session somebody else made."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for data that must outlive an executor: ``spark.checkpoint.dir``, as the cluster sets it.

    Where the setting is missing, a session on one machine (tests) gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="touchline-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Two passes over the result then see the same rows, also when an executor is lost in between. Unlike a
    checkpoint the copy is columnar, so a pass over one column reads one column.
    """
    spark = df.sparkSession
    path = path or new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """A staged table for the length of a block; emptied afterwards, so that it takes no space."""
    spark = df.sparkSession
    path = new_path(spark)
    try:
        yield stage(df, path)
    finally:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
