"""Partitioned tables whose readers see the old state or the new one, whole, whenever a write dies.

A table is a folder of versions and a folder of numbered commits. A version holds the partitions that one run wrote; a
commit is a small file that says, for each partition, which version has it. A run writes its version first and
its commit last, by one rename to a name that must not exist yet. Readers take the commit of the greatest number. So a
run that dies leaves files nobody reads, a run that rewrites three partitions of a thousand writes three, and of
two runs that start from the same commit the second is refused.

The list of partitions is held by the driver, as that of any partitioned table is; no row is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from touchline.functions.columns import read_ddl
from touchline.sinks.folders import Folder
from touchline.sinks.partitions import balanced, partition_folder

COMMITS, VERSIONS = "_commits", "_versions"
Key = tuple[str, ...]


class ConcurrentWrite(RuntimeError):
    """Another run has committed since this one looked."""


class Table:
    """A versioned table at ``root`` partitioned by ``keys``, of one or more ``parts`` (name -> schema without the keys).

    Parts are row sets that change together, such as the rows and what is known about them by partition.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], parts: Mapping[str, str | T.StructType]) -> None:
        self.spark, self.root, self.keys = spark, root.rstrip("/"), tuple(keys)
        self.parts = {name: read_ddl(schema) for name, schema in parts.items()}
        self.commits = Folder(spark, f"{self.root}/{COMMITS}")

    def last(self) -> int:
        """The number of the newest commit; 0 without any."""
        return max((int(n.split(".")[0]) for n in self.commits.names() if n.endswith(".json")), default=0)

    def partitions(self, number: int | None = None) -> dict[Key, str]:
        """Partition -> the version that has it."""
        number = self.last() if number is None else number
        if not number:
            return {}
        return {tuple(key): version for version, keys in json.loads(self.commits.read(commit_name(number))).items() for key in keys}

    def read(self, part: str, only: Sequence[Key] | None = None, number: int | None = None) -> DataFrame:
        """A part of the newest state, or of that of a commit; ``only`` restricts it to some partitions.

        The files are named when the frame is made, so a later commit does not change what it reads.
        """
        held = self.partitions(number)
        wanted = held if only is None else {key: held[key] for key in map(tuple, only) if key in held}
        by_version: dict[str, list[Key]] = {}
        for key, version in wanted.items():
            by_version.setdefault(version, []).append(key)
        schema = T.StructType([*self.parts[part].fields, *[T.StructField(k, T.StringType()) for k in self.keys]])
        whole = self.spark.createDataFrame([], schema)
        frames = []
        for version, keys in sorted(by_version.items()):
            base = f"{self.root}/{VERSIONS}/{version}/{part}"
            folders = Folder(self.spark, base)
            there = [f for f in (partition_folder(base, self.keys, key) for key in sorted(keys, key=repr)) if folders.has(f)]
            if there:  # a partition without rows has no folder
                frames.append(self.spark.read.schema(schema).option("basePath", base).parquet(*there))
        for frame in frames:
            whole = frame if frame is frames[0] else whole.unionByName(frame)
        return whole

    def commit(self, replaced: Sequence[Key] | None = None, since: int | None = None, **frames: DataFrame) -> int:
        """Write new rows of the parts and make them the table's; returns the number of the commit.

        ``replaced`` are the partitions whose rows give way, also where no new rows come; without it the whole table
        does. Partitions of new rows are always replaced. ``since`` is the commit the rows were made from; if another
        has come in between, nothing changes and :class:`ConcurrentWrite` is raised. All parts must be given.
        """
        if set(frames) != set(self.parts):
            raise ValueError(f"parts {sorted(self.parts)} are written together")
        since = self.last() if since is None else since
        version = f"v{since + 1:010d}-{uuid.uuid4().hex}"
        fresh: set[Key] = set()
        for part, df in frames.items():
            base = f"{self.root}/{VERSIONS}/{version}/{part}"
            columns = [*self.parts[part].names, *self.keys]
            balanced(df.select(*columns), self.keys).write.option("partitionOverwriteMode", "static").partitionBy(*self.keys).parquet(base)
            written = self.spark.read.schema(T.StructType([*self.parts[part].fields, *[T.StructField(k, T.StringType()) for k in self.keys]])).parquet(base)
            fresh |= {tuple(row) for row in written.select(*self.keys).distinct().collect()}  # read from folder names alone
        held = {} if replaced is None else self.partitions(since)
        for key in map(tuple, replaced or ()):
            held.pop(key, None)
        held |= dict.fromkeys(fresh, version)
        self._commit(since + 1, held)
        return since + 1

    def _commit(self, number: int, held: Mapping[Key, str]) -> None:
        listed: dict[str, list[Key]] = {}
        for key, version in held.items():
            listed.setdefault(version, []).append(key)
        waiting = f"{uuid.uuid4().hex}.waiting"
        self.commits.write(waiting, json.dumps({v: sorted(keys, key=repr) for v, keys in listed.items()}))
        if not self.commits.rename(waiting, commit_name(number)):
            self.commits.delete(waiting)
            raise ConcurrentWrite(f"commit {number} of {self.root} exists")

    def expire(self, keep: int = 2) -> list[str]:
        """Delete versions that none of the last ``keep`` commits names, of runs that died too, and older commits.

        Not to be called while another run writes, as what it has written is not committed yet.
        """
        last = self.last()
        kept = range(max(1, last - keep + 1), last + 1)
        named = {version for number in kept for version in self.partitions(number).values()}
        folder = Folder(self.spark, f"{self.root}/{VERSIONS}")
        gone = [v for v in folder.names() if v not in named]
        for version in gone:
            folder.delete(version)
        for name in self.commits.names():
            if name.endswith(".waiting") or (name.endswith(".json") and int(name.split(".")[0]) not in kept):
                self.commits.delete(name)
        return gone


def commit_name(number: int) -> str:
    return f"{number:010d}.json"
