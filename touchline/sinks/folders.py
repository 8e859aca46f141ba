"""Folders of a table on whatever file system its path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """The few file operations that Spark's readers and writers lack, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm = spark.sparkContext._jvm
        self.fs_package, self.path = jvm.org.apache.hadoop.fs, jvm.org.apache.hadoop.fs.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.path.getFileSystem(conf)
        self.jvm = jvm

    def at(self, name: str):
        """The path of a file or folder below, or of another by its whole path."""
        return self.fs_package.Path(self.path, name)

    def names(self) -> list[str]:
        if not self.system.exists(self.path):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(self.path)]

    def has(self, name: str) -> bool:
        return self.system.exists(self.at(name))

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> bool:
        """Whether the file has the new name now; it never takes the place of another."""
        if self.system.exists(self.at(to)):
            return False
        return self.system.rename(self.at(name), self.at(to)) and not self.system.exists(self.at(name))

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)
