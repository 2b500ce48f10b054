"""The few file operations that tables need, on any file system Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """Small files and renames below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _at(self, name: str):
        return self._hadoop(name if "/" in name and name.startswith(self.path) else f"{self.path}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, pattern: str = "*") -> list[str]:
        found = self._fs.globStatus(self._hadoop(f"{self.path}/{pattern}")) or []
        return sorted(status.getPath().getName() for status in found)

    def make(self) -> None:
        self._fs.mkdirs(self._hadoop(self.path))

    def move(self, name: str, to: str) -> None:
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"cannot rename {name} to {to} in {self.path}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def save(self, name: str, value) -> None:
        """Write a small JSON file so that readers see the old one or the new one, never a part."""
        out = self._fs.create(self._at(f".{name}.new"), True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(self._at(f".{name}.new"), self._at(name), options)

    def load(self, name: str):
        """A small JSON file, or None where there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)
