"""Small files and folders of a shared file system: marks, manifests, renames."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


class Store:
    """The file system of a path, whichever one it is."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What lies in a folder; nothing if there is none."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(self._path(path)))

    def size(self, path: str) -> int:
        """Bytes of all that lies below a path."""
        return self._system.getContentSummary(self._path(path)).getLength()

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The whole file or none: it is written under another name and then renamed."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/_{name}-{os.urandom(6).hex()}"
        stream = self._system.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.rename(draft, path)

    def rename(self, old: str, new: str) -> None:
        self._system.mkdirs(self._path(new).getParent())
        if not self._system.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)
