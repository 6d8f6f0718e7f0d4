"""Small files and folders in whatever store Spark can reach, through its file systems."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Store:
    """Folders and small text files by path; a path without a scheme is in Spark's default file system."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple[Any, Any]:
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def folder(self, path: str) -> str:
        fs, p = self._at(path)
        fs.mkdirs(p)
        return path

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none where it is not there."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, path: str, to: str) -> None:
        fs, p = self._at(path)
        if not fs.rename(p, self.jvm.org.apache.hadoop.fs.Path(to)):
            raise OSError(f"{path} could not be moved to {to}")

    def swap(self, new: str, path: str) -> None:
        """Put the folder `new` in the place of `path`; the old one is only deleted when the new one is there. `settle` mends a swap that was broken off."""
        self.move(path, f"{path}.old")
        self.move(new, path)
        self.delete(f"{path}.old")

    def settle(self, path: str) -> None:
        """Finish or undo a swap of `path` that was broken off."""
        if self.exists(f"{path}.old"):
            if self.exists(path):
                self.delete(f"{path}.old")
            else:
                self.move(f"{path}.old", path)

    def read(self, path: str) -> dict:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, path: str, value: dict) -> None:
        """Written beside its place and moved there, so that a reader finds the old file or the new one."""
        fs, p = self._at(f"{path}.new")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        self.delete(path)
        self.move(f"{path}.new", path)
