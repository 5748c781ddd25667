"""Folders of a store: from tasks through pyarrow, from the driver through Hadoop.

Tasks reach local and mounted folders, HDFS, S3 and GCS.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified folder and the folder's path there, inside a task."""
    scheme, authority, path = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):)?(//[^/]*)?(/.*)", folder, re.S).groups()
    if scheme in (None, "file"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(f"{scheme}:{authority}{quote(path)}")


def is_directory(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type == pafs.FileType.Directory


def child_directories(fs: pafs.FileSystem, path: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return [i.base_name for i in found if i.type == pafs.FileType.Directory and not i.base_name.startswith(("_", "."))]


class Folder:
    """A folder of the driver's Hadoop file system: markers and single calls."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.uri = self._fs.makeQualified(self._path(path)).toString().rstrip("/")

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.uri}/{name}"))

    def mark(self, name: str) -> None:
        self._fs.create(self._path(f"{self.uri}/{name}"), True).close()

    def names(self, name: str) -> list[tuple[str, int]]:
        """Entries with the time they were changed, in seconds."""
        if not self.has(name):
            return []
        found = self._fs.listStatus(self._path(f"{self.uri}/{name}"))
        return sorted((f.getPath().getName(), f.getModificationTime() // 1000) for f in found)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.uri}/{name}"), True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as tasks need it."""
    return Folder(spark, path).uri
