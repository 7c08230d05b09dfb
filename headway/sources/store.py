"""Names, moves and small files in the store behind a path, through Spark's own file system.

For metadata that the driver handles anyway: the folders of a table, the first line of a
file, markers of commits. Any store that Spark reads will do. Rows are left to DataFrames.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LINE_BYTES = 64 << 10
THREADS = 16  # opens that wait for the store at a time


class Entry(NamedTuple):
    name: str
    is_folder: bool
    size: int
    modified: int  # in milliseconds since 1970


class Store:
    """The file system that `path` lies in. Paths may be given with or without its scheme."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.listed: list[str] = []  # folders listed so far

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def entries(self, folder: str) -> list[Entry]:
        """What lies in the folder itself, by name; nothing if it is absent."""
        self.listed.append(folder)
        try:
            found = self._files.listStatus(self._path(folder))
        except Py4JJavaError as error:
            if _is_a(error, "FileNotFoundException"):
                return []
            raise
        entries = [Entry(s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in found]
        return sorted(entries)

    def folders(self, folder: str, key: str) -> dict[str, str]:
        """The values of `key=value` folders and their paths; hidden ones are left out."""
        return {
            e.name.removeprefix(f"{key}="): f"{folder}/{e.name}"
            for e in self.entries(folder)
            if e.is_folder and e.name.startswith(f"{key}=")
        }

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def full(self, path: str) -> str:
        """The path with its scheme, so that it means the same wherever it is read."""
        return self._files.makeQualified(self._path(path)).toString()

    def make_folder(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename within the store; the target must not be there."""
        if self.exists(target) or not self._files.rename(self._path(source), self._path(target)):
            raise FileExistsError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def create_once(self, path: str, text: str) -> bool:
        """Write a small file unless it is there; of several writers one gets True.

        It appears under its name with all its text, by a rename that does not replace, so
        the store must have such a rename.
        """
        draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        out = self._files.create(self._path(draft), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            self.move(draft, path)
        except FileExistsError:
            self.remove(draft)
            return False
        return True

    def read(self, path: str, limit: int = LINE_BYTES) -> str:
        """The first bytes of a file as text; a character cut at the limit is left out."""
        stream = self._files.open(self._path(path))
        try:
            return bytes(stream.readNBytes(limit)).decode("utf-8", "ignore")
        finally:
            stream.close()

    def first_file(self, path: str) -> str:
        """The path itself, or of a folder of parts the first part that is not empty."""
        if not self._files.getFileStatus(self._path(path)).isDirectory():
            return path
        parts = [e for e in self.entries(path) if not e.is_folder and e.name[:1] not in "_."]
        for part in sorted(parts, key=lambda e: (not e.size, e.name)):
            return f"{path}/{part.name}"
        raise FileNotFoundError(f"no part in {path}")

    def first_lines(self, paths: list[str]) -> list[str]:
        """The first line of each file, without its line break."""

        def first(path: str) -> str:
            text = self.read(path)
            return text.splitlines()[0] if text else ""

        with ThreadPoolExecutor(THREADS) as pool:
            return list(pool.map(first, paths))


def _is_a(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name
