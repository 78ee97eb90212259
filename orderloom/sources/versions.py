"""Versions of a stored table: a numbered manifest names the folders the table is made of.

A writer adds folders that no manifest names, then makes the next manifest, which is one rename. So a reader has the whole old
table or the whole new one, a writer that dies leaves the table as it was, and of two writers that start from one
version one succeeds. The file system's rename must be atomic and refuse an existing target, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"


class Taken(Exception):
    """Another writer has made the version."""


class Versions:
    """The manifests of a table, through the file system that Spark itself writes with."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self.at().getFileSystem(self._conf)

    def at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def folders(self, *parts: str) -> list[str]:
        """Names below a folder; none where there is no such folder."""
        folder = self.at(*parts)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def numbers(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self.folders(FOLDER) if n.endswith(".json") and not n.startswith(".")]

    def newest(self) -> int:
        """Number of the newest version, 0 before the first."""
        return max(self.numbers(), default=0)

    def read(self, number: int | None = None) -> dict:
        """What a version's manifest says, the newest one's without a number; nothing before the first."""
        number = self.newest() if number is None else number
        if not number:
            return {}
        stream = self.fs.open(self.at(FOLDER, f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, after: int, facts: dict) -> int:
        """Make the version that follows ``after``; raises Taken if there is one."""
        made, draft = self.at(FOLDER, f"{after + 1:012d}.json"), self.at(FOLDER, f".{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(facts, sort_keys=True).encode()))
        stream.close()
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf)
        try:
            files.rename(draft, made, options)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise Taken(f"version {after + 1} of {self.root}") from None
            raise
        return after + 1

    def drop(self, *parts: str) -> None:
        self.fs.delete(self.at(*parts), True)

    def forget(self, numbers: Iterable[int]) -> None:
        for number in numbers:
            self.drop(FOLDER, f"{number:012d}.json")
