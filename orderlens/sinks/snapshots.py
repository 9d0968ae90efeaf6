"""Versioned snapshots of a table: every run writes its own version, and a commit makes it visible.

Layout under a folder that all executors share:

    data/<writer>/            the rows of one attempt, written by Spark
    commits/<version>         one small file with the writer's name

A version exists once its commit file exists.  The file is created with the file
system's create-if-absent, after the rows are complete, so a run that dies while it writes
leaves rows that nobody reads, and of two runs that end together one takes the next
number.  Readers take the highest commit, or an older one by number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class SnapshotStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts) -> object:
        return self._path("/".join([self.folder, *map(str, parts)]))

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        commits = self._at("commits")
        if not self._fs.exists(commits):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(commits))
        return sorted(int(n) for n in names if n.isdigit())

    def _writer(self, version: int) -> str:
        stream = self._fs.open(self._at("commits", f"{version:012d}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame | None:
        """The given version, by default the newest; None if there is none."""
        held = self.versions()
        if not held or version is not None and version not in held:
            return None
        return self.spark.read.parquet(str(self._at("data", self._writer(version or held[-1])).toString()))

    def stage(self, df: DataFrame) -> str:
        """Write rows that no reader sees yet; returns the writer's name."""
        writer = uuid.uuid4().hex
        df.write.parquet(self._at("data", writer).toString())
        return writer

    def commit(self, writer: str) -> int:
        """Make staged rows the newest version."""
        if not self._fs.exists(self._at("data", writer, "_SUCCESS")):
            raise ValueError(f"{writer} has no complete rows to commit")
        already_exists = "org.apache.hadoop.fs.FileAlreadyExistsException"
        while True:
            version = (self.versions() or [0])[-1] + 1
            try:
                out = self._fs.create(self._at("commits", f"{version:012d}"), False)
            except Exception as e:      # another run took this number
                if already_exists not in str(getattr(e, "java_exception", e)):
                    raise
                continue
            try:
                out.write(bytearray(writer.encode()))
            finally:
                out.close()
            return version

    def write(self, df: DataFrame) -> int:
        return self.commit(self.stage(df))

    def expire(self, keep: int) -> list[int]:
        """Forget all but the newest ``keep`` versions; a version is hidden before its rows go."""
        old = self.versions()[:-keep] if keep else self.versions()
        for version in old:
            writer = self._writer(version)
            self._fs.delete(self._at("commits", f"{version:012d}"), False)
            self._fs.delete(self._at("data", writer), True)
        return old
