"""A log of commits: numbered files that are created once and never replaced.

Each commit names its attempt and the attempt it builds on, so what it stands for cannot change when a batch runs again.
A commit is written under a name that readers skip and then renamed to the next free number, which fails if another
writer took it; then the log is read again and a commit of the same batch in between refuses this one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(ValueError):
    """Another writer committed the same batch in the meantime."""


@dataclass(frozen=True)
class Commit:
    """One attempt at a batch. ``whole``: it holds all current rows, not only those it opened; ``opened`` and
    ``closed`` count its rows of either kind, ``current`` the rows that are current after it."""

    batch: int
    attempt: str
    previous: str | None
    file_date: str
    whole: bool
    opened: int
    closed: int
    current: int
    quarantine: str | None = None


_SCHEMA = (
    "number bigint, batch bigint, attempt string, previous string, file_date string, whole boolean, opened bigint, closed bigint,"
    " current bigint, quarantine string"
)


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._folder = self._fs.Path(path)

    def read(self) -> list[Commit]:
        """All commits, in order."""
        system = self._folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(self._folder):
            return []
        rows = self.spark.read.schema(_SCHEMA).json(self.path).collect()
        return [Commit(**{k: v for k, v in r.asDict().items() if k != "number"}) for r in sorted(rows, key=lambda r: r.number)]

    def append(self, commit: Commit, seen: int) -> None:
        """Adds a commit by a writer who has read ``seen`` commits before it began."""
        while True:
            log = self.read()
            if any(c.batch == commit.batch for c in log[seen:]):
                raise CommitConflict(f"{self.path}: batch {commit.batch} was committed by another writer")
            if self._create(len(log) + 1, commit):
                return

    def _create(self, number: int, commit: Commit) -> bool:
        hidden = self._fs.Path(self._folder, f"_{uuid.uuid4().hex}")
        conf = self.spark._jsc.hadoopConfiguration()
        out = self._folder.getFileSystem(conf).create(hidden, False)
        out.write(bytearray(json.dumps({"number": number, **asdict(commit)}).encode()))
        out.close()
        context = self._fs.FileContext.getFileContext(self._folder.toUri(), conf)
        no_options = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        try:
            context.rename(hidden, self._fs.Path(self._folder, f"{number:012d}.json"), no_options)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            context.delete(hidden, False)
            return False
        return True
