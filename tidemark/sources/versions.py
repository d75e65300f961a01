"""All tables of a load, or none.

Tables are written into a folder of their own version. When all of them are complete, one commit file
is created whose name is the next number; creating a file that exists fails, so of two loads that started from
the same version one is refused. Readers take the newest commit. The version before stays, for
readers that have begun and as the state to fall back to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class LoadConflictError(RuntimeError):
    """Another load committed since this one began; nothing of this one is visible."""


class Folder:
    """The few file operations that a commit needs, on whatever file system a path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name))) if self._fs.exists(self._at(name)) else []

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """False if the file exists."""
        try:
            stream = self._fs.create(self._at(name), False)
        except Exception:
            if self._fs.exists(self._at(name)):
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column] | None = None) -> dict[str, int]:
    """Write a table and return its ``rows`` and the given aggregates, measured by the write itself."""
    seen = Observation()
    wanted = {"rows": F.count(F.lit(1)), **(metrics or {})}
    df.observe(seen, *[c.alias(n) for n, c in wanted.items()]).write.parquet(path)
    return dict(seen.get)


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    #: Measures of each table, by name.
    tables: dict[str, dict[str, int]]


@dataclass
class Load:
    """A version in the making."""

    root: str
    folder: str
    tables: dict[str, dict[str, int]] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, metrics: dict[str, Column] | None = None) -> dict[str, int]:
        if name in self.tables:
            raise ValueError(f"{name} is already part of this load")
        measured = write_observed(df, f"{self.root}/{self.folder}/{name}", metrics)
        self.tables[name] = measured
        return measured


class VersionedTables:
    """Tables under one folder that change together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Folder(spark, root)

    def history(self) -> list[Version]:
        """All commits, oldest first. A commit whose writer died before its text was complete does not count."""
        found = []
        for name in self.files.names("commits"):
            try:
                held = json.loads(self.files.text(f"commits/{name}"))
            except ValueError:
                continue
            found.append(Version(int(name), held["folder"], held["tables"]))
        return found

    def current(self) -> Version | None:
        versions = self.history()
        return versions[-1] if versions else None

    def read(self, name: str, version: Version | None = None) -> DataFrame:
        version = version or self.current()
        if version is None or name not in version.tables:
            raise LookupError(f"no version of {name} under {self.files.root}")
        return self.spark.read.parquet(f"{self.files.root}/{version.folder}/{name}")

    @contextmanager
    def load(self, keep: int = 2) -> Iterator[Load]:
        """Whatever the block writes is committed at its end, or dropped if it fails. ``keep`` versions stay."""
        numbers = self.files.names("commits")
        load = Load(self.files.root, f"versions/{uuid.uuid4().hex}")
        try:
            yield load
            number = int(numbers[-1]) + 1 if numbers else 0
            text = json.dumps({"folder": load.folder, "tables": load.tables})
            if not self.files.create(f"commits/{number:010d}", text):
                raise LoadConflictError(f"version {number} of {self.files.root} was committed meanwhile")
        except BaseException:
            self.files.delete(load.folder)
            raise
        self.drop_old(keep)

    def drop_old(self, keep: int) -> None:
        """Delete the folders of all but the newest ``keep`` versions. Folders of unfinished loads are not touched."""
        for version in self.history()[:-keep]:
            self.files.delete(version.folder)
            self.files.delete(f"commits/{version.number:010d}")
