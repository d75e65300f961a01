"""Stored intermediates: the one way this engine cuts lineage or reuses a result.

A stored intermediate is a Parquet table under the shared folder named by
``spark.checkpoint.dir``. It survives the loss of executors and gives every
reader the same rows, which the ordered scan relies on.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_INSIDE: ContextVar[str | None] = ContextVar("inside", default=None)


@contextmanager
def inside(folder: str | None) -> Iterator[None]:
    """Intermediates stored here belong to ``folder``, whose owner releases them together."""
    before = _INSIDE.set(folder)
    try:
        yield
    finally:
        _INSIDE.reset(before)


def release(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediates that nobody reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(SETTING, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_INSIDE.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str = "stored") -> DataFrame:
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
