"""Token counts as rollups that are maintained by deltas.

A change is a signed number of documents and tokens for a source, language and
tokenizer version: an insert adds, a delete subtracts, a revision subtracts the old
count and adds the new one. A batch of changes is summed by key and committed as
one table under its own name; totals are the sum of all committed batches. Sums are
additive, so the order of batches does not matter.

Commits are idempotent. A batch is written to a folder of its own attempt, and
becomes part of the totals by renaming that folder to its batch's name, which can happen
once: a repeated batch finds its name taken and changes nothing, and a writer that
dies leaves an attempt that nobody reads. Compaction sums committed batches into
one base table that names the batches it contains.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.texts import raw_texts, word_ids

KEYS = ("source", "lang", "tokenizer")
SUMS = ("documents", "tokens")
_SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def token_counts(
    documents: DataFrame, tokenizer: str, carry: Sequence[str] = ("doc_id", "source", "lang"), text_col: str = "text",
) -> DataFrame:
    """The ``carry`` columns and ``n_tokens`` of the whole text; NULL counts as empty and has none."""
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        for batch in batches:
            n = [len(ids) // 4 for ids in known.of_all(raw_texts(batch.column("body")))]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(n, pa.int64())], names=schema.names)

    return picked.mapInArrow(run, schema).select("kept.*", "n_tokens")


def changes(counted: DataFrame, tokenizer: str | Column, sign: int) -> DataFrame:
    """Inserts (sign 1) or deletes (sign -1) of counted documents; NULL source or language is a key of its own."""
    version = F.lit(tokenizer) if isinstance(tokenizer, str) else tokenizer
    return counted.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), version.alias("tokenizer"),
        F.lit(sign).cast("long").alias("documents"), (F.col("n_tokens") * sign).alias("tokens"),
    )


def revisions(old: DataFrame, new: DataFrame, old_version: str, new_version: str) -> DataFrame:
    """Old counts leave, new counts come; documents may also change source or language."""
    return changes(old, old_version, -1).unionByName(changes(new, new_version, 1))


def summed(rows: DataFrame) -> DataFrame:
    """By key, without keys that came to nothing. Tasks add up their rows first, so a hot key is a few rows."""
    totals = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return totals.where((F.col("documents") != 0) | (F.col("tokens") != 0))


class Rollup:
    """Totals in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.folder}/committed"))

    def _names(self, kind: str) -> list[str]:
        place = self._path(f"{self.folder}/{kind}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def committed(self) -> list[str]:
        """Batches in the totals, compacted ones included."""
        base = self._base()
        return sorted({*self._names("committed"), *(base[1] if base else [])})

    def _base(self) -> tuple[str, list[str]] | None:
        """The newest base table and the batches it holds."""
        names = self._names("base")
        if not names:
            return None
        held = self.spark.read.parquet(f"{self.folder}/base/{names[-1]}/batches")
        return names[-1], [r.batch for r in held.collect()]

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Add a batch of changes; False if it was committed before, in which case nothing changes."""
        if batch in self.committed():
            return False
        attempt = f"{self.folder}/attempts/{batch}-{uuid.uuid4().hex}"
        summed(rows).coalesce(1).write.parquet(attempt)
        return self._take(attempt, f"{self.folder}/committed/{batch}")

    def _take(self, attempt: str, target: str) -> bool:
        """Give a finished folder its name, unless another writer took the name meanwhile; that is one step of the file system."""
        fs, source, goal = self.spark._jvm.org.apache.hadoop.fs, self._path(attempt), self._path(target)
        context = fs.FileContext.getFileContext(goal.toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(source), self._fs.makeQualified(goal), no_options)
        except Py4JJavaError:
            if not self._fs.exists(goal):
                raise
            self._fs.delete(source, True)
            return False
        return True

    def _batches(self, names: Sequence[str]) -> DataFrame:
        found = self.spark.createDataFrame([], _SCHEMA)
        paths = [f"{self.folder}/committed/{n}" for n in names]
        return self.spark.read.schema(_SCHEMA).parquet(*paths) if paths else found

    def _rows(self) -> tuple[DataFrame, list[str]]:
        base = self._base()
        held = base[1] if base else []
        later = [n for n in self._names("committed") if n not in held]
        rows = self._batches(later)
        if base:
            rows = rows.unionByName(self.spark.read.schema(_SCHEMA).parquet(f"{self.folder}/base/{base[0]}/totals"))
        return rows, sorted({*held, *later})

    def totals(self) -> DataFrame:
        """documents and tokens by source, language and tokenizer version."""
        return summed(self._rows()[0])

    def compact(self) -> None:
        """Fold all committed batches into a new base; readers see the old or the new one."""
        rows, held = self._rows()
        number = len(self._names("base"))
        attempt = f"{self.folder}/attempts/base-{uuid.uuid4().hex}"
        summed(rows).coalesce(1).write.parquet(f"{attempt}/totals")
        self.spark.createDataFrame([(b,) for b in held], "batch string").coalesce(1).write.parquet(f"{attempt}/batches")
        self._fs.mkdirs(self._path(f"{self.folder}/base"))
        # If another compaction was faster, its base stands and the next one includes what it lacks.
        self._take(attempt, f"{self.folder}/base/{number:010d}")
