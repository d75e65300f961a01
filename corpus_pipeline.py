"""From raw documents to packed training sequences: four stages, each over all its predecessor kept.

1. ``language``: rejects documents without letters (NULL and empty ones too) and those in which no language
   reaches ``MIN_SCORE`` of the likelihood. Without any labelled document there is nothing to predict with, and only
   documents without letters go.
2. ``near_duplicates``: one document of each group of SimHash near duplicates stays, that with the smallest id.
3. ``decontaminate``: rejects documents that hold a window of the benchmark.
4. ``pack``: packs the rest into sequences of at most 2048 tokens; one row per piece.

The first three return the columns of their input unchanged. Every result is written
as Parquet under the shared folder and read again, so a stage never repeats another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, packing, simhash
from tidemark.llm.texts import bucket_of_id
from tidemark.sources.scratch import store


def _with_row(docs: DataFrame) -> DataFrame:
    """Whole rows travel in one column, so that extra columns cannot clash with an operator's own."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang")


#: A text of one language scores near 1, an even mixture of two near 0.5.
MIN_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: Sequence[str] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose predicted language is clear and, if ``languages`` are given, one of them."""
    found = langid.identify(_with_row(docs), bucket_of_id(F.col("doc_id"), 5) != 0, carry=("row",))
    clear = F.col("score") >= min_score
    if languages is not None:
        clear = clear & F.col("lang_pred").isin(list(languages))
    # A text with letters is unknown only if no language could be learnt.
    unlearnt = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    return found.where(F.when(F.col("lang_pred") == langid.UNKNOWN, unlearnt).otherwise(clear)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(_with_row(docs), benchmark, carry=("row",))
    return found.where(F.col("found.n_hit") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontaminate", without_benchmark), ("pack", pack),
]

#: SQL expresses neither the learnt language model nor the tokenizer; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
