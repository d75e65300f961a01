"""Queries of the training-data operators over whole tables, with their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    context_tree, decontaminate, filter_audit, html_blocks, langid, licenses, multiset_hash, packing, periodic_runs, personal_data, sharding,
    simhash, token_rollup,
)
from tidemark.llm.oracles import ORACLE  # noqa: F401
from tidemark.llm.texts import bucket_of_id
from tidemark.sources.scratch import fresh_path, store


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.item_ids"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the licence notices it contains."""
    documents = table(spark, folder, "documents")
    found = licenses.scan(documents, licenses.notices(documents))
    return licenses.licensed(documents, found).select(
        "doc_id", F.size("templates").cast("long").alias("n_templates"), F.concat_ws(",", "templates").alias("templates"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after three batches over the whole table: all documents come, exact copies go, and
    half of the rest moves to a tokenizer version that counts an end token. The second batch arrives twice.

    Of equal texts the smallest id stays, every row of it. A document without id stays only if its text has no id at
    all, and never moves."""
    documents = table(spark, folder, "documents")
    keyed = documents.withColumn("content", F.sha2(F.coalesce("text", F.lit("")), 256))
    counted = store(
        token_rollup.token_counts(keyed, packing.default_tokenizer(), ("doc_id", "source", "lang", "content")), "token-counts",
    )
    first = counted.groupBy("content").agg(F.min("doc_id").alias("doc_id"))
    is_first = (counted["content"] == first["content"]) & counted["doc_id"].eqNullSafe(first["doc_id"])
    copies = counted.join(first, is_first, "left_anti")
    version, closed = "word_bpe_49k", "word_bpe_49k+end"
    stays = counted.join(first, is_first, "left_semi").where("crc32(cast(cast(doc_id as string) as binary)) % 2 = 0")
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "token-rollup"))
    rollup.commit("inserts", token_rollup.changes(counted, version, 1))
    for _ in range(2):
        rollup.commit("copies", token_rollup.changes(copies, version, -1))
    rollup.compact()
    longer = stays.withColumn("n_tokens", F.col("n_tokens") + 1)
    rollup.commit("end-token", token_rollup.revisions(stays, longer, version, closed))
    return rollup.totals()


def op5_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    held_out = bucket_of_id(F.col("doc_id"), 10) == 0
    scored = context_tree.score(table(spark, folder, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte",
    )


def op6_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op7_shard(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_multiset_hash(spark: SparkSession, folder: str) -> DataFrame:
    return multiset_hash.with_next(table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    held_out = bucket_of_id(F.col("doc_id"), 5) == 0
    documents = table(spark, folder, "documents")
    return langid.identify(documents, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_blocks.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What filters A to E remove, by part, order and step."""
    filters = {**filter_audit.text_rules(F.col("body")), "E": filter_audit.COPY}
    counts = filter_audit.combinations(table(spark, folder, "documents"), filters, table(spark, folder, "labels"))
    return filter_audit.audit(counts, list(filters))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of the texts, one in ten with a periodic tail, and digests of them and of the collapsed texts."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    planted = documents.withColumn("text", periodic_runs.with_planted_runs(F.col("doc_id"), F.col("text")))
    found = periodic_runs.periodic_runs(planted)
    runs = F.col("found.runs")
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    shown = found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("top"), F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")).alias("lines"),
        F.col("found.collapsed").alias("collapsed"))
    return shown.select(
        "doc_id", "n_runs", (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.p")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, folder, "documents"))
    base = F.filter("found.spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in personal_data.KINDS[:4]]
    return found.select(
        "doc_id", *counts, F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
        personal_data.listed(F.col("found.spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_license_scan, op3_simhash, op4_token_rollup, op5_context_tree, op6_pack, op7_shard,
        op8_multiset_hash, op9_language, op10_main_text, op11_filter_audit, op12_periodic_runs, op13_personal_data,
    )
}
