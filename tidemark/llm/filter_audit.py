"""Filter interaction audit: what each filter removes, alone, after the others and in every order.

A row gets one bit for each filter it fails. Rule filters are column expressions;
the copy filter is an existential self-join: a left-semi join on the text's hash,
the exact text and a smaller id. The ids of both kinds of failures are united and
the bits of a row added up; from then on only counts by bit combination are needed,
at most 2^filters rows a part, and every order of the filters is read off them.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Failing this filter means that a smaller id has the same text.
COPY = "copy"
MASK, COUNTS = "mask", ("documents", "good", "toxic")


def text_rules(text: Column) -> dict[str, Column]:
    """Four rules on whole texts (not NULL). Words are stretches without ASCII white space, case counts."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, n_distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 50,
        "B": F.lit(100) * n_distinct < F.lit(65) * n_words,
        "C": F.lit(100) * capitals.cast("long") > F.lit(5) * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def hot_hashes(rows: DataFrame, share: int) -> dict[int, int]:
    """Text hashes that hold more than 1/``share`` of all rows (so fewer than ``share``), with the number of salts each needs."""
    counted = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1))).first()[0]
    limit = max(total // share, 1)
    found = counted.where((F.col("n") > limit) & (F.col("n") > 1)).collect()
    return {r.hash: -(-r.n // limit) for r in found}


def later_copies(rows: DataFrame, share: int = 256) -> DataFrame:
    """Rows (``id``, ``text``, ``hash``, any others) whose text also stands under a smaller id.

    The other side of the semi-join is the smallest id of each text, because some
    smaller id exists exactly if the smallest is smaller. That side is aggregated before
    its shuffle and lies where the join wants it. A text with more than 1/``share`` of the rows is
    dealt over several salts; its one row on the other side is repeated for each of them.
    """

    def first_ids(some: DataFrame) -> DataFrame:
        return some.where(F.col("id").isNotNull()).groupBy("hash", "text").agg(F.min("id").alias("first_id"))

    def semi_join(some: DataFrame, first: DataFrame, keys: list[str]) -> DataFrame:
        return some.join(first, [*[some[k] == first[k] for k in keys], some["id"] > first["first_id"]], "left_semi")

    hot = hot_hashes(rows, share)
    if not hot:
        return semi_join(rows, first_ids(rows), ["hash", "text"])
    is_hot = F.col("hash").isin(list(hot))
    salts = F.element_at(F.create_map(*[x for h, n in sorted(hot.items()) for x in (F.lit(h), F.lit(n))]), F.col("hash"))
    usual, often = rows.where(~is_hot), rows.where(is_hot)
    # Any salt finds its partner, so a rerun task may deal its rows differently.
    dealt = often.withColumn("salt", F.pmod(F.xxhash64("id", F.spark_partition_id()), salts).cast("int"))
    repeated = first_ids(often).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    copies = semi_join(dealt, repeated, ["hash", "salt", "text"]).drop("salt")
    return semi_join(usual, first_ids(usual), ["hash", "text"]).unionByName(copies)


def combinations(
    documents: DataFrame, filters: Mapping[str, Column | str], labels: DataFrame | None = None,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", share: int = 256,
) -> DataFrame:
    """Counts of documents, good and toxic ones, by ``part`` and ``mask`` (bit k: fails the k-th filter).

    ``filters`` maps names to boolean expressions over ``body`` (the text, empty where
    NULL), or to ``COPY``. An expression that is NULL counts as passed.
    A NULL part counts as empty text. A document without id is nobody's copy and has no
    labels, but is counted. Repeated rows count each; the same id with the same text is
    no smaller id. Labels that repeat an id count as one, good (toxic) if any of them
    says so. Other columns are not read.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("id"), body.alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    ).withColumn("hash", F.xxhash64("text"))
    # A row is known by id, part and a digest of its text; texts themselves go no further than the self-join.
    row = ["id", "part", F.unhex(F.sha2(F.col("text"), 256)).alias("digest")]
    rules = F.lit(0)
    for k, test in enumerate(filters.values()):
        if not isinstance(test, str):
            rules = rules + F.when(test, 1 << k).otherwise(0)
    failures = rows.withColumn("body", F.col("text")).select(*row, rules.alias(MASK), F.lit(1).alias("rows"))
    copy_bit = sum(1 << k for k, test in enumerate(filters.values()) if isinstance(test, str) and test == COPY)
    if copy_bit:
        failures = failures.unionByName(later_copies(rows, share).select(*row, F.lit(copy_bit).alias(MASK), F.lit(0).alias("rows")))
    marked = failures.groupBy("id", "part", "digest").agg(F.bit_or(MASK).alias(MASK), F.sum("rows").alias("documents"))
    by_id = marked.groupBy("id", "part", MASK).agg(F.sum("documents").alias("documents"))
    if labels is None:
        flags = [F.lit(0).alias("is_good"), F.lit(0).alias("is_toxic")]
        labelled = by_id.select("*", *flags)
    else:
        flagged = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("id")).agg(
            F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("is_good"),
            F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("is_toxic"))
        labelled = by_id.join(flagged, "id", "left")
    return labelled.groupBy("part", MASK).agg(
        F.sum("documents").alias("documents"),
        F.sum(F.col("documents") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("documents") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
    )


def orders_and_steps(names: list[str]) -> Column:
    """Every order of the filters with its steps, the bit of each step's filter and the bits of those before it."""
    bit = {name: 1 << k for k, name in enumerate(names)}
    cells = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"), F.lit(step + 1).alias("step"), F.lit(bit[name]).alias("own"),
            F.lit(sum(bit[n] for n in order[:step])).alias("before"),
        )
        for order in permutations(names) for step, name in enumerate(order)
    ]
    return F.array(*cells)


def audit(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step, from ``combinations``.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fails it, but was removed
    before), ``unique_fails`` (fails this filter only), ``good_lost`` and
    ``toxic_lost`` among the removed, and ``shapley``: what the filter removes, summed
    over all orders. In all orders together, a document that fails m filters is removed
    by each of them equally often, n!/m times. No parts, no rows.
    """
    cell = F.struct(MASK, *COUNTS)
    parts = counts.groupBy("part").agg(F.collect_list(cell).alias("cells"))
    steps = parts.select("part", "cells", F.explode(orders_and_steps(names)).alias("s")).select("part", "cells", "s.*")

    def total(test, value="documents") -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + F.when(test(c[MASK]), c[value]).otherwise(F.lit(0).cast("long")))

    own, before = F.col("own"), F.col("before")
    fails, gone = (lambda m: m.bitwiseAND(own) != 0), (lambda m: m.bitwiseAND(before) != 0)
    orders = factorial(len(names))
    # fails / m without fractions: n!/m for every number m of failed filters.
    shares = F.array(F.lit(0).cast("long"), *[F.lit(orders // m).cast("long") for m in range(1, len(names) + 1)])
    shapley = F.aggregate(
        "cells", F.lit(0).cast("long"),
        lambda acc, c: acc + F.when(fails(c[MASK]), c["documents"] * F.element_at(shares, F.bit_count(c[MASK]) + 1)).otherwise(F.lit(0).cast("long")))
    return steps.select(
        "part", "filter_order", "step",
        total(lambda m: m.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total(lambda m: fails(m) & ~gone(m)).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m == own).alias("unique_fails"),
        total(lambda m: fails(m) & ~gone(m), "good").alias("good_lost"),
        total(lambda m: fails(m) & ~gone(m), "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
