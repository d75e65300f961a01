import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit
from tidemark.llm.queries import op11_filter_audit, table

SMALL = "/root/testdata/sf0.001"


def failures(documents):
    """(part, id) and the letters of the filters each row fails."""
    for doc_id, text, part in documents:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        copy = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in documents)
        fails = [
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)), copy,
        ]
        yield part or "", doc_id, {f for f, bad in zip("ABCDE", fails, strict=True) if bad}


def brute(documents, labels):
    """Every order applied to every row, one after the other."""
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, bad in labels if bad == 1 and d is not None}
    out = Counter()
    rows = list(failures(documents))
    for order in map("".join, permutations("ABCDE")):
        for part, doc_id, fails in rows:
            removed = False
            for step, f in enumerate(order, 1):
                key = (part, order, step)
                out[key, "kept"] += not removed and f not in fails
                out[key, "removed"] += not removed and f in fails
                out[key, "redundant"] += removed and f in fails
                out[key, "unique_fails"] += fails == {f}
                out[key, "good_lost"] += not removed and f in fails and doc_id in good
                out[key, "toxic_lost"] += not removed and f in fails and doc_id in toxic
                removed = removed or f in fails
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    table = {key: [out[key, n] for n in names] for key in {k for k, _ in out}}
    shapley = Counter()
    for (part, order, step), values in table.items():
        shapley[part, order[step - 1]] += values[1]
    return {(*key, *values, shapley[key[0], key[1][key[2] - 1]]) for key, values in table.items()}


def audited(documents, labels, share=256):
    filters = {**filter_audit.text_rules(F.col("body")), "E": filter_audit.COPY}
    counts = filter_audit.combinations(documents, filters, labels, share=share)
    return {tuple(r) for r in filter_audit.audit(counts, list(filters)).collect()}


def test_query_equals_every_order_run_by_itself(spark):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in table(spark, SMALL, "labels").select("doc_id", "quality", "toxic").collect()]
    assert {tuple(r) for r in op11_filter_audit(spark, SMALL).collect()} == brute(documents, labels)


LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, LONG, "a"), (2, LONG, "b"), (2, LONG, "b"), (3, LONG, None), (3, None, ""), (4, "", "a"), (None, LONG, "a"), (None, None, "b"),
    (5, "A B C #", "a"), (6, "a " * 80, "a"), (7, LONG + " É", "b"), (7, LONG + "  É", "b"), (1, LONG, "b"), (8, "x" * 300_000, "a"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (None, 1, 1), (99, 1, 1), (5, 0, 0)]


def test_nulls_repeated_rows_and_labels(spark):
    documents = spark.createDataFrame(ROWS, "doc_id long, text string, source string").selectExpr("*", "1 as hash", "2 as mask", "3 as part", "4 as id")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audited(documents, labels) == brute(ROWS, LABELS)
    assert audited(documents.where("doc_id < 0"), labels) == set()
    assert {r[7:9] for r in audited(documents, labels.where("doc_id < 0"))} == {(0, 0)}


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_hot_copies_are_found_whatever_their_share(spark, share):
    rows = [(i, "same text" if i % 3 else f"own {i}", "a") for i in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    keyed = documents.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("hash"))
    assert {r.id for r in filter_audit.later_copies(keyed, share).collect()} == {i for i in range(2, 300) if i % 3}
    assert len(filter_audit.hot_hashes(keyed, share)) <= share


def test_other_filters_and_no_labels(spark):
    documents = spark.createDataFrame([(1, "aa", "x"), (2, "b", "x"), (3, "b", "x")], "doc_id long, text string, source string")
    filters = {"S": F.length("body") < 2, "K": filter_audit.COPY, "N": F.lit(None).cast("boolean")}
    rows = filter_audit.audit(filter_audit.combinations(documents, filters), list(filters))
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in rows.collect()}
    # Document 2 fails S alone (6 of 6 orders), document 3 fails S and K (3 of 6 each).
    assert found["SKN", 1] == (1, 2, 0, 1, 9) and found["SKN", 2] == (1, 0, 1, 0, 3) and found["KSN", 1] == (2, 1, 0, 0, 3)
    assert found["NSK", 1] == (3, 0, 0, 0, 0) and len(found) == 18


def test_odd_rows(odd_documents, no_documents, spark):
    labels = spark.createDataFrame([(4, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(audited(odd_documents, labels)) == 4 * 600 and audited(no_documents, labels) == set()
