import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import multiset_hash as mh
from tidemark.llm.queries import op8_multiset_hash, table

SMALL = "/root/testdata/sf0.001"
PARAGRAPHS = st.lists(st.text("abc dé", min_size=1, max_size=40).filter(str.strip), max_size=8)


@given(PARAGRAPHS, st.randoms())
def test_order_does_not_matter(paragraphs, rng):
    shuffled = list(paragraphs)
    rng.shuffle(shuffled)
    assert (mh.vector("\n".join(paragraphs).encode()) == mh.vector("\n".join(shuffled).encode())).all()


@given(PARAGRAPHS, st.text("abc", min_size=1, max_size=20))
def test_insert_and_delete(paragraphs, extra):
    old, new = mh.vector("\n".join(paragraphs).encode()), mh.vector("\n".join([*paragraphs, extra]).encode())
    assert (mh.inserted(old, extra.encode()) == new).all() and (mh.deleted(new, extra.encode()) == old).all()
    assert not (old == new).all() and (mh.from_text(mh.as_text(new)) == new).all()


def test_repeats_count_and_wrap():
    once = mh.vector(b"a paragraph")
    assert (mh.vector(b"a paragraph\n" * 70_000) == (once.astype(np.int64) * 70_000).astype(np.uint16)).all()
    assert mh.likeness(mh.vector(b""), mh.vector(b"")) == 1.0 and mh.likeness(mh.vector(b""), once) == 0.0


def expected(documents):
    """By sorting everything on one machine."""
    order = sorted(documents, key=lambda r: -r[0])
    out = {}
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        n = len(text) // 3
        changed = text[:len(text) - n] + (after[:n] if n else "")
        a, b, c = (mh.vector(t.encode()) for t in (text, changed, after))
        out[doc_id] = (
            doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), mh.as_text(a), mh.as_text(b), mh.likeness(a, b), mh.likeness(a, c),
        )
    return out


def test_query_against_one_sorted_list(spark):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    rows = {r.doc_id: tuple(r) for r in op8_multiset_hash(spark, SMALL).collect()}
    assert rows == expected(documents)
    mean = {k: np.mean([r[k] for r in rows.values()]) for k in (5, 6)}
    assert mean[5] > 0.5 > 0.2 > mean[6]


def test_odd_rows(odd_documents, no_documents, spark):
    rows = mh.with_next(odd_documents).collect()
    assert len(rows) == 10
    of = {r.doc_id: r for r in rows}
    assert of[1].n_chars == 0 and of[1].fingerprint == of[2].fingerprint == "0000" * mh.LANES and of[4].fingerprint == of[5].fingerprint
    assert mh.with_next(no_documents).count() == 0 and mh.fingerprints(no_documents).count() == 0
    assert mh.fingerprints(odd_documents).count() == 10
    single = mh.with_next(odd_documents.where("doc_id = 6")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    nulls = spark.createDataFrame([(None, "a b c"), (None, "d e f"), (3, "g h i j k")], "doc_id long, text string")
    found = mh.with_next(nulls).collect()
    assert sorted(r.n_chars for r in found) == [5, 5, 9]


def test_every_slice_has_its_own_task(spark):
    documents = spark.range(4_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r.n for r in mh.with_next(documents).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 4_000 and len(sizes) == 16 and max(sizes) < 1.2 * 4_000 / 16
