import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import context_tree as ct
from tidemark.llm.queries import op5_context_tree, table

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split()


def brute_model(texts, depth):
    """Context-tree weighting by dictionaries; returns p(byte | context) of the path to the deepest seen context."""
    counts = {}
    for text in texts:
        data = bytes(depth) + b" ".join(tokens(text)) + b"\0"
        for i in range(depth, len(data)):
            for bit in range(8):
                partial = 1 << bit | data[i] >> (8 - bit)
                one = data[i] >> (7 - bit) & 1
                for d in range(depth + 1):
                    counts.setdefault((partial, data[i - d:i]), [0, 0])[one] += 1

    def kt(node):
        a, b = counts[node]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    children = {}
    for partial, context in counts:
        if context:
            children.setdefault((partial, context[1:]), []).append((partial, context))
    weighted, stop = {}, {}
    for node in sorted(counts, key=lambda n: -len(n[1])):
        if node not in children:
            weighted[node], stop[node] = kt(node), 1.0
        else:
            split = sum(weighted[c] for c in children[node])
            weighted[node] = np.logaddexp(kt(node), split) - math.log(2)
            stop[node] = math.exp(kt(node) - math.log(2) - weighted[node])

    def chance(context, byte):
        p = 1.0
        for bit in range(8):
            partial, one = 1 << bit | byte >> (8 - bit), byte >> (7 - bit) & 1
            q = None
            for d in range(len(context), -1, -1):
                node = (partial, context[len(context) - d:])
                if node in counts:
                    a, b = counts[node]
                    own = ((b if one else a) + .5) / (a + b + 1)
                    q = own if q is None else stop[node] * own + (1 - stop[node]) * q
            p *= q if q is not None else 0.5
        return p

    return chance


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "THE\tcat  sat", "öl über öl", "", None, "zzz"]


@pytest.fixture(scope="module")
def model(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "body string")
    counts = ct.store(ct.corpus_counts(frame, 3), "t")
    return ct.train(counts.where("run is not null").select("run", "n"), 3, 10**6)


def test_seen_runs_equal_brute_force(model):
    chance = brute_model(TEXTS, 3)
    for text in TEXTS:
        runs, _ = ct.packed_runs([tokens(text)], 3)
        data = bytes(3) + b" ".join(tokens(text)) + b"\0"
        want = [math.log10(chance(data[i - 3:i], data[i])) for i in range(3, len(data))]
        assert np.allclose(model.logs(runs), want, atol=1e-5)


@pytest.mark.parametrize("context", [b"the", b"at ", b"\0\0\0", b"qqq", b"xat", b"xyt"])
def test_bytes_after_any_context_sum_to_one(model, context):
    base = sum(b << 8 * (k + 1) for k, b in enumerate(context))
    runs = np.array([base | b for b in range(256)], np.uint64)
    assert abs((10 ** model.logs(runs)).sum() - 1) < 1e-4


def test_packed_runs_layout():
    runs, starts = ct.packed_runs([[b"ab"], [], [b"c"]], 2)
    assert [r.to_bytes(3, "big") for r in runs.tolist()] == [b"\0\0a", b"a\0b", b"ba\0", b"\0\0\0", b"\0\0c", b"c\0\0"]
    assert starts.tolist() == [0, 3, 4]


def test_log_kt_and_hash_table():
    a, b = np.array([0, 0, 1, 500]), np.array([0, 3, 2, 7])
    want = [math.lgamma(x + .5) + math.lgamma(y + .5) - math.log(math.pi) - math.lgamma(x + y + 1) for x, y in zip(a, b, strict=True)]
    assert np.allclose(ct.log_kt(a, b), want)
    keys = np.unique(np.random.default_rng(0).integers(0, 2**40, 5000).astype(np.uint64))
    values, there = ct.HashTable(keys[::2], np.arange(len(keys[::2]))).get(keys)
    assert there[::2].all() and not there[1::2].any() and (values[::2] == np.arange(len(keys[::2]))).all()


@pytest.mark.parametrize("common", [250_000, 40])
def test_baseline_against_brute_force(spark, common):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in documents}
    counts = Counter(w for d, t in documents if not held[d] for w in [*tokens(t), None])
    n, v = sum(counts.values()), len(counts)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    rows = ct.score(table(spark, SMALL, "documents"), ~held_out, common=common).collect() if common < 1000 else op5_context_tree(spark, SMALL).collect()
    assert len(rows) == len(documents)
    texts = dict(documents)
    for r in rows:
        ts = [*tokens(texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(t in counts for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
        assert r.score < 0
    if common > 1000:
        assert all(r.held_out == held[r.doc_id] for r in rows)


def test_model_beats_the_words_on_held_out_texts(spark):
    rows = [r for r in op5_context_tree(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_depth_shrinks_to_the_bound(spark):
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    counts = ct.store(ct.corpus_counts(documents.select(F.col("text").alias("body")), 5), "t").where("run is not null")
    assert ct.train(counts.select("run", "n"), 5, 60).depth < 5


@pytest.mark.parametrize("most", [10**6, 20, 0])
def test_scores_do_not_depend_on_how_many_runs_are_broadcast(spark, most):
    """Depth stays 5 when the corpus has more runs than the broadcast holds; held-out texts have unseen runs."""
    documents = spark.createDataFrame(
        [(i, t) for i, t in enumerate([*TEXTS, "the cog", "über the mat sat", "qqqqqqqq", "zzz the"])], "doc_id long, text string")
    chance = brute_model(TEXTS, 5)
    rows = {r.doc_id: r for r in ct.score(documents, F.col("doc_id") < len(TEXTS), max_runs=most).collect()}
    for i, text in enumerate(TEXTS):
        data = bytes(5) + b" ".join(tokens(text)) + b"\0"
        want = sum(math.log10(chance(data[k - 5:k], data[k])) for k in range(5, len(data)))
        assert rows[i].score == pytest.approx(want, abs=1e-3)
    whole = {r.doc_id: r.score for r in ct.score(documents, F.col("doc_id") < len(TEXTS)).collect()}
    assert {i: r.score for i, r in rows.items()} == pytest.approx(whole, abs=1e-4)


def test_odd_rows(odd_documents, no_documents):
    found = {r.doc_id: r for r in ct.score(odd_documents, F.lit(True)).collect()}
    assert found[1].n_tokens == found[2].n_tokens == found[3].n_tokens == 1 and found[4].n_tokens == 60_001
    assert ct.score(odd_documents, F.lit(True)).count() == 10
    assert ct.score(no_documents, F.lit(True)).count() == 0
    nothing = ct.score(odd_documents, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in nothing)
