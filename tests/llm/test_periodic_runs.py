import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs
from tidemark.llm.periodic_runs import LastOccurrences, LinkTree, _text_runs, runs_of
from tidemark.llm.queries import op12_periodic_runs, table

SMALL = "/root/testdata/sf0.001"


def brute(words, min_length=6, min_exponent=4):
    """Every period, every maximal stretch of words equal at that distance."""
    found = set()
    for p in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            n = j - i + p
            if j > i and n >= max(min_length, min_exponent * p):
                if not any(all(words[k] == words[k + q] for k in range(i, i + n - q)) for q in range(1, p)):
                    found.add((i, n, p))
            i = max(j, i + 1)
    return sorted(found)


def random_words(seed):
    rnd = random.Random(seed)
    n, letters = rnd.randint(1, 70), rnd.choice([1, 2, 2, 3, 4, 8])
    words = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randint(0, 2)):
        a, p = rnd.randrange(n), rnd.randint(1, 7)
        z = rnd.randint(a, n)
        words[a:z] = [words[a:z][k % p] for k in range(z - a)]
    return words


@pytest.mark.parametrize(("min_length", "min_exponent"), [(6, 4), (2, 2), (1, 3), (10, 2)])
def test_runs_equal_brute_force(min_length, min_exponent):
    for seed in range(600):
        words = random_words(seed)
        expected = brute(words, min_length, min_exponent)
        assert runs_of(words, min_length, min_exponent) == expected
        # The sieve in front loses nothing, several texts at a time.
        coded = [b"%d" % w for w in words]
        assert _text_runs([coded, [], coded[::-1], coded], min_length, min_exponent)[0::3] == [expected] * 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_colours_are_last_occurrences(words):
    """The segments of a path, deepest first, are the suffixes' last ends as found by comparing all of them."""
    tree = LinkTree(words)
    occurrences = LastOccurrences(tree)
    for i, state in enumerate(tree.prefixes):
        segments = [(e, n) for e, n in occurrences.access(state, i) if n]
        last = {n: max((e for e in range(n - 1, i) if words[e - n + 1:e + 1] == words[i - n + 1:i + 1]), default=-1) for n in range(1, i + 2)}
        longest = 0
        for e, n in reversed(segments):
            assert all(last[k] == e for k in range(longest + 1, n + 1))
            longest = n
        assert longest == i + 1


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(doc_id, text):
    words = plant(doc_id, (text or "").encode().split())
    runs = brute(words)
    keep = [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (
        doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(keep)).hexdigest())


def test_query_digest(spark):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    # The brute force is quadratic: long texts are compared below, by their planted runs.
    short = [(d, t) for d, t in documents if len((t or "").split()) <= 1500]
    assert len(short) > 150
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(documents)
    assert {d: got[d] for d, _ in short} == {d: digest(d, t) for d, t in short}
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_long_repetitions(spark):
    long = " ".join(f"w{i % 700}" for i in range(40_000))
    rows = [(1, long), (2, "a " * 50_000), (3, "x y " + "same " * 9 + "\tend"), (4, "A a " * 20), (5, "b c " * 30)]
    found = {r.doc_id: r.found for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 40_000, 700)] and len(found[1].collapsed.split(" ")) == 700
    assert [tuple(x) for x in found[2].runs] == [(0, 50_000, 1)] and found[2].collapsed == "a"
    assert found[3].collapsed == "x y same end" and [tuple(x) for x in found[4].runs] == [(0, 40, 2)]
    # A no-break space is no white space here; the last word has nothing behind it.
    assert found[5].n_words == 31


def test_odd_rows(odd_documents, no_documents):
    found = periodic_runs.periodic_runs(odd_documents, carry=("doc_id", "text"))
    rows = found.collect()
    assert len(rows) == 10 and all(r.found.runs == [] for r in rows)
    assert all(r.found.collapsed == " ".join((r.text or "").split()) for r in rows)
    assert periodic_runs.periodic_runs(no_documents).count() == 0
    with pytest.raises(ValueError, match="twice"):
        periodic_runs.periodic_runs(odd_documents, min_exponent=1)


def test_planting(spark):
    texts = [(i, " ".join(f"w{k}" for k in range(i % 40))) for i in range(200)] + [(None, "a b"), (7, None), (0, " "), (31, "\t é  b\nc ")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").select("*", periodic_runs.with_planted_runs(F.col("doc_id"), F.col("text")).alias("new"))
    for r in frame.collect():
        assert (r.new or "").split() == [w.decode() for w in plant(r.doc_id, (r.text or "").encode().split())]
