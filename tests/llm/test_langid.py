import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.queries import op9_language, table

PIECES = {p: k for k, p in enumerate(["▁", "▁a", "a", "b", "ab", "ba", "▁ab"], 1)}


def segmentations(word):
    """All ways to cut a word into pieces; single unknown characters are piece 0."""
    if not word:
        return [[]]
    out = []
    for size in range(1, len(word) + 1):
        head = word[:size]
        if head in PIECES or size == 1:
            out += [[PIECES.get(head, 0), *rest] for rest in segmentations(word[size:])]
    return out


@pytest.fixture()
def probability():
    p = np.random.default_rng(1).random((len(PIECES) + 1, 3))
    return np.vstack([p / p.sum(0), np.zeros(3)])


def test_forward_sums_all_segmentations(probability):
    for word in ("▁abab", "▁aéb", "▁"):
        got = langid.Lattice([word], PIECES).forward(probability)[-1][0]
        want = sum(np.prod(probability[s], axis=0) for s in segmentations(word))
        assert np.allclose(got, want)


def test_expected_counts(probability):
    counts = np.array([[2.0, 0.0, 1.0]])
    got = langid.Lattice(["▁abba"], PIECES).expected(probability, counts)
    want = np.zeros_like(probability)
    ways = segmentations("▁abba")
    total = sum(np.prod(probability[s], axis=0) for s in ways)
    for s in ways:
        for piece, times in Counter(s).items():
            want[piece] += times * np.prod(probability[s], axis=0) / total * counts[0]
    assert np.allclose(got, want)


def test_words():
    assert langid.words_of("Öl & l'été 12 ½ _x_") == ["öl", "l", "été", "½", "x"]
    assert langid.words_of("123 ½ !!") == [] and langid.words_of(None) == []
    assert "".join(langid.parts_of("x" * 200)) == langid.START + "x" * 200


def test_scorer_table_is_bounded_and_exact(probability):
    texts = ["ab ba abba", None, "ab", "b b b", ""] * 3
    wide, narrow = langid.Scorer(PIECES, probability[:-1]), langid.Scorer(PIECES, probability[:-1], limit=1)
    sizes, sums = wide.score(texts)
    again = [narrow.score([t]) for t in texts]
    assert np.allclose(sums, np.vstack([a[1] for a in again])) and sizes.tolist()[:5] == [3, 0, 1, 3, 0]


def test_query_accuracy_on_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op9_language(spark, folder).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in table(spark, folder, "documents").collect()}
    assert rows.keys() == truth.keys()
    held = [d for d in rows if rows[d].held_out]
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == rows[d].held_out for d in rows)
    labelled = [d for d in held if truth[d][0] and any(map(str.isalpha, truth[d][1] or ""))]
    assert sum(rows[d].lang_pred == truth[d][0] for d in labelled) >= 0.97 * len(labelled)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_bounded_sample(spark):
    rows = spark.createDataFrame([(i, "big", "a") for i in range(2000)] + [(i, "rare", "b") for i in range(20)], "id long, lang string, body string")
    kept = {r.lang: r["count"] for r in langid.bounded_sample(rows, 200).groupBy("lang").count().collect()}
    assert kept["rare"] == 20 and 120 < kept["big"] < 300


def test_odd_rows(odd_documents, no_documents):
    found = {r.doc_id: r for r in langid.identify(odd_documents, F.lit(True)).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1, 2, 3, 7))
    assert found[8].lang_pred == "de" and langid.identify(odd_documents, F.lit(True)).count() == 10
    assert {r.lang_pred for r in langid.identify(odd_documents, F.lit(False)).collect()} == {"und"}
    assert langid.identify(no_documents, F.lit(True)).count() == 0
    assert all(math.isfinite(r.score) for r in found.values())
