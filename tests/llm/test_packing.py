import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import op6_pack, table
from tidemark.llm.texts import WordIds

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference_tokenizer():
    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, documents, tokenizer, capacity):
    """Every document comes back whole, and every sequence is gapless and not too long."""
    expected = []
    for doc_id, text in documents:
        ids = ids_of(tokenizer, text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4").tobytes()
            expected.append((doc_id, piece, at, len(part) // 4, zlib.crc32(part)))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(r.length for r in rows)


def test_query_round_trip(spark, reference_tokenizer):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    rows = op6_pack(spark, SMALL).collect()
    sequences, tokens = check(rows, documents, reference_tokenizer, 2048)
    assert sequences <= -(-tokens // 2048) * 1.02 + 1


def test_many_partitions_merge(spark, reference_tokenizer):
    documents = [(i, "word " * (1 + i * 37 % 90)) for i in range(400)]
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(40)
    rows = packing.pack(frame, capacity=128, slack=2).collect()
    sequences, tokens = check(rows, documents, reference_tokenizer, 128)
    local = packing.pack(frame.coalesce(1), capacity=128, slack=2).select("sequence_id").distinct().count()
    assert sequences <= local * 1.01 + 1


def test_best_fit_and_what_climbs():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, 2000)
    bins, offsets, fill = packing.best_fit(lengths, 100)
    assert (np.bincount(bins, lengths).astype(int) == fill).all() and fill.max() <= 100
    assert (2 * fill <= 100).sum() <= 1
    bins, fill = np.array([0, 1, 2, 3, 3, 4]), np.array([100, 99, 60, 55, 10])
    assert packing.climbing(bins, fill, 100, 1, 3).tolist() == [False, False, False, True, True, True]
    assert packing.climbing(bins, fill, 100, 1, 2).tolist() == [False, False, False, False, False, True]


def test_round_keeps_large_bin_numbers():
    import pandas as pd

    rows = pd.DataFrame({"bin": [2**55 + 1, 2**55 + 2, 2**55 + 3], "fill": [60, 40, 70], "node": [0, 0, 0]})
    captured = {}

    class Grouped:
        def groupBy(self, *_):
            return self

        def applyInPandas(self, run, _):
            captured["run"] = run

    packing.merge_round(Grouped(), 100, 1, 8, True)
    done = captured["run"](rows)
    assert done["host"].tolist() == [2**55 + 1, 2**55 + 1, 2**55 + 3] and done["base"].tolist() == [0, 60, 0]


@pytest.mark.parametrize("limit", [2, 600_000])
@pytest.mark.parametrize("text", [
    "a\x01b \x01 c", "Don't STOP 123 <|endoftext|> it's", "Ünïcödé x y İstanbul Σας", "a\x0bb\x0cc\x1cd é Å", "日本語 テスト 한국어", "x" * 500, "'s 'S we'LL",
])
def test_word_table_equals_the_tokenizer(reference_tokenizer, text, limit):
    known = WordIds(packing.default_tokenizer(), limit=limit)
    texts = [text, None, "some other words", text]
    for _ in range(2):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in known.of_all([t and t.encode() for t in texts])]
        assert got == [reference_tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_new_words_come_from_their_runs(reference_tokenizer):
    """Words that differ in their signs and digits alone share the runs that are encoded."""
    stems = ["Straße", "don't", "word", "naïve", "e\u0301a"]
    texts = [" ".join(f"{a}{s}{b}" for s in stems for a in ("", "(", "12", "('") for b in ("", ",", "...", "-x3", "é!", "'s", "=\u0338"))]
    known, encoded = WordIds(packing.default_tokenizer()), []
    for name in ("encode_into", "encode_runs"):
        plain = getattr(known, name)
        setattr(known, name, lambda kept, words, plain=plain: (encoded.extend(words), plain(kept, words))[1])
    got = [np.frombuffer(ids, "<u4").tolist() for ids in known.of_all([t.encode() for t in texts])]
    assert got == [reference_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert b"word..." in known and b"word..." not in encoded and encoded.count(b"word") == 1
    assert len(encoded) == len(set(encoded)) < len(set(texts[0].split()))


def test_word_table_on_real_texts(spark, reference_tokenizer):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    got = WordIds(packing.default_tokenizer()).of_all([t.encode() for t in texts])
    want = [e.ids for e in reference_tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def test_all_underfull_bins_of_large_leaves_meet(spark, reference_tokenizer):
    """Ordered by source: one leaf of long and one of short documents, more than 4,096 each, that only fill sequences together."""
    assert len(ids_of(reference_tokenizer, "word " * 10)) == 11
    frame = spark.range(0, 12_000, 1, 2).selectExpr("id as doc_id", "repeat('word ', if(id < 6000, 10, 8)) as text")
    rows = packing.pack(frame, capacity=20, slack=1).collect()
    documents = [(i, "word " * (10 if i < 6000 else 8)) for i in range(12_000)]
    assert check(rows, documents, reference_tokenizer, 20)[0] == 6000


@pytest.mark.parametrize("longest", [100, 40, 5])
def test_counts_pack_like_single_items(longest):
    lengths = np.random.default_rng(longest).integers(1, longest + 1, 3000)
    values, n = np.unique(lengths, return_counts=True)
    rows = packing.best_fit_counts(dict(zip(values.tolist(), n.tolist(), strict=True)), 100)
    spans = defaultdict(list)
    for length, many in zip(values.tolist(), n.tolist(), strict=True):
        own = sorted(r for r in rows.tolist() if r[0] == length)
        assert own[0][1] == 0
        for (_, rank, first, offset), end in zip(own, [*(r[1] for r in own[1:]), many], strict=True):
            for k in range(end - rank):
                spans[first + k].append((offset, length))
    for placed in spans.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 100
    assert len(spans) == len(packing.best_fit(lengths, 100)[2])


def test_odd_rows(odd_documents, no_documents, reference_tokenizer):
    rows = packing.pack(odd_documents).collect()
    documents = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    check(rows, documents, reference_tokenizer, 2048)
    assert packing.pack(no_documents).count() == 0
