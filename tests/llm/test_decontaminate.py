import hashlib
import re

import pyarrow as pa
import pytest

from tidemark.llm import decontaminate
from tidemark.llm.queries import op1_decontaminate
from tidemark.llm.texts import word_edges

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(documents, items, window=10):
    """doc -> (words, hit words, items), by comparing every position with every window."""
    windows = []
    for item_id, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows.append((str(item_id), words[i:i + window]))
    out = []
    for doc_id, text in documents:
        words = WORD.findall(lowered(text))
        hit, found = set(), set()
        for item_id, w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    found.add(item_id)
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return out


def rows_of(frame):
    return [(r.doc_id, r.found.n_words, r.found.n_hit, list(r.found.item_ids)) for r in frame.collect()]


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away."), (2, "short one"), (3, None), (4, "..."),
    (10, "the QUICK brown fox jumps over the lazy dog and runs"), (2, "short one"), (5, "été à la plage"),
]
TEXTS = [
    (1, "xx the quick, brown fox jumps over the lazy dog and runs far AWAY yy"), (2, "short\none, short one"), (3, None), (4, ""),
    (5, "the quick brown fox jumps over the lazy dog"), (6, "a short one2"), (7, "Oh: été à la plage!"), (7, "Oh: été à la plage!"),
    (8, "the quick brown fox " * 500 + "jumps over the lazy dog and runs"),
]


def test_matches_brute_force(spark):
    documents = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = sorted(brute(TEXTS, ITEMS))
    assert sorted(rows_of(decontaminate.contamination(documents, items))) == expected
    assert {r[0] for r in expected if r[2]} == {1, 2, 7, 8}


def test_blocks_give_the_same(spark):
    documents = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert len(decontaminate.item_blocks(items, "item_id", "text", 10, 300)) > 2
    assert sorted(rows_of(decontaminate.contamination(documents, items, block_bytes=300))) == sorted(brute(TEXTS, ITEMS))


@pytest.mark.parametrize("n_blocks, buffer_bytes, builds", [(1, 10_000_000, 1), (4, 10_000_000, 4), (4, 1, 1 + 3 * 30)])
def test_an_automaton_is_built_once_for_all_gathered_batches(monkeypatch, n_blocks, buffer_bytes, builds):
    built = []

    class Counted(decontaminate.Windows):
        def __init__(self, items, window):
            built.append(len(items))
            super().__init__(items, window)

    class Sent:
        def __init__(self, value):
            self.value = value

    monkeypatch.setattr(decontaminate, "Windows", Counted)
    decontaminate._BUILT.clear()
    items = [(str(i), f"word{i} and word{i + 1} in item {i}".encode()) for i in range(40)]
    blocks = [(f"{n_blocks}-{buffer_bytes}-{k}", Sent(items[k::n_blocks])) for k in range(n_blocks)]
    texts = [f"this is word{i} and word{i + 1} in item {i} again" for i in range(60)]
    batches = [
        pa.RecordBatch.from_pydict({"kept": [{"doc_id": i} for i in range(k, k + 2)], "body": texts[k:k + 2]}) for k in range(0, 60, 2)
    ]
    out = list(decontaminate._scanned(iter(batches), blocks, 10, buffer_bytes))
    decontaminate._BUILT.clear()
    assert len(built) == builds and [b.num_rows for b in out] == [2] * 30
    found = [f["item_ids"] for b in out for f in b.column("found").to_pylist()]
    assert found == [[str(i)] if i < 40 else [] for i in range(60)]


def test_spans_are_offsets_of_the_original(spark):
    documents = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = dict(TEXTS)
    found = {r.doc_id: [texts[r.doc_id][s.begin:s.end] for s in r.found.spans] for r in decontaminate.contamination(documents, items).collect()}
    assert found[1] == ["the quick, brown fox jumps over the lazy dog and runs far AWAY"]
    assert found[2] == ["short\none, short one"] and found[7] == ["été à la plage"] and found[5] == []


def test_query_digest(spark):
    from tidemark.llm.queries import table

    got = {tuple(r) for r in op1_decontaminate(spark, SMALL).collect()}
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    # Brute force over those with any item's first words would do less; this is all against all on the small table.
    expected = {
        (d, w, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, w, h, i in brute(documents, items)
    }
    assert got == expected


def test_odd_rows(odd_documents, no_documents, spark):
    items = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    found = {r.doc_id: r.found for r in decontaminate.contamination(odd_documents, items).collect()}
    assert found[1].n_words == 0 and found[2].n_words == 0 and found[9].n_hit == 3 and found[4].n_words == 60_000
    assert decontaminate.contamination(odd_documents, items).count() == 10
    assert decontaminate.contamination(no_documents, items).count() == 0
    assert all(r.found.n_hit == 0 for r in decontaminate.contamination(odd_documents, items.where("item_id < 0")).collect())


def test_word_edges():
    starts, ends = word_edges(b"ab c def")
    assert list(zip(starts, ends, strict=True)) == [(0, 2), (3, 4), (5, 8)]
