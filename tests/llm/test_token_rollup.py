import zlib
from collections import Counter

from tokenizers import Tokenizer

from tidemark.llm import packing, token_rollup
from tidemark.llm.queries import op4_token_rollup, table
from tidemark.sources.scratch import fresh_path

SMALL = "/root/testdata/sf0.001"


def as_dict(frame):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in frame.collect()}


def counted(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, n_tokens long")


def test_deltas_add_up_and_repeat_safely(spark):
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "rollup"))
    assert as_dict(rollup.totals()) == {}
    old = counted(spark, [("a", "en", 5), ("a", "en", 7), (None, None, 3), ("b", "de", 0)])
    new = counted(spark, [("a", "fr", 6)])
    assert rollup.commit("1", token_rollup.changes(old, "v1", 1))
    assert not rollup.commit("1", token_rollup.changes(old, "v1", 1))
    assert rollup.commit("2", token_rollup.revisions(old.where("n_tokens = 5"), new, "v1", "v2"))
    want = {("a", "en", "v1"): (1, 7), (None, None, "v1"): (1, 3), ("b", "de", "v1"): (1, 0), ("a", "fr", "v2"): (1, 6)}
    assert as_dict(rollup.totals()) == want
    rollup.compact()
    assert as_dict(rollup.totals()) == want and rollup.committed() == ["1", "2"]
    assert not rollup.commit("2", token_rollup.changes(old, "v1", 1))
    assert rollup.commit("3", token_rollup.changes(old.where("source is null or n_tokens = 0"), "v1", -1))
    rollup.compact()
    assert as_dict(rollup.totals()) == {("a", "en", "v1"): (1, 7), ("a", "fr", "v2"): (1, 6)}
    assert as_dict(token_rollup.Rollup(spark, rollup.folder).totals()) == as_dict(rollup.totals())


def test_an_abandoned_attempt_counts_for_nothing(spark):
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "rollup"))
    rows = token_rollup.changes(counted(spark, [("a", "en", 5)]), "v1", 1)
    token_rollup.summed(rows).write.parquet(f"{rollup.folder}/attempts/1-dead")
    assert as_dict(rollup.totals()) == {}
    assert rollup.commit("1", rows) and as_dict(rollup.totals()) == {("a", "en", "v1"): (1, 5)}


def test_query_against_brute_force(spark):
    encode = Tokenizer.from_file(packing.default_tokenizer()).encode
    rows = table(spark, SMALL, "documents").collect()
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(r.text or "", r.doc_id)
    documents, tokens = Counter(), Counter()
    for r in rows:
        if first[r.text or ""] == r.doc_id:
            moved = zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            key = (r.source, r.lang, "word_bpe_49k+end" if moved else "word_bpe_49k")
            documents[key] += 1
            tokens[key] += len(encode(r.text or "", add_special_tokens=False).ids) + moved
    assert as_dict(op4_token_rollup(spark, SMALL)) == {k: (documents[k], tokens[k]) for k in documents}


def test_odd_rows(odd_documents, no_documents):
    counts = token_rollup.token_counts(odd_documents, packing.default_tokenizer())
    of = {r.doc_id: r.n_tokens for r in counts.collect()}
    assert of[1] == of[2] == of[3] == 0 and of[4] == of[5] > 60_000 and counts.count() == 10
    assert token_rollup.token_counts(no_documents, packing.default_tokenizer()).count() == 0


def test_of_two_writers_of_a_batch_one_commits(spark, monkeypatch):
    first, second = (token_rollup.Rollup(spark, folder) for folder in [fresh_path(spark, "rollup")] * 2)
    rows = token_rollup.changes(counted(spark, [("a", "en", 5)]), "v1", 1)
    # The second one looked before the first one was done.
    monkeypatch.setattr(second, "committed", list)
    assert first.commit("1", rows) and not second.commit("1", rows)
    assert as_dict(first.totals()) == {("a", "en", "v1"): (1, 5)}
    assert second._names("committed") == ["1"] and second._names("attempts") == []
    first.compact()
    monkeypatch.setattr(second, "_names", lambda kind: [] if kind == "base" else token_rollup.Rollup._names(second, kind))
    second.compact()
    assert as_dict(first.totals()) == {("a", "en", "v1"): (1, 5)} and len(first._names("base")) == 1


def test_query_with_missing_and_repeated_ids(spark, tmp_path):
    rows = [(1, "a b"), (None, "a b"), (None, "c d e"), (None, "c d e"), (2, "a b"), (3, "f"), (3, "f")]
    spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    encode = Tokenizer.from_file(packing.default_tokenizer()).encode
    size = {t: len(encode(t, add_special_tokens=False).ids) for _, t in rows}
    documents, tokens = Counter(), Counter()
    for doc_id, text in [(1, "a b"), (None, "c d e"), (None, "c d e"), (3, "f"), (3, "f")]:
        moved = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        key = ("s", "en", "word_bpe_49k+end" if moved else "word_bpe_49k")
        documents[key] += 1
        tokens[key] += size[text] + moved
    assert as_dict(op4_token_rollup(spark, str(tmp_path))) == {k: (documents[k], tokens[k]) for k in documents}
