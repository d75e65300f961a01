import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.queries import op3_simhash, table

SMALL = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, most=4):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, doc in enumerate(ids):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return [least[root(i)] for i in range(len(fps))]


def clustered(n, seed):
    """Distinct fingerprints with chains and dense balls among strangers."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        fp = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 40])):
            out.add(fp)
            for _ in range(rng.randrange(1, 6)):
                fp ^= 1 << rng.randrange(64)
    return np.array(sorted(out), np.uint64)


def test_gray_rank_inverts_the_gray_code():
    ranks = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


@pytest.mark.parametrize("turn", [0, 13, 51])
def test_index_finds_exactly_the_pairs(turn):
    fps = clustered(700, turn)
    index = simhash.GrayIndex(fps, turn)
    q, found = index.search(index.fps, 4)
    near = np.bitwise_count(index.fps[:, None] ^ index.fps[None, :]) <= 4
    assert set(zip(q.tolist(), found.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_index_prunes_groups():
    fps = np.unique(np.random.default_rng(1).integers(0, 2**63, 4096).astype(np.uint64))
    index = simhash.GrayIndex(fps, 0)
    assert len(index.bits) == 3
    assert (index.own[1] & index.own[0].repeat(simhash.FAN)[:len(index.own[1])] == 0).all()


@pytest.mark.parametrize("fits", [50_000, 60])
def test_links_connect_as_brute_force(spark, fits):
    fps = clustered(900, 5)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    stars = simhash.components(simhash.links(frame, 4, bucket=128, fits=fits))
    roots = {r.node: r.root for r in stars.collect()}
    signed = fps.view(np.int64).tolist()
    got = [roots.get(x, x) for x in signed]
    want = brute_components(fps.tolist(), signed)
    assert got == want


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_query_against_brute_force(spark):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in documents]
    parts = brute_components(fps, [d for d, _ in documents])
    expected = {(d, f"{fp:016x}", c) for (d, _), fp, c in zip(documents, fps, parts, strict=True)}
    assert {tuple(r) for r in op3_simhash(spark, SMALL).collect()} == expected
    assert any(c != d for (d, _), c in zip(documents, parts, strict=True))


def test_odd_rows(odd_documents, no_documents):
    found = sorted(simhash.near_duplicates(odd_documents).collect())
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 10 and [by_id[k].fp for k in (1, 2, 3)] == [0, 0, 0]
    assert {by_id[k].component_id for k in (1, 2, 3)} == {1} and by_id[5].component_id == 4
    assert simhash.near_duplicates(no_documents).count() == 0
    kept = simhash.first_of_each_group(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [1, 4, 6, 7, 8, 9]
    assert simhash.first_of_each_group(no_documents).count() == 0


def test_null_ids(spark):
    rows = spark.createDataFrame([(None, "same text"), (7, "same text"), (None, "other words here")], "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(rows).collect()}
    assert found == {(None, 7), (7, 7), (None, None)}
