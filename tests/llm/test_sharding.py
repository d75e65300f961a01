import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import sharding
from tidemark.llm.queries import op7_shard, table

SMALL = "/root/testdata/sf0.001"


def brute_capacity(sizes, shards):
    """Smallest capacity by trying all prefix differences' greedy partitions."""
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > middle:
                used, filled = used + 1, 0
            filled += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check(rows, documents, shards):
    texts = dict(documents)
    slots, by_text, load = defaultdict(list), {}, [0] * shards
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.size == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        assert 0 <= r.shard < shards and by_text.setdefault(text, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert len(rows) == len(documents)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def group_sizes(spark, documents):
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    rows = frame.select(sharding.group_key(frame.text).alias("key"), sharding.text_size(frame.text).alias("size")).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.key] += r["size"]
    return [sizes[k] for k in sorted(sizes)], frame


def test_query(spark):
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    rows = op7_shard(spark, SMALL).collect()
    load = check(rows, documents, 8)
    sizes, _ = group_sizes(spark, documents)
    assert max(load) <= brute_capacity(sizes, 8)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_minimal(spark, seed, monkeypatch):
    monkeypatch.setattr(sharding, "STEP_BITS", (2, 3, 10)[seed % 3])
    rng = random.Random(seed)
    n = rng.choice([3, 40, 400])
    documents = [(i, f"text {i} " * rng.choice([1, 3, 50])) for i in range(n)]
    if seed % 2:
        documents += [(n + k, "one very common text " * 5) for k in range(n // 2)]
    shards = rng.choice([2, 5, 8])
    sizes, frame = group_sizes(spark, documents)
    grouped = frame.select(sharding.group_key(frame.text).alias("key"), sharding.text_size(frame.text).alias("size")).groupBy("key").sum("size").toDF("key", "size")
    cuts, capacity = sharding.cut_keys(grouped, shards)
    assert capacity == brute_capacity(sizes, shards)
    load = check(sharding.shard(frame, shards).collect(), documents, shards)
    assert max(load) <= capacity and len(cuts) < shards


def test_odd_rows(odd_documents, no_documents, spark):
    rows = sharding.shard(odd_documents, 3).collect()
    assert len(rows) == 10
    of = {r.doc_id: r for r in rows}
    assert of[1].size == of[2].size == 1 and of[1].shard == of[2].shard and of[4].shard == of[5].shard
    assert sharding.shard(no_documents, 3).count() == 0
