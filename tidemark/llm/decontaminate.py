"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the benchmark.

Items and documents are normalised alike: A-Z lower-cased, every byte outside a
word a separator. Each run of ``window`` item words (or the whole item, when it is
shorter) is a pattern; the automaton finds all of them in one pass over the
document. Matches are mapped to word numbers and to character offsets of the
original text.

The automaton is built in the Python workers from broadcast item texts. A broadcast
holds at most about ``block_bytes`` of patterns: a larger benchmark is dealt by hash
into more blocks, and every block is scanned, so memory is bounded and no item is
left out. A worker then gathers about ``buffer_bytes`` of documents before it turns to the
next block, so that an automaton is built once for all of them, not once a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.texts import WORDS_ONLY, raw_texts

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
])
_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def normalise(text: bytes) -> bytes:
    return b" ".join(text.translate(WORDS_ONLY).split())


def item_windows(text: bytes, window: int) -> set[bytes]:
    words = text.translate(WORDS_ONLY).split()
    if not words:
        return set()
    return {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))}


class Windows:
    """The automaton of one block of items."""

    def __init__(self, items: Sequence[tuple[str, bytes]], window: int):
        import ahocorasick

        owners: dict[bytes, set[str]] = {}
        for item_id, text in items:
            for w in item_windows(text, window):
                owners.setdefault(w, set()).add(item_id)
        self.owners = list(owners.values())
        self.lengths = [w.count(b" ") + 1 for w in owners]
        self.automaton = ahocorasick.Automaton()
        for k, w in enumerate(owners):
            # One character a byte; the spaces around keep matches on word borders.
            self.automaton.add_word(f" {w.decode('latin-1')} ", k)
        self.automaton.make_automaton()

    def matches(self, padded: str) -> list[tuple[int, int]]:
        return list(self.automaton.iter(padded)) if self.owners else []


_BUILT: dict[str, Windows] = {}


def _built(block, window: int) -> Windows:
    """The automaton of a broadcast block; a worker keeps one at a time."""
    name, items = block
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Windows(items.value, window)
    return _BUILT[name]


def _covered(padded: bytes, matches: list[tuple[int, int]], lengths: list[int]) -> np.ndarray:
    """Which words lie in a match. A match ends on the space behind its last word."""
    spaces = np.cumsum(np.frombuffer(padded, np.uint8) == 0x20)
    ends = spaces[np.fromiter((e for e, _ in matches), np.int64, len(matches))] - 1
    starts = ends - np.fromiter((lengths[k] for _, k in matches), np.int64, len(matches))
    steps = np.zeros(int(spaces[-1]), np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps)[:-1] > 0


def _spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Character offsets in the original text of the runs of hit words."""
    inside = np.frombuffer(text.translate(WORDS_ONLY), np.uint8) != 0x20
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    runs = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    begins, ends = first[np.flatnonzero(runs == 1)], last[np.flatnonzero(runs == -1) - 1]
    # Continuation bytes do not start a character.
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"begin": int(chars[b]), "end": int(chars[e])} for b, e in zip(begins, ends, strict=True)]


def _scan_blocks(texts: list[bytes | None], blocks: list, window: int) -> list[tuple]:
    """Words, hit words, items and spans of each text, block by block with one automaton in memory at a time."""
    hits: list[np.ndarray | None] = [None] * len(texts)
    items: list[set[str]] = [set() for _ in texts]
    padded = [b" " + normalise(t or b"") + b" " for t in texts]
    # The automaton that the last call left comes first, so each further one is built once a call.
    for block in sorted(blocks, key=lambda b: b[0] not in _BUILT):
        windows = _built(block, window)
        for k, p in enumerate(padded):
            if len(p) > 2 and (matches := windows.matches(p.decode("latin-1"))):
                covered = _covered(p, matches, windows.lengths)
                hits[k] = covered if hits[k] is None else hits[k] | covered
                for m in {m for _, m in matches}:
                    items[k] |= windows.owners[m]
    return [
        (p.count(b" ") - 1 if len(p) > 2 else 0, 0 if h is None else int(h.sum()), sorted(i), [] if h is None else _spans(t, h))
        for t, p, h, i in zip(texts, padded, hits, items, strict=True)
    ]


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about ``most`` bytes."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.nbytes
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scanned(batches: Iterator[pa.RecordBatch], blocks: list, window: int, buffer_bytes: int) -> Iterator[pa.RecordBatch]:
    """``kept`` and ``found`` of every row. With more than one block, texts wait for each other, not for each automaton."""
    for group in _gathered(batches, buffer_bytes if len(blocks) > 1 else 0):
        texts = [t for batch in group for t in raw_texts(batch.column("body"))]
        rows = iter(_scan_blocks(texts, blocks, window))
        for batch in group:
            own = [next(rows) for _ in range(batch.num_rows)]
            n_words, n_hit, items, spans = (list(x) for x in zip(*own, strict=True)) if own else ([], [], [], [])
            found = pa.StructArray.from_arrays([
                pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPAN),
            ], names=FOUND.names)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), found], names=["kept", "found"])


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> list:
    """Names and broadcast item texts, at most about ``block_bytes`` of patterns in each."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.col(text_col).alias("item_text"),
    ).where(F.col("item_text").isNotNull()).distinct()
    # Overlapping windows repeat a text about ``window`` times.
    total = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    n = -(-total * window // block_bytes) or 1
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "item_text"), F.lit(n)))
    context = benchmark.sparkSession.sparkContext
    return [
        (uuid.uuid4().hex, context.broadcast([(r.item_id, r.item_text.encode()) for r in dealt.where(F.col("block") == k).collect()]))
        for k in range(n)
    ]


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = 4_000_000,
    buffer_bytes: int = 32_000_000,
) -> DataFrame:
    """The ``carry`` columns of every document with a struct ``found``.

    ``found`` holds the number of words, of words inside an occurring window, the
    items concerned (sorted strings) and the spans of the original text in characters
    (end exclusive). NULL and empty texts have no words; repeated rows each give a
    row; items without words, with NULL text, or an empty benchmark match nothing;
    items that repeat count once; a NULL item id counts as empty text. The input's
    other columns are not read, so their names cannot clash.
    """
    blocks = item_blocks(benchmark, item_id, item_text, window, block_bytes)
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("found", FOUND)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scanned(batches, blocks, window, buffer_bytes)

    return picked.mapInArrow(scan, schema).select("kept.*", "found")
