"""Text helpers that several operators share."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes that may stand in a word of the decontamination rule: digits, letters, everything beyond ASCII.
_INSIDE = [0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 for c in range(256)]
_LOWER = [c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)]
#: Lower-cases A-Z and turns every byte outside words into one space, byte for byte, so offsets stay valid.
WORDS_ONLY = bytes(low if _INSIDE[low] else 0x20 for low in _LOWER)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def bucket_of_id(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def word_edges(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last byte of each word in words joined by single spaces (not empty)."""
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


#: The rule of tokenizers that split words into runs of letters, single digits and runs of other signs.
RUNS_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A lower-case word that this rule is sure to cut into one run of letters (ASCII, or U+00C0 to U+00FF) and one of signs, if any.
_RUNS = re.compile(rb"((?:[a-z]++|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])++)([!-&(-/:-@\[-`{-~]*+)")


def cuts_runs(loaded) -> bool:
    """Does the tokenizer cut words by ``RUNS_RULE``, so that the ids of a word are those of its runs, each closed by one id?"""
    if not loaded.pre_tokenizer or not loaded.normalizer or not all(t.special for t in loaded.get_added_tokens_decoder().values()):
        return False
    if not getattr(loaded.model, "end_of_word_suffix", None):
        return False
    steps = json.loads(loaded.pre_tokenizer.__getstate__()).get("pretokenizers", [None])
    rule = {"type": "Split", "pattern": {"Regex": RUNS_RULE}, "behavior": "Removed", "invert": True}
    alone = all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in steps[1:])
    space = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    changes = json.loads(loaded.normalizer.__getstate__()).get("normalizers", [None])
    return steps[0] == rule and alone and all(c in ({"type": "NFC"}, {"type": "Lowercase"}, space) for c in changes)


class WordIds(dict):
    """Ids of white-space separated words as little-endian unsigned 32-bit numbers, filled on demand.

    The tokenizer never merges across white space, so the ids of a text are the
    ids of its words in order. Where it cuts words into runs as well, most new words are put together from the
    ids of their letters and of the signs behind them. The memory is bounded: long words are not kept, and
    once ``limit`` words (or runs) are kept, new ones stay only for the texts at hand.
    """

    #: Stands between new words that are encoded in one go; it is a word of its own with one id.
    MARK = "\x01"

    def __init__(self, path: str, limit: int = 500_000, longest: int = 64):
        super().__init__()
        self.tokenizer, self.limit, self.longest = tokenizer(path), limit, longest
        self.mark_ids = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.by_runs, self.runs = cuts_runs(self.tokenizer), {}
        if self.by_runs:
            end, words = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab()
            self.closing = np.zeros(max(words.values()) + 1, bool)
            self.closing[[i for w, i in words.items() if w.endswith(end)]] = True

    def __missing__(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Keep the ids of new words. Words that hold the mark, and long ones, are left to be encoded each time."""
        mark = self.MARK.encode()
        short = [w for w in words if len(w) <= self.longest and mark not in w]
        if len(self.mark_ids) != 1:
            self.update((w, self[w]) for w in short)
            return
        if not self.by_runs:
            self.encode_into(self, short)
            return
        cut = [(w, *m.groups()) for w in short if (m := _RUNS.fullmatch(w))]
        runs = self.runs
        self.encode_runs(runs, [r for r in {r for _, *both in cut for r in both} if r not in runs])
        self.update((w, runs[letters] + runs[signs] if signs else runs[letters]) for w, letters, signs in cut)
        self.encode_into(self, [w for w in short if w not in self])
        if len(runs) > self.limit:
            # The next texts bring the common ones back.
            runs.clear()

    def encode_runs(self, kept: dict[bytes, bytes], new: list[bytes]) -> None:
        """Ids of single runs; the last id of each closes a word, so none has to be marked off."""
        new = [r for r in new if r]
        for at in range(0, len(new), 2000):
            part = new[at:at + 2000]
            ids = np.asarray(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.closing[ids]) + 1) * 4
            if len(ends) != len(part):
                self.encode_into(kept, part)
                continue
            packed = ids.tobytes()
            kept.update(zip(part, (packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)), strict=True))

    def encode_into(self, kept: dict[bytes, bytes], short: list[bytes]) -> None:
        """Ids of any short words, each marked off."""
        for at in range(0, len(short), 20_000):
            part = short[at:at + 20_000]
            joined = f" {self.MARK} ".join(w.decode("utf-8", "replace") for w in part)
            ids = np.asarray(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark_ids[0])
            starts, ends = np.concatenate(([0], cuts + 1)) * 4, np.concatenate((cuts, [len(ids)])) * 4
            packed = ids.tobytes()
            kept.update(zip(part, (packed[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), strict=True))

    def of_all(self, texts: Sequence[bytes | None]) -> list[bytes]:
        """Packed ids of every text; NULL counts as empty."""
        out = []
        for at in range(0, len(texts), 500):
            # Lower-casing A-Z is what the tokenizer does first; it keeps the table small.
            split = [(t or b"").lower().split() for t in texts[at:at + 500]]
            found = [list(map(self.get, words)) for words in split]
            new = {w for words, ids in zip(split, found, strict=True) if None in ids for w, i in zip(words, ids, strict=True) if i is None}
            self.learn(new)
            for words, ids in zip(split, found, strict=True):
                whole = [self[w] if i is None else i for w, i in zip(words, ids, strict=True)] if None in ids else ids
                out.append(b"".join(whole))
            if len(self) > self.limit:
                for w in new:
                    self.pop(w, None)
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
