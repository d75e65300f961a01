"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, found by the
forward algorithm; the score of a text is the sum of its words' logarithms. The
probabilities are learnt by expectation maximisation over word counts: every round
is a Spark job in which the tasks run forward and backward passes and emit expected
piece counts, summed by piece and language.

The fit reads a bounded sample: about ``sample_docs`` labelled documents of each
language, chosen by a hash of the id. Prediction reads every text whole.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import store

UNKNOWN = "und"
START = "▁"
LONGEST_PIECE = 10
LONGEST_WORD = 48
SMOOTHING = 0.1
_LETTERS = re.compile(r"[^\W\d_]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def piece_numbers(path: str) -> dict[str, int]:
    """Lower-case pieces of letters in the vocabulary, numbered from 1; 0 is any other character."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    usable = sorted(
        p for p in known
        if len(p) <= LONGEST_PIECE and p == p.lower() and (p == START or p.removeprefix(START).isalpha())
    )
    return {p: k for k, p in enumerate(usable, 1)}


def words_of(text: str | None) -> list[str]:
    """Runs of letters (and signs such as fractions) in lower case; a text without a letter has none."""
    found = _LETTERS.findall((text or "").lower())
    return found if any(map(str.isalpha, found)) else []


def parts_of(word: str) -> list[str]:
    """A word with its start mark; very long ones in parts, so that probabilities stay above zero."""
    marked = START + word
    return [marked[i:i + LONGEST_WORD] for i in range(0, len(marked), LONGEST_WORD)]


def add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``into[rows] += values`` where rows may repeat; flat, which numpy adds much faster than row by row."""
    width = into.shape[1]
    np.add.at(into.reshape(-1), (rows[:, None] * width + np.arange(width)).ravel(), values.ravel())


class Lattice:
    """Pieces of words of one length: ``at[end][length]`` has a piece number for every word, -1 where none fits."""

    def __init__(self, words: Sequence[str], pieces: dict[str, int]):
        self.length = len(words[0])
        self.at: list[dict[int, np.ndarray]] = [{}]
        for end in range(1, self.length + 1):
            here = {}
            for size in range(1, min(end, LONGEST_PIECE) + 1):
                other = 0 if size == 1 else -1
                numbers = np.array([pieces.get(w[end - size:end], other) for w in words])
                if size == 1 or (numbers >= 0).any():
                    here[size] = numbers
            self.at.append(here)

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """(position, word, language): summed probability of all segmentations up to a position."""
        n = len(self.at[1][1])
        alpha = np.zeros((self.length + 1, n, probability.shape[1]))
        alpha[0] = 1
        for end in range(1, self.length + 1):
            for size, numbers in self.at[end].items():
                alpha[end] += alpha[end - size] * probability[numbers]
        return alpha

    def expected(self, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece by language; ``counts`` has the words' counts by language."""
        alpha = self.forward(probability)
        beta = np.zeros_like(alpha)
        beta[self.length] = counts / alpha[self.length]
        uses = np.zeros_like(probability)
        for end in range(self.length, 0, -1):
            for size, numbers in self.at[end].items():
                step = probability[numbers] * beta[end]
                add_rows(uses, numbers, alpha[end - size] * step)
                beta[end - size] += step
        uses[-1] = 0
        return uses


def by_length(words: Sequence[str]) -> Iterator[list[int]]:
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    for same in groups.values():
        for i in range(0, len(same), 20_000):
            yield same[i:i + 20_000]


class Scorer:
    """Log probabilities of words by language; a bounded table of words already seen."""

    def __init__(self, pieces: dict[str, int], probability: np.ndarray, limit: int = 400_000):
        self.pieces, self.limit = pieces, limit
        # The last row is the piece that does not fit: probability 0.
        self.probability = np.vstack([probability, np.zeros(probability.shape[1])])
        self.number: dict[str, int] = {}
        self.table = np.empty((0, probability.shape[1]))

    def add(self, words: Sequence[str]) -> None:
        parts, owner = [], []
        for k, w in enumerate(words):
            cut = parts_of(w)
            parts += cut
            owner += [k] * len(cut)
        sums = np.zeros((len(words), self.table.shape[1]))
        owners = np.array(owner)
        for same in by_length(parts):
            lattice = Lattice([parts[k] for k in same], self.pieces)
            add_rows(sums, owners[same], np.log(lattice.forward(self.probability)[-1]))
        self.number |= {w: len(self.table) + k for k, w in enumerate(words)}
        self.table = np.vstack([self.table, sums])

    def score(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words, and summed log probabilities by language, of every text."""
        if len(self.number) > self.limit:
            self.number, self.table = {}, self.table[:0]
        found = [words_of(t) for t in texts]
        if new := list({w for words in found for w in words if w not in self.number}):
            self.add(new)
        sizes = np.array([len(w) for w in found])
        sums = np.zeros((len(texts), self.table.shape[1]))
        for k, words in enumerate(found):
            if words:
                sums[k] = self.table[[self.number[w] for w in words]].sum(0)
        return sizes, sums


# Fit


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) of the columns lang and body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "body")), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in counts.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(list(words), pa.string()),
                "n": pa.array(list(words.values()), pa.int64()),
            })

    return labelled.select("lang", "body").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def bounded_sample(labelled: DataFrame, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` rows of each language, chosen by a hash of ``id``; rare languages keep all."""
    totals = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    share = F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("total"))
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e6
    # One row for each language, of which the model holds a column each: texts are not shuffled to meet it.
    shares = F.broadcast(totals.select("lang", share.alias("share")))
    return labelled.join(shares, "lang").where(draw < F.col("share")).select("lang", "body")


def fit(labelled: DataFrame, vocabulary: str, sample_docs: int, rounds: int) -> tuple[list[str], np.ndarray]:
    """Languages, and piece probabilities (piece, language). ``labelled``: id, lang, body, without NULLs."""
    counts = store(word_counts(bounded_sample(labelled, sample_docs)), "langid-words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    size = max(piece_numbers(vocabulary).values()) + 1
    probability = np.full((size, max(1, len(langs))), 1 / size)
    for _ in range(rounds if langs else 0):
        sent = counts.sparkSession.sparkContext.broadcast(probability)
        expected = counts.mapInArrow(_expectation(sent, langs, vocabulary), "piece int, lang int, uses double")
        # At most one row for each piece of the vocabulary and language.
        summed = expected.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full_like(probability, SMOOTHING)
        np.add.at(uses, (summed["piece"].to_numpy(), summed["lang"].to_numpy()), summed["uses"].to_numpy())
        probability = uses / uses.sum(0)
    return langs, probability


def _expectation(sent, langs: list[str], vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, column = piece_numbers(vocabulary), {lang: k for k, lang in enumerate(langs)}
        probability = np.vstack([sent.value, np.zeros(len(langs))])
        uses = np.zeros_like(probability)
        for batch in batches:
            rows = [
                (part, column[lang], n)
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True)
                for part in parts_of(word)
            ]
            parts = [r[0] for r in rows]
            for same in by_length(parts):
                weights = np.zeros((len(same), len(langs)))
                weights[np.arange(len(same)), [rows[k][1] for k in same]] = [rows[k][2] for k in same]
                uses += Lattice([parts[k] for k in same], pieces).expected(probability, weights)
        piece, lang = np.nonzero(uses)
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(piece.astype(np.int32)), "lang": pa.array(lang.astype(np.int32)), "uses": pa.array(uses[piece, lang]),
        })

    return run


# Prediction

_SCORERS: dict[str, Scorer] = {}
EVIDENCE_WORDS = 8
#: Texts that are split into words at a time.
SLICE_ROWS = 500


def likeliest(sizes: np.ndarray, sums: np.ndarray, langs: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """Language and its share of the likelihood, at the evidence of at most EVIDENCE_WORDS mean words."""
    if not langs:
        return [UNKNOWN] * len(sizes), np.zeros(len(sizes))
    mean = sums / np.maximum(1, sizes / EVIDENCE_WORDS)[:, None]
    odds = np.exp(mean - mean.max(1, keepdims=True))
    best = sums.argmax(1)
    score = odds[np.arange(len(best)), best] / odds.sum(1)
    return [langs[b] if n else UNKNOWN for b, n in zip(best, sizes, strict=True)], np.where(sizes > 0, score, 0.0)


def identify(
    documents: DataFrame,
    learn_from: Column,
    carry: Sequence[str] = ("doc_id",),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    vocabulary: str | None = None,
    sample_docs: int = 2_000,
    rounds: int = 2,
) -> DataFrame:
    """The ``carry`` columns, ``lang_pred`` and ``score`` (0 to 1) of every row.

    Learns from rows where ``learn_from`` holds and language and text are not NULL.
    Texts that are NULL or hold no letter are ``und`` with score 0, and so is every
    text when nothing can be learnt. Equal likelihoods: the first language by name.
    Repeated rows each give a row; other columns are not read.
    """
    vocabulary = vocabulary or default_vocabulary()
    labelled = documents.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("body"),
    )
    langs, probability = fit(labelled, vocabulary, sample_docs, rounds)
    sent = documents.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, probability))
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([
        picked.schema["kept"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, learnt = sent.value
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(piece_numbers(vocabulary), learnt)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                lang, score = likeliest(*_SCORERS[name].score(batch.column("body").to_pylist()), langs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("kept"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=schema.names,
                )

    return picked.mapInArrow(run, schema).select("kept.*", "lang_pred", "score")
