"""Main text of web pages: a recurrent labeller of text blocks.

A page is a sequence of leaf blocks, each with the path of elements above it and its
text. A bidirectional LSTM in numpy reads for every block a vector of its hashed
tag path (element names, classes, ids), its hashed words and a few sizes, and labels
every block as content or not with the whole page as context.

The labeller is trained here, on a bounded sample of pages labelled by their own
structure (what stands in the article and not in navigation, adverts, footers, forms or
comments; in a table without articles, by the density of the text). Every sampled page is also shown in disguise, with other wrappers and with
added boxes of boilerplate, so that the labeller learns more than one page layout.
"""

from __future__ import annotations

import html
import re
import uuid
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("head script style template noscript iframe object svg math select textarea button title".split())
#: Elements whose start ends an open element of the same kind, as their end tags may be left out.
SELF_CLOSING = {
    "li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
}
RAW = frozenset("script style textarea title noscript template iframe svg".split())
_OPENING = re.compile(r"<(?:!--|(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)|[!?/])")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)")
_QUOTES = re.compile(r"[>\"']")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)


class Path:
    """Marks from the root to an element; an element shares the path of its parent."""

    __slots__ = ("above", "mark")

    def __init__(self, above: Path | None, mark: str):
        self.above, self.mark = above, mark

    @staticmethod
    def of(marks: Sequence[str]) -> Path | None:
        path = None
        for mark in marks:
            path = Path(path, mark)
        return path


def upwards(path: Path | None) -> Iterator[str]:
    """Marks of a path, the innermost first."""
    while path:
        yield path.mark
        path = path.above


TAG_DIMS, WORD_DIMS, SIZES = 96, 48, 6
DIMS = TAG_DIMS + WORD_DIMS + SIZES


@lru_cache(maxsize=100_000)
def _place(word: str, dims: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % dims


def tag_vector(path: Path | None, counts: Sequence[int]) -> np.ndarray:
    """Half the counts of all hashed marks, and as much again for the six innermost."""
    row = list(counts)
    for _ in range(6):
        if path is None:
            break
        row[_place(path.mark, TAG_DIMS)] += 1
        path = path.above
    return np.array(row, np.float32) * np.float32(0.5)


@dataclass
class Block:
    place: Path | None
    text: str
    linked: int
    tags: np.ndarray

    @staticmethod
    def of(marks: Sequence[str], text: str, linked: int) -> Block:
        counts = np.bincount([_place(m, TAG_DIMS) for m in marks], minlength=TAG_DIMS).tolist()
        place = Path.of(marks)
        return Block(place, text, linked, tag_vector(place, counts))

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(upwards(self.place))[::-1]


class _Reader:
    """Leaf blocks of a page in order; forgiving about tags that are not closed.

    What the open elements add up to is kept as running counts, so that a block costs
    the same at any depth.
    """

    def __init__(self):
        self.stack: list[tuple[str, Path | None, tuple[str, ...]]] = []
        self.where: dict[str, list[int]] = defaultdict(list)  # places in the stack of the open elements of a name
        self.path: Path | None = None
        self.counts = [0] * TAG_DIMS
        self.unseen = 0
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.blocks.append(Block(self.path, text, self.linked, tag_vector(self.path, self.counts)))
        self.pieces, self.linked = [], 0

    def data(self, raw: str) -> None:
        if raw and not self.unseen:
            text = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.where["a"]:
                self.linked += len(text)

    def innermost(self, names: Sequence[str]) -> int:
        return max((self.where[n][-1] for n in names if self.where[n]), default=-1)

    def close(self, names: Sequence[str], within: Sequence[str]) -> None:
        at = self.innermost(names)
        if at >= 0 and at >= self.innermost(within):
            while len(self.stack) > at:
                name, self.path, marks = self.stack.pop()
                self.where[name].pop()
                self.weigh(name, marks, -1)

    def weigh(self, name: str, marks: tuple[str, ...], sign: int) -> None:
        for mark in marks:
            self.counts[_place(mark, TAG_DIMS)] += sign
        self.unseen += sign * (name in UNSEEN or "hidden!" in marks)

    def start(self, name: str, rest: str) -> None:
        if name not in INLINE:
            self.flush()
            # A block element ends an open paragraph, also one with unclosed inline elements.
            self.close(("p",), ("table", "td", "th", "div", "article", "section", "body", "blockquote", "button"))
            if name in SELF_CLOSING:
                names, within = SELF_CLOSING[name]
                self.close(names.split(), within)
        elif name == "br":
            self.pieces.append(" ")
        if name in VOID or rest.endswith("/"):
            return
        marks = [name]
        if "=" in rest or "hidden" in rest:
            for groups in _MARKS.findall(rest):
                marks += ["." + m for m in "".join(groups).lower().split()]
            if _HIDDEN.search(rest):
                marks.append("hidden!")
        self.where[name].append(len(self.stack))
        self.stack.append((name, self.path, tuple(marks)))
        for mark in marks:
            self.path = Path(self.path, mark)
        self.weigh(name, tuple(marks), 1)

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
        self.close((name,), ("td", "th", "li") if name in INLINE else ())


class _TagEnds:
    """Where a tag ends, in time linear in the page, also if quotes are never closed.

    The usual tag is matched as it is. The first that has no end, which a match
    learns only at the end of the page, makes a table of the ends behind every quote.
    """

    def __init__(self, page: str):
        self.page = page
        self.signs: list[int] | None = None

    def find(self, at: int) -> int:
        """The place of the > that ends the tag whose name ends at ``at``, or -1."""
        if self.signs is None:
            if found := _REST.match(self.page, at):
                return found.end()
            self.signs = [m.start() for m in _QUOTES.finditer(self.page)]
            plain = double = single = -1
            ends = []
            for k in reversed(self.signs):
                sign = self.page[k]
                if sign == ">":
                    plain = k
                elif sign == '"':
                    plain, double = double, plain
                else:
                    plain, single = single, plain
                ends.append(plain)
            self.ends = [*ends[::-1], -1]
        return self.ends[bisect_left(self.signs, at)]


def blocks_of(page: str | None) -> list[Block]:
    """Text blocks in page order with their paths; empty for NULL, empty and text-free pages.

    A tag without an end is text; a comment, script or other raw element without one
    reaches to the end of the page. Time and memory are linear in the page.
    """
    page = page or ""
    reader, ends, at, look = _Reader(), _TagEnds(page), 0, 0
    last = page.rfind(">")
    while token := _OPENING.search(page, look):
        name = (token["name"] or "").lower()
        if page.startswith("<!--", token.start()):
            end = page.find("-->", token.end())
            end = len(page) if end < 0 else end + 3
        else:
            end = ends.find(token.end()) if name else page.find(">", token.end()) if token.end() <= last else -1
            if end < 0:
                look = token.end()
                continue
            end += 1
        reader.data(page[at:token.start()])
        if name in RAW and not token["end"]:
            closing = _closing(name).search(page, end)
            end = closing.end() if closing else len(page)
        elif name and token["end"]:
            reader.end(name)
        elif name:
            reader.start(name, page[token.end():end - 1])
        at = look = end
    reader.data(page[at:])
    reader.flush()
    return reader.blocks


@lru_cache(maxsize=None)
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*+>", re.IGNORECASE)


# Vectors

def vectors(blocks: Sequence[Block]) -> np.ndarray:
    """A row of features for every block."""
    n = len(blocks)
    out = np.zeros((n, DIMS), np.float32)
    if not n:
        return out
    words = [b.text.lower().split() for b in blocks]
    n_words = np.array([len(w) for w in words])
    places = np.fromiter((_place(w, WORD_DIMS) for ws in words for w in ws), np.int64, n_words.sum())
    counts = np.bincount(np.repeat(np.arange(n), n_words) * WORD_DIMS + places, minlength=n * WORD_DIMS)
    out[:, :TAG_DIMS] = [b.tags for b in blocks]
    out[:, TAG_DIMS:TAG_DIMS + WORD_DIMS] = np.log1p(counts.reshape(n, WORD_DIMS)) * 0.3
    size = np.array([len(b.text) for b in blocks])
    stops = np.array([sum(map(b.text.count, ".,!?")) for b in blocks])
    at = np.arange(n) / n
    out[:, TAG_DIMS + WORD_DIMS:] = np.stack([
        np.log1p(n_words) / 4, np.log1p(size) / 6, np.minimum(1.0, np.array([b.linked for b in blocks]) / size),
        stops / (1 + n_words), at, 1.0 - at,
    ], axis=1)
    return np.minimum(out, 3)


# The network


class Labeller:
    """Bidirectional LSTM with a logistic output for every step."""

    def __init__(self, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for side in ("f", "b"):
            self.p[f"{side}x"] = (rng.normal(0, 1, (DIMS, 4 * hidden)) / np.sqrt(DIMS)).astype(np.float32)
            self.p[f"{side}h"] = (rng.normal(0, 1, (hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
            self.p[f"{side}c"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)]).astype(np.float32)
        self.p["o"] = (rng.normal(0, 1, 2 * hidden) / np.sqrt(2 * hidden)).astype(np.float32)
        self.p["oc"] = np.zeros(1, np.float32)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states (page, step, unit) of one direction; padded steps leave the state as it is."""
        pages, steps, _ = x.shape
        n = self.hidden
        gates_x = x @ self.p[f"{side}x"] + self.p[f"{side}c"]
        h, c = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        out, tape = np.zeros((pages, steps, n), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = gates_x[:, t] + h @ self.p[f"{side}h"]
            forget, write, show = (_sigmoid(z[:, k * n:(k + 1) * n]) for k in range(3))
            new = np.tanh(z[:, 3 * n:])
            m = mask[:, t, None]
            c_next = m * (forget * c + write * new) + (1 - m) * c
            squashed = np.tanh(c_next)
            h_next = m * (show * squashed) + (1 - m) * h
            if keep:
                tape.append((t, h, c, forget, write, show, new, squashed))
            h, c = h_next, c_next
            out[:, t] = h
        return out, tape

    def chances(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, tape_f = self._run("f", x, mask, keep)
        b, tape_b = self._run("b", x, mask, keep)
        both = np.concatenate([f, b], axis=2)
        return _sigmoid(both @ self.p["o"] + self.p["oc"]), both, tape_f, tape_b

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over the blocks."""
        p, both, tape_f, tape_b = self.chances(x, mask, keep=True)
        d = (p - y) * mask / mask.sum()
        out = {"o": np.einsum("pt,ptk->k", d, both), "oc": d.sum(keepdims=True).reshape(1)}
        d_both = d[..., None] * self.p["o"]
        n = self.hidden
        for side, tape, d_out in (("f", tape_f, d_both[..., :n]), ("b", tape_b, d_both[..., n:])):
            dz_all = np.zeros((*x.shape[:2], 4 * n), np.float32)
            d_h, d_c = np.zeros((len(x), n), np.float32), np.zeros((len(x), n), np.float32)
            d_wh = np.zeros_like(self.p[f"{side}h"])
            for t, h, c, forget, write, show, new, squashed in reversed(tape):
                m = mask[:, t, None]
                d_h = d_h + d_out[:, t]
                d_cell = d_c + d_h * show * (1 - squashed**2)
                dz = np.concatenate([
                    d_cell * c * forget * (1 - forget), d_cell * new * write * (1 - write),
                    d_h * squashed * show * (1 - show), d_cell * write * (1 - new**2),
                ], axis=1) * m
                dz_all[:, t] = dz
                d_wh += h.T @ dz
                d_h = m * (dz @ self.p[f"{side}h"].T) + (1 - m) * d_h
                d_c = m * d_cell * forget + (1 - m) * d_c
            out[f"{side}h"] = d_wh
            out[f"{side}x"] = np.einsum("ptd,ptk->dk", x, dz_all, optimize=True)
            out[f"{side}c"] = dz_all.sum((0, 1))
        return out

    def label(self, pages: Sequence[np.ndarray], at_once: int = 20_000) -> list[np.ndarray]:
        """Content or not for every block of every page; pages of like length share a pass."""
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        group: list[int] = []
        for k in [*order, None]:
            if group and (k is None or (len(group) + 1) * len(pages[k]) > at_once):
                x, mask = padded([pages[g] for g in group])
                p = self.chances(x, mask)[0]
                for row, g in enumerate(group):
                    out[g] = p[row, :len(pages[g])] >= 0.5
                group = []
            if k is not None and len(pages[k]):
                group.append(k)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, DIMS), np.float32), np.zeros((len(pages), steps), np.float32)
    for k, p in enumerate(pages):
        x[k, :len(p)], mask[k, :len(p)] = p, 1
    return x, mask


# Training

# Names that pages use for their parts.
CONTENT_TAGS = ("article", "main")
OTHER_TAGS = frozenset("nav header footer aside form menu dialog".split())
OTHER_MARKS = re.compile(
    r"^\.(?:.*[-_])?(?:ad|ads|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|header|masthead|footer|sidebar|side|related|"
    r"share|social|breadcrumbs?|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|login|search|comments?|"
    r"comment\w*|replies|discussion|disqus|widget|pagination|copyright|legal)(?:[-_].*)?$"
)
WRAPPERS = (
    ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".article-body"),
    ("section", ".entry-content"), ("div", ".main"), ("div", ".story"), ("div",),
)
BOXES = (
    ("nav",), ("div", ".menu"), ("ul", ".nav"), ("header",), ("div", ".header"), ("div", ".breadcrumb"), ("footer",),
    ("div", ".footer"), ("aside",), ("div", ".sidebar"), ("aside", ".related"), ("div", ".related-posts"), ("div", ".ad"),
    ("div", ".advert"), ("div", ".sponsored"), ("div", ".banner"), ("form",), ("form", ".newsletter"), ("div", ".subscribe"),
    ("div", ".cookie-notice"), ("div", ".cookie-banner"), ("div", ".notice"), ("div", ".alert"), ("div", ".share"), ("div", ".social"),
    ("section", ".comments"), ("div", ".comments"), ("div", ".comment"), ("ol", ".comment-list"), ("div", ".comments-area"),
    ("div", ".popup"), ("div", ".widget"), ("div", ".pagination"), ("div", ".copyright"), ("div", ".search"), ("div", ".login"),
)
INNER = (("p",), ("p",), ("h1",), ("h2",), ("h3",), ("ul", "li"), ("blockquote", "p"), ("div",), ("section", "p"), ("table", "tr", "td"), ("pre",))
BOX_INNER = (("ul", "li", "a"), ("li",), ("p",), ("a",), (), ("h3",), ("div", "p"), ("span",), ("article", "p"))


def _named(blocks: Sequence[Block], test: Callable[[str], bool]) -> np.ndarray:
    """Whether the path of each block has a mark that passes; shared parts of paths are tested once."""
    known: dict[Path | None, bool] = {None: False}
    for block in blocks:
        new, path = [], block.place
        while path not in known:
            new.append(path)
            path = path.above
        for path in reversed(new):
            known[path] = known[path.above] or test(path.mark)
    return np.array([known[b.place] for b in blocks], bool)


def _other_part(mark: str) -> bool:
    return mark in OTHER_TAGS or mark.startswith(".") and OTHER_MARKS.match(mark) is not None


def structural_labels(blocks: Sequence[Block]) -> np.ndarray:
    """Content by structure: inside the article, and in nothing that is named as another part."""
    return _named(blocks, CONTENT_TAGS.__contains__) & ~_named(blocks, _other_part)


def dense_labels(blocks: Sequence[Block], words: int = 8, linked: float = 0.3) -> np.ndarray:
    """Content by density, for pages without an article: headings and long texts with few links, in no other part."""
    dense = [
        (b.place is not None and b.place.mark in ("h1", "h2", "h3") or len(b.text.split()) >= words) and b.linked < linked * len(b.text)
        for b in blocks
    ]
    return np.array(dense, bool) & ~_named(blocks, _other_part)


def disguised(blocks: Sequence[Block], content: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page with another wrapper, other inner elements and boxes of boilerplate around and inside its content."""
    texts = [b.text for b in blocks]
    base = ("html", "body") + ((), ("div",), ("div", ".page"), ("div", ".container"))[rng.integers(4)]
    wrapper = base + WRAPPERS[rng.integers(len(WRAPPERS))]
    out: list[tuple[Block, bool]] = []

    def box(outer: tuple[str, ...]) -> None:
        kind, inner = BOXES[rng.integers(len(BOXES))], BOX_INNER[rng.integers(len(BOX_INNER))]
        for _ in range(rng.integers(1, 6)):
            words = texts[rng.integers(len(texts))].split()
            start = rng.integers(len(words))
            text = " ".join(words[start:start + int(rng.choice([1, 2, 4, 12, 40]))])
            out.append((Block.of(outer + kind + inner, text, len(text) if "a" in inner else 0), False))

    for _ in range(rng.integers(1, 4)):
        box(base)
    for k in np.flatnonzero(content):
        if rng.random() < 0.1:
            box(wrapper)
        own = blocks[k].path
        inner = own[-1:] if rng.random() < 0.5 else INNER[rng.integers(len(INNER))]
        out.append((Block.of(wrapper + tuple(inner), texts[k], blocks[k].linked), True))
    for _ in range(rng.integers(0, 4)):
        box(wrapper if rng.random() < 0.3 else base)
    return [b for b, _ in out], np.array([c for _, c in out], bool)


# A page to learn from where a table has none.
STARTER = """<html><body><nav><ul><li><a href="/">Home</a><li><a href="/news">News</a></ul></nav><article><h1>How rivers change</h1>
<p>A river wears away its outer bank and leaves sand on the inner one, so every bend grows with the years.</p>
<p>In wet seasons the water cuts through the neck of a bend, and a lake remains where the stream once ran.</p>
<p>People who settle near it build walls; the stream then deepens its bed, and the fields beside it dry out.</p>
<h2>What is measured</h2><p>Gauges note the level every hour. From the levels of many years the risk of a flood is worked out.</p>
</article><footer>All rights reserved</footer></body></html>"""


def examples(pages: Sequence[str], variants: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of the pages and their disguises.

    Pages are labelled by structure; if none has content by structure, by density; if none has
    any by that either, a fixed page is shown in as many disguises as the sample would have had.
    """
    read = [blocks_of(page) for page in pages]
    for labels in (structural_labels, dense_labels):
        data = []
        for blocks in read:
            content = labels(blocks)
            if content.any():
                shown = [(blocks, content)] + [disguised(blocks, content, rng) for _ in range(variants)]
                data += [(vectors(b), y.astype(np.float32)) for b, y in shown]
        if data:
            return data
    blocks = blocks_of(STARTER)
    shown = [disguised(blocks, structural_labels(blocks), rng) for _ in range(100 * variants)]
    return [(vectors(b), y.astype(np.float32)) for b, y in shown]


def batches_of(data: Sequence[tuple[np.ndarray, np.ndarray]], most: int = 32, steps: int = 20_000) -> list[list]:
    """Pages of like length together, ``most`` of them, fewer if their padded steps pass ``steps``."""
    out: list[list] = []
    for page in sorted(data, key=lambda d: len(d[0])):
        if not out or len(out[-1]) == most or (len(out[-1]) + 1) * len(page[0]) > steps:
            out.append([])
        out[-1].append(page)
    return out


def train(pages: Sequence[str], variants: int = 3, epochs: int = 8, seed: int = 7) -> Labeller:
    """Fit on the given pages (a bounded sample, read whole) and their disguises, by Adam on batches of like length."""
    rng, model = np.random.default_rng(seed), Labeller(seed=seed)
    batches = batches_of(examples(pages, variants, rng))
    first, second, step = {k: np.zeros_like(v) for k, v in model.p.items()}, {k: np.zeros_like(v) for k, v in model.p.items()}, 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            x, mask = padded([v for v, _ in batches[k]])
            y = np.zeros_like(mask)
            for row, (_, labels) in enumerate(batches[k]):
                y[row, :len(labels)] = labels
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.001
            for name, g in model.gradients(x, mask, y).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                even = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                model.p[name] = (model.p[name] - rate * even).astype(np.float32)
    return model


def sampled_pages(pages: DataFrame, html_col: str, most: int) -> list[str]:
    """At most ``most`` different pages, chosen by the hash of their html, for training.

    They are drawn from all pages of the table that have an article or main element; only
    if no page has one, from all pages.
    """
    rows = pages.select(F.col(html_col).alias("body")).where(F.col("body").isNotNull() & (F.length("body") <= 50_000))
    rows = rows.withColumn("hash", F.xxhash64("body"))
    marked = "(?i)<(" + "|".join(CONTENT_TAGS) + ")[\\s>]"
    for pool in (rows.where(F.col("body").rlike(marked)), rows):
        different = pool.agg(F.approx_count_distinct("hash")).first()[0]
        if different:
            break
    else:
        return []
    # A few more than wanted pass the threshold, whatever the size of the table; copies collapse before they travel.
    share = min(1.0, 1.3 * most / different)
    drawn = pool.where(F.pmod("hash", F.lit(1_000_003)) < share * 1_000_003)
    return [r.body for r in drawn.groupBy("hash").agg(F.first("body").alias("body")).orderBy("hash").limit(most).collect()]


def extract(
    pages: DataFrame,
    carry: Sequence[str] = ("page_id", "url"),
    html_col: str = "html",
    sample_pages: int = 300,
    model: Labeller | None = None,
) -> DataFrame:
    """The ``carry`` columns and ``text``: the content blocks in page order, joined by newlines.

    Without a ``model`` one is trained on at most ``sample_pages`` pages of the table (of
    at most 50,000 characters), labelled by their article or main element, or in a table without any by
    density; without a page to learn from it is trained on disguises of a fixed one. NULL and empty pages, and pages without content, give
    an empty text; repeated rows each give a row; an empty table gives none. Other
    columns are not read.
    """
    model = model or train(sampled_pages(pages, html_col, sample_pages))
    sent = pages.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model))
    picked = pages.select(F.struct(*carry).alias("kept"), F.col(html_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = sent.value[1]
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [blocks_of(page) for page in batch.column("body").to_pylist()]
                labels = labeller.label([vectors(b) for b in found])
                texts = ["\n".join(b.text for b, keep in zip(bs, ls, strict=True) if keep) for bs, ls in zip(found, labels, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], names=schema.names)

    return picked.mapInArrow(run, schema).select("kept.*", "text")
