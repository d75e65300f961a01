"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers do the rest.

One pass of the automaton over a text yields at-signs and their spelt-out forms, address schemes, digits, plus signs,
colons and identifier cues. Each anchor goes to a parser that expands it to both
sides, reading only the characters of the value, and validates it. Every character is
expanded over at most a few times, so the work is linear in the text.

Base spans equal, kind by kind, the leftmost non-overlapping matches of four patterns
(fixed by the contract, see ``email_spans`` and the others), with parts, digits and check sums
validated. Beyond them the method adds spans that those patterns cannot reach.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from ipaddress import AddressValueError, IPv6Address

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: In the order in which spans are listed. ``account`` is never a base span.
KINDS = ("email", "ip", "card", "phone", "account")
SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()),
])
FOUND = T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("redacted", T.StringType())])
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

Span = tuple[int, int]

# Anchors and cues. Cues are matched in lower, upper and title case.
AT_WORDS = ("[at]", "(at)", "{at}", "<at>")
SCHEMES = ("://",)
IBAN_CUES = ("iban",)
NUMBER_CUES = ("ssn", "social security", "passport", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "tax id", "driver license")
NAME_CUES = ("username", "user name", "user id", "login", "skype", "telegram", "twitter", "instagram")


@lru_cache(maxsize=1)
def anchors():
    """The automaton; a hit gives the anchor's class and length."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    digits = "0123456789"
    plain = {"at": ["@"], "digit": list(digits), "plus": [f"+{d}" for d in digits], "colon": [":"], "scheme": SCHEMES}
    for name, words in plain.items():
        for word in words:
            automaton.add_word(word, (name, len(word)))
    for name, words in {"at_word": AT_WORDS, "iban": IBAN_CUES, "number": NUMBER_CUES, "name": NAME_CUES}.items():
        for word in words:
            for form in (word, word.upper(), word.title(), word.capitalize()):
                automaton.add_word(form, (name, len(word)))
    automaton.make_automaton()
    return automaton


def anchors_of(text: str) -> dict[str, list[Span]]:
    """Where each class of anchors stands, in order."""
    found: dict[str, list[Span]] = {}
    for last, (name, length) in anchors().iter(text):
        found.setdefault(name, []).append((last - length + 1, last + 1))
    return found


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
PHONE_BODY = re.compile(r"[ ().0-9-]+")


def _digit(c: str) -> bool:
    return "0" <= c <= "9"


def email_spans(text: str, at_signs: Iterable[Span]) -> list[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``: local part to the left, domain to the right."""
    spans, free = [], 0
    for at, after in at_signs:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (domain := DOMAIN.match(text, after)):
            spans.append((begin, domain.end()))
            free = domain.end()
    return spans


def _first_digits(text: str, digits: Iterable[Span]) -> Iterator[int]:
    """Digits that do not follow a digit."""
    return (at for at, _ in digits if not at or not _digit(text[at - 1]))


def ip_spans(text: str, digits: Iterable[Span]) -> list[Span]:
    """Matches of four digit groups with dots between, parts at most 255. A longer chain is read four groups at a time."""
    spans, free = [], 0
    for at in _first_digits(text, digits):
        if at < free:
            continue
        chain = DOTTED.match(text, at)
        free = chain.end()
        groups = chain.group().split(".")
        begin = at
        for k in range(0, len(groups) - 3, 4):
            four = groups[k:k + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in four):
                spans.append((begin, end))
            begin = end + 1
    return spans


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def card_spans(text: str, digits: Iterable[Span]) -> list[Span]:
    """Chains of digits with at most one space or hyphen between: ``[0-9]([\\x20-]?[0-9])+``, 13 to 19 digits, Luhn sum right."""
    spans, free = [], 0
    for at, _ in digits:
        if at < free:
            continue
        chain = CHAIN.match(text, at)
        free = chain.end() if chain else at + 1
        if chain and 13 <= chain.end() - at <= 37:
            plain = chain.group().replace(" ", "").replace("-", "")
            if 13 <= len(plain) <= 19 and luhn(plain):
                spans.append((at, free))
    return spans


def phone_spans(text: str, pluses: Iterable[Span]) -> list[Span]:
    """Matches of ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 9 to 15 digits: the run after the first digit, cut behind its last digit."""
    spans = []
    for at, after in pluses:
        body = PHONE_BODY.match(text, after)
        if not body:
            continue
        end = after + len(body.group().rstrip(" ().-"))
        if end - after >= 2 and 9 <= 1 + sum(map(_digit, text[after:end])) <= 15:
            spans.append((at, end))
    return spans


# ------------------------------------------------------------------ beyond the base patterns
#: Letters and digits of any script and the marks of a local part; labels hold no underscore.
WIDE_LOCAL = re.compile(r"[^\W_](?:[\w.%+-]*[\w%+])?\Z")
LABEL = r"[^\W_](?:[^\W_]|-(?=[^\W_]|-))*"
WIDE_DOMAIN = re.compile(rf"{LABEL}(?:\.{LABEL})+")
SPELT_DOMAIN = re.compile(rf"({LABEL})((?:(?:\s?[\[({{<](?:dot|DOT|Dot)[\])}}>]\s?|\.){LABEL})+)")


def _local_before(text: str, end: int) -> int:
    begin = end
    while begin and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-"):
        begin -= 1
    while begin < end and not text[begin].isalnum():
        begin += 1
    return begin


def _top_level(domain: str) -> bool:
    last = re.split(r"[.\])}>]\s?", domain)[-1]
    return len(last) >= 2 and last.isalpha()


def wide_emails(text: str, found: dict[str, list[Span]]) -> list[Span]:
    """Addresses with letters beyond ASCII, and addresses whose at-sign (and dots) are spelt out in brackets."""
    spans = []
    for at, after in found.get("at", ()):
        begin, domain = _local_before(text, at), WIDE_DOMAIN.match(text, after)
        if domain and begin < at and text[at - 1] != "." and not text[begin:domain.end()].isascii() and _top_level(domain.group()):
            spans.append((begin, domain.end()))
    for at, after in found.get("at_word", ()):
        left = at - 1 if at and text[at - 1] == " " else at
        right = after + 1 if text[after:after + 1] == " " else after
        begin, domain = _local_before(text, left), SPELT_DOMAIN.match(text, right)
        if domain and begin < left and text[left - 1] != "." and _top_level(domain.group()):
            spans.append((begin, domain.end()))
    return spans


HEXES = frozenset("0123456789abcdefABCDEF:")


def ipv6_spans(text: str, colons: Iterable[Span]) -> list[Span]:
    """IPv6 addresses: runs of hex digits and colons, perhaps with an IPv4 tail, of at least three groups."""
    spans, free = [], 0
    for at, _ in colons:
        if at < free:
            continue
        begin, end = at, at + 1
        while begin > free and text[begin - 1] in HEXES:
            begin -= 1
        while end < len(text) and text[end] in HEXES:
            end += 1
        free = end
        if text.count(":", begin, end) < 2 or (begin and text[begin - 1].isalnum()):
            continue
        tail = DOTTED.match(text, text.rfind(":", begin, end) + 1)
        if tail and tail.group().count(".") == 3:
            end = free = tail.end()
        elif text[end - 1] == ":" and text[end - 2] != ":":
            end -= 1
        if end - begin > 45 or text[end:end + 1].isalnum() or sum(map(bool, text[begin:end].split(":"))) < 3:
            continue
        try:
            IPv6Address(text[begin:end])
        except AddressValueError:
            continue
        spans.append((begin, end))
    return spans


USERINFO = re.compile(r"([A-Za-z0-9._%+~-]+(?::[^\s/?#@\"'<>]*)?)@((?:[A-Za-z0-9-]+\.)*[A-Za-z0-9-]+)(?=[:/?#\s\"'<>)]|\Z)")
SEPARATOR = re.compile(r"\s{0,2}(?:(?:number|no|nr|num|numéro|número|nummer|is)\b\.?)?\s{0,2}[:#=.]?\s{0,2}(?:is\s)?", re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
NUMBER = re.compile(r"(?=[A-Z]{0,3}[ -]?[0-9])[A-Z]{0,3}[ -]?[0-9](?:[ -]?[0-9]){5,19}(?![A-Za-z0-9])")
NAME = re.compile(r"\s?[:=]\s?(@?[A-Za-z][A-Za-z0-9._-]*[A-Za-z0-9])(?![A-Za-z0-9@])")


def iban_check(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _word_start(text: str, at: int) -> bool:
    return not at or not (text[at - 1].isalnum() or text[at - 1] == "_")


def account_spans(text: str, found: dict[str, list[Span]]) -> list[Span]:
    """Accounts behind a cue: user parts of addresses with a scheme, IBANs with a right check sum, numbers of
    at least six digits, and user names behind a colon or equals sign. Passwords and keys are no personal data."""
    spans = []
    for _, after in found.get("scheme", ()):
        if user := USERINFO.match(text, after):
            spans.append((user.start(1), user.end(1)))
    for at, after in found.get("iban", ()):
        if not _word_start(text, at):
            continue
        begin = SEPARATOR.match(text, after).end()
        if value := IBAN.match(text, begin):
            # Following words may look like part of it: the longest valid prefix in whole groups counts.
            groups = value.group().split(" ")
            for k in range(len(groups), 0, -1):
                plain = "".join(groups[:k])
                if 15 <= len(plain) <= 34 and iban_check(plain):
                    spans.append((begin, begin + len(" ".join(groups[:k]))))
                    break
    for at, after in found.get("number", ()):
        if _word_start(text, at) and (value := NUMBER.match(text, SEPARATOR.match(text, after).end())):
            spans.append(value.span())
    for at, after in found.get("name", ()):
        if _word_start(text, at) and (value := NAME.match(text, after)):
            spans.append(value.span(1))
    return spans


def spans_of(text: str, added: bool = True) -> list[tuple[str, int, int, bool]]:
    """All spans as (kind, begin, end, base) by kind in the order of ``KINDS``, then begin.

    An added span that lies inside another span of its kind, or repeats one, is left out.
    """
    found = anchors_of(text)
    digits = found.get("digit", ())
    base = {
        "email": email_spans(text, found.get("at", ())), "ip": ip_spans(text, digits),
        "card": card_spans(text, digits), "phone": phone_spans(text, found.get("plus", ())), "account": [],
    }
    more: dict[str, list[Span]] = {}
    if added:
        more = {"email": wide_emails(text, found), "ip": ipv6_spans(text, found.get("colon", ())), "account": account_spans(text, found)}
    out = []
    for kind in KINDS:
        marked = [(b, -e, 0) for b, e in base[kind]] + [(b, -e, 1) for b, e in set(more.get(kind, ()))]
        reach = -1
        for begin, minus_end, extra in sorted(marked, key=lambda s: (s[0], s[1], s[2])):
            if not extra or -minus_end > reach:
                out.append((kind, begin, -minus_end, not extra))
            reach = max(reach, -minus_end)
    return out


def redact(text: str, spans: Sequence[tuple[str, int, int, bool]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans by the first of them."""
    parts, at, reach = [], 0, 0
    for kind, begin, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= reach:
            parts += [text[at:begin], f"<{kind.upper()}>"]
        at = reach = max(reach, end)
    return "".join([*parts, text[at:]])


def personal_data(
    documents: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text", added: bool = True, redacted: bool = False,
) -> DataFrame:
    """The ``carry`` columns of every document with a struct ``found``: spans and, if asked for, the redacted text.

    Offsets are code points of the original text, ends exclusive; ``base`` tells the spans of the four
    fixed patterns from added ones. NULL and empty texts have no spans (a redacted text is empty then). Rows
    stand alone: repeated rows each give a row, nothing is shuffled or cut, a text of any
    length is read once. Other columns are not read.
    """
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("found", FOUND)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column("body").to_pylist()]
                spans = [spans_of(t, added) for t in texts]
                clean = [redact(t, s) for t, s in zip(texts, spans, strict=True)] if redacted else [None] * len(texts)
                found = pa.StructArray.from_arrays([
                    pa.array([[dict(zip(SPAN.names, s, strict=True)) for s in ss] for ss in spans], _SPANS),
                    pa.array(clean, pa.string()),
                ], names=FOUND.names)
                yield pa.RecordBatch.from_arrays([part.column("kept"), found], names=["kept", "found"])

    return picked.mapInArrow(scan, schema).select("kept.*", "found")


def listed(spans: Column) -> Column:
    """kind:begin:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")
