import hashlib
import random
import re
import time

import pytest

from tidemark.llm import personal_data
from tidemark.llm.personal_data import KINDS, redact, spans_of
from tidemark.llm.queries import op13_personal_data, table

SMALL = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def brute(text):
    """The four patterns run over the whole text by the regex engine."""
    digits = {m: re.sub("[^0-9]", "", m.group()) for p in (CARD, PHONE) for m in p.finditer(text)}
    return (
        [("email", *m.span()) for m in EMAIL.finditer(text)]
        + [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
        + [("card", *m.span()) for m, d in digits.items() if m.re is CARD and 13 <= len(d) <= 19 and luhn(d)]
        + [("phone", *m.span()) for m, d in digits.items() if m.re is PHONE and 9 <= len(d) <= 15]
    )


@pytest.mark.parametrize("letters", ["a.b-1@", "0123456789 -.", "+1 ()23-.4", "@@a..b-é_%+ü", "1234.+ @a", ":a1f0:.", "٣1.2.3"])
def test_base_equals_the_patterns(letters):
    rnd = random.Random(letters)
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50)))
        number = "".join(rnd.choice("0123456789") for _ in range(rnd.randint(12, 19)))
        number += next(c for c in "0123456789" if luhn(number + c))
        text += " é" + rnd.choice(["", "-", " "]).join(re.findall(".{1,4}", number)) + rnd.choice(["", "x", " y", " 1"])
        assert [s[:3] for s in spans_of(text) if s[3]] == brute(text), text


def test_query_digest(spark):
    expected = {}
    for doc_id, text in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        spans = brute(text or "")
        line = ",".join(f"{k}:{b}:{e}" for k, b, e in spans)
        expected[doc_id] = (*[sum(s[0] == k for s in spans) for k in KINDS[:4]], hashlib.sha256(line.encode()).hexdigest(), set(line.split(",")) - {""})
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, set(r.spans.split(",")) - {""}) for r in op13_personal_data(spark, SMALL).collect()}
    assert {d: r[:5] for d, r in got.items()} == {d: r[:5] for d, r in expected.items()}
    assert all(got[d][5] >= expected[d][5] for d in expected)
    assert sum(r[0] for r in expected.values()) > 0
    # The tables hold no personal data beyond the patterns, so nothing may be added.
    assert all(got[d][5] == expected[d][5] for d in expected)


ADDED = [
    ("mail jürgen.groß@müller.de now", "email", "jürgen.groß@müller.de"), ("joe [at] example [dot] com ok", "email", "joe [at] example [dot] com"),
    ("x.y(AT)host.org", "email", "x.y(AT)host.org"), ("see 2001:db8::ff00:42:8329!", "ip", "2001:db8::ff00:42:8329"),
    ("at fe80::1:2.", "ip", "fe80::1:2"), ("IBAN: DE89 3704 0044 0532 0130 00 EUR", "account", "DE89 3704 0044 0532 0130 00"),
    ("iban GB82WEST12345698765432.", "account", "GB82WEST12345698765432"), ("ftp://anna@server/", "account", "anna"),
    ("SSN 123-45-6789", "account", "123-45-6789"), ("passport no. C 01234567", "account", "C 01234567"),
    ("Username: johnny_b, ok", "account", "johnny_b"), ("account number is 12345678", "account", "12345678"),
]
CLEAN = [
    "at 10:20:30 or 10:20", "std::vector and a::b::c", "the account 12 was", "@handle and a @ b", "f(at) g", "IBAN: DE00 3704 0044 0532 0130 00",
    "http://example.org/a@b", "version 1.2.3", "1.2.3.256", "4713332104704539", "+1 23", "cafe: dead:beef", 'password = "hunter2" token=99887766',
]


@pytest.mark.parametrize(("text", "kind", "value"), ADDED)
def test_added_spans(text, kind, value):
    begin = text.index(value)
    assert spans_of(text) == [(kind, begin, begin + len(value), False)]
    assert spans_of(text, added=False) == []


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay_clean(text):
    assert spans_of(text) == []


def test_base_spans_stay_beside_wider_ones():
    text = "an jürgen@mail.de"
    assert [(text[b:e], base) for _, b, e, base in spans_of(text)] == [("jürgen@mail.de", False), ("rgen@mail.de", True)]
    assert redact(text, spans_of(text)) == "an <EMAIL>"
    mixed = "::ffff:a0:192.0.2.128"
    assert [(mixed[b:e], base) for _, b, e, base in spans_of(mixed)] == [(mixed, False), ("192.0.2.128", True)]
    both = "see https://bob:pw@host.example/x and 10.0.0.1, +1 (499) 555-6503"
    assert redact(both, spans_of(both)) == "see https://<ACCOUNT>/x and <IP>, <PHONE>"


@pytest.mark.parametrize("piece", ["@", "a@", "1 ", "1.1.", ":", "a:", "a.b@", "+1", "x[at]", "://a", "iban ", "é.a", "account 1 2 3", "[dot]a", "-", "[at]a-"])
def test_long_texts_take_linear_time(piece):
    start = time.time()
    spans_of(piece * 100_000 + "@b")
    assert time.time() - start < 5


def test_odd_rows(odd_documents, no_documents, spark):
    rows = personal_data.personal_data(odd_documents, redacted=True, carry=("doc_id", "text")).collect()
    assert len(rows) == 10 and all(r.found.redacted == (r.text or "") and r.found.spans == [] for r in rows)
    assert personal_data.personal_data(no_documents).count() == 0
    twice = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c")], "doc_id long, text string")
    assert [[tuple(s) for s in r.found.spans] for r in personal_data.personal_data(twice).collect()] == [[("email", 0, 5, True)]] * 3
