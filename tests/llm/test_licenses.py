import re

import pytest

from tidemark.llm import licenses
from tidemark.llm.oracles import LICENSES
from tidemark.llm.queries import op2_license_scan

SMALL = "/root/testdata/sf0.001"
FILL = "und dann kam ein ganz anderer satz der nichts von alledem sagte " * 3


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(documents, templates, contained=0.8):
    out = {}
    for doc_id, text in documents:
        for name, body in templates:
            parts = shingles(body)
            shared = len(parts & shingles(text))
            if parts and shared >= contained * len(parts):
                out[doc_id, name] = shared
    return out


def test_every_notice_is_found_anywhere(spark):
    notices = list(licenses.NOTICES.items())
    documents = [(k, f"{FILL[:k * 7]} {text.upper()}\n{FILL}") for k, (_, text) in enumerate(notices)]
    documents += [(100, FILL), (101, " ".join(t for _, t in notices)), (102, notices[0][1].rsplit(" ", 1)[0])]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = licenses.scan(frame, licenses.notices(frame))
    got = {(r.doc_id, r.template): r.shared for r in found.collect()}
    assert got == brute(documents, notices)
    assert {(k, name) for k, (name, _) in enumerate(notices)} <= got.keys() and not any(d in (100, 102) for d, _ in got)


def test_edited_long_notices(spark):
    notices = [(n, t) for n, t in licenses.NOTICES.items() if len(t) > 200]
    documents = []
    for k, (_, text) in enumerate(notices):
        words = text.split()
        words[len(words) // 2] = "changed"
        documents.append((k, FILL + " ".join(words) + FILL))
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    got = {(r.doc_id, r.template): r.shared for r in licenses.scan(frame, licenses.notices(frame)).collect()}
    assert got == brute(documents, list(licenses.NOTICES.items())) and len(got) >= len(notices) - 1


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scan(frame, licenses.notices(frame))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan


def test_windows_are_cut_without_lambdas(spark):
    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scan(frame, licenses.notices(frame))._jdf.queryExecution().executedPlan().toString()
    rows = re.findall(r"Generate .*", plan)
    assert rows and not any("lambda" in row for row in rows)
    assert not re.search(r"xxhash64\(slice", plan)
    # Hashed once: not again below, in a filter of the same expression.
    document = plan[plan.index("Join"):plan.index("BroadcastExchange")]
    assert document.count("xxhash64") == 1


def test_bands_equal_plain_windows(spark):
    rows = [(n, " ".join(f"w{i * i % 31}" for i in range(n + 4))) for n in (0, 1, 3, 4, 5, 8, 9, 16, 17, 33, 70)] + [(100, None)]
    frame = spark.createDataFrame(rows, "key long, body string")
    got = sorted((r.key, r.level, r.band, r.value, tuple(r.around)) for r in licenses.document_bands(frame).select("key", "level", "band", "value", "around").collect())
    of_slices = "transform(sequence(1, size(w) - 4), i -> xxhash64(slice(w, i, 5)))"
    hashes = frame.where("key between 1 and 70").selectExpr("key", "split(body, ' ') as w").selectExpr("key", f"{of_slices} as h").collect()
    want = []
    for key, h in hashes:
        g = [x ^ licenses.PERMUTATION for x in h]
        want += [(key, 0, 0, x, (x,)) for x in h]
        for level, (size, stride) in list(enumerate(licenses.LEVELS))[1:]:
            for i in range(0, len(h), stride):
                first, second, around = h[i:i + size], g[i:i + size], tuple(h[max(0, i - size):max(0, i - size) + 3 * size])
                want += [(key, level, b, v, around) for b, v in enumerate((min(first), max(first), min(second), max(second)))]
    assert got == sorted(want)


@pytest.mark.parametrize("broadcast", [True, False])
def test_long_templates_by_either_join(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(licenses, "BROADCAST_BYTES", 0)
    templates = [(f"t{n}", " ".join(f"p{n}x{i}" for i in range(n))) for n in (5, 14, 15, 40, 50, 51, 200)]
    documents = [(n, f"{FILL[:n * 5]} {text} {FILL}") for n, (_, text) in enumerate(templates)]
    documents += [(50 + n, " ".join(text.split()[:-2])) for n, (_, text) in enumerate(templates)] + [(99, FILL)]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = licenses.scan(frame, spark.createDataFrame(templates, "template string, text string")).collect()
    assert {(r.doc_id, r.template): r.shared for r in found} == brute(documents, templates)


@pytest.mark.parametrize("broadcast", [True, False])
def test_query_equals_oracle(spark, broadcast, monkeypatch):
    import duckdb

    if not broadcast:
        monkeypatch.setattr(licenses, "BROADCAST_BYTES", 0)
    con = duckdb.connect()
    con.execute(f"create view documents as from '{SMALL}/documents.parquet'")
    want = sorted(con.execute(LICENSES).fetchall())
    assert sorted(tuple(r) for r in op2_license_scan(spark, SMALL).collect()) == want


def test_odd_rows(odd_documents, no_documents):
    templates = odd_documents.sparkSession.createDataFrame(
        [("t", "straße und öl zwei zeilen"), ("short", "a b"), ("null", None), ("t", "straße und öl zwei zeilen")], "template string, text string",
    )
    found = licenses.scan(odd_documents, templates).collect()
    assert [(r.doc_id, r.template, r.containment) for r in found] == [(8, "t", 1.0)]
    rows = licenses.licensed(odd_documents, licenses.scan(odd_documents, templates)).collect()
    assert len(rows) == 10 and sum(bool(r.templates) for r in rows) == 2
    assert licenses.scan(no_documents, templates).count() == 0
    assert licenses.scan(odd_documents, templates.where("template is null")).count() == 0
