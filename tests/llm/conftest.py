"""Rows that every operator must stand: NULLs, empty, very long and repeated texts, and extra columns with clashing names."""

import pytest

LONG = " ".join(f"wort{i % 977} {i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_documents(spark):
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "de", "a"), (4, LONG, "en", "b"), (5, LONG, "en", "b"),
        (6, "one two", "en", "a"), (7, "!!! ... 123", "fr", "c"), (8, "Straße und Öl\nzwei Zeilen hier", "de", "a"),
        (8, "Straße und Öl\nzwei Zeilen hier", "de", "a"), (9, "a b c d e f g h i j k l m", None, "b"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    # Names that the operators use themselves.
    for name in ("fp", "found", "kept", "body", "piece", "shard", "slot", "score", "lang_pred", "bin", "node", "id", "row"):
        frame = frame.selectExpr("*", f"doc_id as `{name}`")
    return frame


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("doc_id < 0")
