"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line with words) hashes to a wide vector; a document's fingerprint is
the sum of its paragraphs' vectors, lane by lane modulo 2^16. The sum does not depend
on the order of paragraphs, and inserting or deleting one adds or subtracts its vector.

A paragraph's vector is the sum of +1/-1 vectors drawn by a keyed hash from the whole
paragraph and from its runs of ``RUN`` words. Equal documents have equal sums. The
angle between two sums tells how much of their runs they share: random vectors are
almost at right angles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANES = 128
RUN = 8
_CHUNK = 65_536


def paragraphs(text: bytes) -> list[bytes]:
    return [p for p in text.split(b"\n") if p.strip()]


def units(text: bytes) -> list[bytes]:
    """Hash inputs of all paragraphs: each as a whole, and its runs of words."""
    found = []
    for p in paragraphs(text):
        found.append(b"\0" + p)
        words = p.split()
        found += [b" ".join(words[i:i + RUN]) for i in range(0, len(words), RUN)]
    return found


def vector(text: bytes | None) -> np.ndarray:
    """Sum of the vectors of all paragraphs, modulo 2^16."""
    total = np.zeros(LANES, np.int64)
    found = units(text or b"")
    for at in range(0, len(found), _CHUNK):
        part = found[at:at + _CHUNK]
        drawn = b"".join([blake2b(u, digest_size=LANES // 8).digest() for u in part])
        ones = np.unpackbits(np.frombuffer(drawn, np.uint8).reshape(len(part), -1), axis=1).sum(0, dtype=np.int64)
        total += 2 * ones - len(part)
    return total.astype(np.uint16)


def inserted(fingerprint: np.ndarray, paragraph: bytes) -> np.ndarray:
    return fingerprint + vector(paragraph)


def deleted(fingerprint: np.ndarray, paragraph: bytes) -> np.ndarray:
    return fingerprint - vector(paragraph)


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2").astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two sums, from 0 to 1; 1 exactly when they are equal."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a.view(np.int16).astype(np.float64), b.view(np.int16).astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    return min(max(float(x @ y / size), 0.0), 1 - 1e-9) if size else 0.0


def fingerprints(documents: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``carry`` columns and ``fingerprint`` (hex). NULL counts as empty, which is the zero vector."""
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [as_text(vector(t)) for t in batch.column("body").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(made, pa.string())], names=schema.names)

    return picked.mapInArrow(run, schema).select("kept.*", "fingerprint")


# Comparison with an edited text and with the next document


def edited(text: str, donor: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the donor."""
    n = len(text) // 3
    return text[:len(text) - n] + donor[:n] if n else text


def _slices(documents: DataFrame, id_col: str, n: int) -> list[int]:
    """Ids that part the id range into slices of about equal numbers, descending."""
    points = [k / n for k in range(1, n)]
    if not points:
        return []
    found = documents.agg(F.percentile_approx(id_col, F.array(*map(F.lit, points)), 10_000)).first()[0]
    return sorted(set(found or []), reverse=True)


def with_next(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document compared with its text edited by the next one, and with the next one.

    Next means descending id, the first after the last; NULL ids come last, rows of
    equal id by text. Returns the id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. NULL text counts as empty; a single
    document is its own next; an empty table gives no rows.

    Rows are dealt by ranges of ids. The head of every slice is sent as a guest to the
    slice before it, so that the last row there meets its successor; no slice is read
    whole, each streams through its task in order.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("body"))
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = _slices(rows.where("id is not null"), "id", n)
    # Slice number: how many borders lie above the id; NULL ids are in the last slice.
    above = F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b > F.col("id"))) if borders else F.lit(0)
    dealt = rows.withColumn("slice", F.when(F.col("id").isNull(), len(borders)).otherwise(above))
    # One row for each slice that has rows: its largest id, and the slice that comes before it.
    heads = [tuple(r) for r in dealt.groupBy("slice").agg(F.max("id").alias("head")).collect()]
    order = sorted(where for where, _ in heads)
    before = {where: order[k - 1] for k, where in enumerate(order)}
    heads_schema = T.StructType([
        T.StructField("slice", T.IntegerType()), T.StructField("head", rows.schema["id"].dataType),
        T.StructField("before", T.IntegerType()),
    ])
    small = documents.sparkSession.createDataFrame([(s, h, before[s]) for s, h in heads], heads_schema)
    marked = dealt.join(F.broadcast(small), "slice")
    own = F.struct("slice", F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("slice"), F.lit(True).alias("guest"))
    places = F.when(F.col("id").eqNullSafe(F.col("head")), F.array(own, guest)).otherwise(F.array(own))
    sent = marked.select("id", "body", F.explode(places).alias("to")).select("id", "body", "to.*")
    placed = sent.repartitionById(n, F.col("slice")).sortWithinPartitions("slice", "guest", F.col("id").desc_nulls_last(), "body")
    id_type = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])
    return placed.mapInArrow(_compare(schema.names), schema)


def _compare(names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # (slice, id, text, vector) still without its successor
        for batch in batches:
            out = []
            ids = batch.column("id").to_pylist()
            for key, text, where, guest in zip(
                ids, *(batch.column(c).to_pylist() for c in ("body", "slice", "guest")), strict=True,
            ):
                if guest and (last is None or last[0] != where):
                    continue  # a further row with the head's id
                made = vector(text.encode())
                if last is not None and last[0] == where:
                    out.append(_row(last, text, made))
                last = None if guest else (where, key, text, made)
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            kinds = [batch.schema.field("id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _row(own: tuple, donor: str, donor_vector: np.ndarray) -> tuple:
    _, key, text, made = own
    changed = edited(text, donor).encode()
    changed_vector = vector(changed)
    return (
        key, len(text), sha256(changed).hexdigest(), as_text(made), as_text(changed_vector),
        likeness(made, changed_vector), likeness(made, donor_vector),
    )
