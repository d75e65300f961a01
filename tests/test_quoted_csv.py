"""Quoted line breaks read in parallel, against the file-by-file reader and the csv module."""

import csv
import gzip
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.sources import csv_files, quoted_csv
from tidemark.sources.schemas import RAW_TABLES

SPEC = RAW_TABLES["order_reviews"]
NAMES = list(SPEC.column_names)


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def reviews(seed, n):
    rnd = random.Random(seed)
    for i in range(n):
        text = "".join(rnd.choice('"",\n\n aé') for _ in range(rnd.choice([0, 3, 60, 400])))
        yield [f"r{i}", f"o{i}", rnd.randint(1, 5), rnd.choice(["", "a,b", 'said "x"', "\n"]), text, "2018-01-01 00:00:00", ""]


def write(path, rows, header=NAMES, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows([header, *rows])


def serial(spark, folder):
    """The reader that takes one task a file."""
    reader = spark.read.options(**{**csv_files.CSV_OPTIONS, "mode": "FAILFAST", "multiLine": "true"})
    return reader.schema(SPEC.schema).csv(str(folder))


def test_same_rows_as_the_serial_reader_in_many_ranges(spark, tmp_path, small_ranges):
    for k in range(3):
        write(tmp_path / f"order_reviews_{k}.csv", reviews(k, 250))
    assert quoted_csv.physical_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    parallel, plain = csv_files.csv_scan(spark, str(tmp_path), "order_reviews"), serial(spark, tmp_path)
    assert parallel.schema == plain.schema and parallel.count() == 750
    assert parallel.exceptAll(plain).count() == 0 and plain.exceptAll(parallel).count() == 0


def test_a_record_longer_than_several_ranges(spark, tmp_path, small_ranges):
    rows = [["r1", "o1", 5, "", "x,\n" * 8000, "", ""], ["r2", "o2", 4, "", "short", "", ""]]
    write(tmp_path / "a.csv", rows)
    found = {r.review_id: r.review_comment_message for r in csv_files.csv_scan(spark, str(tmp_path), "order_reviews").collect()}
    assert found == {"r1": "x,\n" * 8000, "r2": "short"}


def test_windows_line_ends_gzip_empty_lines_and_byte_order_mark(spark, tmp_path, small_ranges):
    write(tmp_path / "a.csv", reviews(5, 60), end="\r\n")
    body = (tmp_path / "a.csv").read_bytes().split(b"\r\n", 1)[1]
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + ",".join(f'"{n}"' for n in NAMES).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt", encoding="utf-8", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([NAMES, *reviews(6, 40)])
    write(tmp_path / "empty.csv", [])
    found = csv_files.csv_scan(spark, str(tmp_path), "order_reviews")
    expected = {(r[0], r[4] or None) for seed, n in ((5, 60), (6, 40)) for r in reviews(seed, n)}
    assert {(r.review_id, r.review_comment_message) for r in found.collect()} == expected and found.count() == 100


def test_quotes_inside_plain_values_open_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(NAMES) + '\nr1,o1,5,a 5" pipe,half "quoted" text,,\nr2,o2,4,"b""",,,\n', encoding="utf-8")
    found = csv_files.csv_scan(spark, str(tmp_path), "order_reviews")
    assert found.exceptAll(serial(spark, tmp_path)).count() == 0
    assert {r.review_comment_title for r in found.collect()} == {'a 5" pipe', 'b"'}


def test_unclosed_quotes_and_moved_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(NAMES) + '\nr1,o1,5,"never closed,,,\nr2,o2,4,,,,\n')
    with pytest.raises(Exception, match="never closed"):
        csv_files.csv_scan(spark, str(tmp_path), "order_reviews").count()
    write(tmp_path / "a.csv", reviews(1, 3), header=NAMES[::-1])
    with pytest.raises(Exception, match="does not name the columns"):
        csv_files.csv_scan(spark, str(tmp_path), "order_reviews").count()


def test_bad_rows_are_told_with_their_whole_text(spark, tmp_path, small_ranges):
    rows = list(reviews(2, 120))
    rows[70] = ["r70", "o70", "bad", "", "two\nlines", "", ""]
    rows[90] = ["r90", "o90"]
    write(tmp_path / "order_reviews.csv", rows)
    bad = csv_files.dry_run(spark, str(tmp_path), "order_reviews").select(csv_files.CORRUPT).collect()
    assert sorted(r[0] for r in bad) == ['r70,o70,bad,,"two\nlines",,', "r90,o90"]
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.csv_scan(spark, str(tmp_path), "order_reviews").collect()


def test_text_profile_reads_the_same_values(spark, tmp_path, small_ranges):
    write(tmp_path / "a.csv", reviews(3, 90))
    found = csv_files.string_profile_scan(spark, str(tmp_path))
    plain = spark.read.options(**{**csv_files.CSV_OPTIONS, "multiLine": "true"}).csv(str(tmp_path))
    assert found.columns == NAMES and found.exceptAll(plain).count() == 0 and found.count() == plain.count()


def python_states(line):
    """Is a value still open behind the line, begun outside and inside quotes? Character by character."""
    ends = []
    for state in ("start", "quoted"):
        k = 0
        while k < len(line):
            c = line[k]
            if state == "quoted":
                if c == '"' and line[k + 1:k + 2] == '"':
                    k += 1
                elif c == '"':
                    state = "plain"
            elif c == ",":
                state = "start"
            elif c == '"' and state == "start":
                state = "quoted"
            else:
                state = "plain"
            k += 1
        ends.append(state == "quoted")
    return ends


def test_line_states_equal_a_character_machine(spark):
    rnd = random.Random(4)
    lines = ["".join(rnd.choice('"",a') for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    for r in quoted_csv.with_transitions(frame, ",").collect():
        assert [r.after_out, r.after_in] == python_states(r.line), r.line


def test_very_long_lines_need_no_deep_stack(spark):
    line = '"a""b",' * 200_000 + '"open ""' + '""' * 200_000
    row = quoted_csv.with_transitions(spark.createDataFrame([(line,)], "line string"), ",").first()
    assert [row.after_out, row.after_in] == python_states(line)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text('a",\n', max_size=6), min_size=2, max_size=2).filter(any), min_size=1, max_size=12))
def test_records_equal_the_csv_module(spark, tmp_path_factory, rows):
    folder = tmp_path_factory.mktemp("csv")
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([["x", "y"], *rows])
    (folder / "t.csv").write_text(out.getvalue(), encoding="utf-8")
    found = quoted_csv.records(spark, str(folder)).orderBy("record_no").collect()
    assert [next(csv.reader(io.StringIO(r.record))) for r in found] == [["x", "y"], *rows]
    assert [r.record_no for r in found] == list(range(len(rows) + 1))


def test_a_large_file_is_read_in_parallel(spark, tmp_path):
    """64 MB with line breaks in texts: more than one partition, the serial reader's rows."""
    block = io.StringIO()
    said = "came late, \"but\" works as described in the offer"
    csv.writer(block, lineterminator="\n").writerows(
        [f"r{i}", f"o{i}", 1 + i % 5, "", "\n".join([said] * (i % 4)), "2018-01-01 00:00:00", ""] for i in range(4000))
    text, copies = block.getvalue(), 64_000_000 // len(block.getvalue().encode()) + 1
    with open(tmp_path / "order_reviews.csv", "w", encoding="utf-8", newline="") as f:
        f.write(",".join(NAMES) + "\n")
        for _ in range(copies):
            f.write(text)
    assert os.path.getsize(tmp_path / "order_reviews.csv") > 64_000_000
    lines = quoted_csv.physical_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 1
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64(*NAMES).cast("decimal(38,0)"))]
    parallel, plain = csv_files.csv_scan(spark, str(tmp_path), "order_reviews"), serial(spark, tmp_path)
    assert parallel.agg(*digest).first() == plain.agg(*digest).first()
    largest = lines.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert largest[0] < 0.5 * largest[1]
