"""CSV edge cases, audits, sinks."""

import gzip

import pytest

from tidemark.sources import csv_files, tables
from tidemark.sources.scratch import shared_folder

HEADER = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
GOOD = 'r1,o1,5,,"said ""ok"",\nthanks",2018-01-01 00:00:00,2018-01-02 10:30:00\nr2,o2,4,"","São Paulo",2018-01-01 00:00:00,\n'


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "order_reviews.csv").write_text(HEADER + GOOD, encoding="utf-8")
    (tmp_path / "other.csv").write_text("x\n1\n")
    return tmp_path


def test_quotes_line_breaks_empty_fields_and_accents(spark, folder):
    rows = {r["review_id"]: r for r in csv_files.file_pattern_scan(spark, str(folder), "order_reviews").collect()}
    assert rows["r1"]["review_comment_message"] == 'said "ok",\nthanks' and rows["r1"]["review_comment_title"] is None
    assert rows["r2"]["review_comment_title"] is None and rows["r2"]["review_comment_message"] == "São Paulo"
    assert rows["r2"]["review_answer_timestamp"] is None and rows["r1"]["review_score"] == 5


def test_compressed_files_match_the_same_pattern(spark, folder):
    with gzip.open(folder / "order_reviews.csv.gz", "wt", encoding="utf-8") as f:
        f.write(HEADER + "r9,o9,1,,,,\n")
    assert csv_files.file_pattern_scan(spark, str(folder), "order_reviews").count() == 3


@pytest.mark.parametrize("line", ["r3,o3,bad,,,,\n", "r3,o3\n"])
def test_bad_rows_stop_a_load_and_show_in_dry_run_and_audit(spark, folder, line):
    (folder / "order_reviews.csv").write_text(HEADER + GOOD + line, encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        csv_files.file_pattern_scan(spark, str(folder), "order_reviews").collect()
    pattern = csv_files.file_pattern("order_reviews")
    assert csv_files.dry_run(spark, str(folder), "order_reviews", pattern).count() == 1
    audit = csv_files.load_audit(spark, str(folder), "order_reviews", pattern).first()
    assert (audit["status"], audit["rows_parsed"], audit["rows_loaded"]) == ("LOAD_FAILED", 3, 2)
    assert audit["first_error"].startswith("r3") and audit["file_name"] == "order_reviews.csv"


def test_moved_header_is_refused(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_state,seller_zip_code_prefix,seller_city,seller_id\nSP,1,x,s1\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ"):
        csv_files.file_pattern_scan(spark, str(tmp_path), "sellers").collect()


def test_only_exact_file_names_are_read(spark, tmp_path):
    for name in ("sellers.csv", "resellers.csv", "sellers.csv.bak", "my_sellers.csv"):
        (tmp_path / name).write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n%s,1,x,SP\n" % name)
    assert [r.seller_id for r in csv_files.file_pattern_scan(spark, str(tmp_path), "sellers").collect()] == ["sellers.csv"]
    assert [r.seller_id for r in csv_files.file_pattern_scan(spark, str(tmp_path), "sellers", prefix="my_").collect()] == ["my_sellers.csv"]


def test_large_plain_files_are_split(spark, tmp_path):
    line = "s%d,1,city,SP\n"
    (tmp_path / "sellers.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "".join(line % i for i in range(200_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        df = csv_files.file_pattern_scan(spark, str(tmp_path), "sellers")
        assert df.rdd.getNumPartitions() > 3 and df.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_profile_scan_strips_the_byte_order_mark(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b"\xef\xbb\xbf" + b"a,b\n007,\n")
    df = csv_files.string_profile_scan(spark, str(path))
    assert df.columns == ["a", "b"] and tuple(df.first()) == ("007", None)


def test_overwrite_counts_rows_and_stores_dates(spark, tmp_path):
    df = spark.sql("select 1 a, timestamp_ntz'2018-01-02 03:04:05' t union all select 2, null")
    for _ in range(2):
        assert tables.table_overwrite(df, "ml", "t_dates", str(tmp_path / "t")) == 2
    assert dict(spark.table("ml.t_dates").dtypes)["t"] == "date"


def test_export_writes_headers(spark, tmp_path):
    tables.csv_export({"one": spark.sql("select 1 a, 'x,y' b")}, str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "one"))
    assert [tuple(r) for r in back.collect()] == [("1", "x,y")]


def test_stored_tables_use_the_folder_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.fixture
def delivery(spark, tmp_path):
    """Nine CSV files without key defects, some compressed."""
    from tidemark.sources.schemas import RAW_TABLES
    from tidemark.sources.star_binding import StarTables, raw_tables

    folder = tmp_path / "in"
    folder.mkdir()
    for name, df in raw_tables(StarTables(spark, "/root/testdata/sf0.001")).items():
        key = list(RAW_TABLES[name].key)
        if name == "order_items":
            df = df.dropDuplicates(["order_id", "order_item_id"])
        elif name == "order_payments":
            df = df.where("payment_value is not null").dropDuplicates(["order_id", "payment_sequential"])
        elif name == "order_reviews":
            df = df.where("review_score is not null").dropDuplicates(key)
        df.toPandas().to_csv(
            folder / f"olap_{name}.csv{'.gz' if name == 'sellers' else ''}", index=False, date_format="%Y-%m-%d %H:%M:%S")
    return folder


def test_build_from_files_to_extracts(spark, delivery, tmp_path):
    import os

    from tidemark.plans import pipeline
    from tidemark.plans.workspace import STAR_CONFIG

    (delivery / "olap_sellers.csv.bak").write_text("nothing to read")
    written = pipeline.build(spark, str(delivery), str(tmp_path / "db"), STAR_CONFIG, str(tmp_path / "out"), prefix="olap_")
    assert written["customer_retention_scores"] == spark.table("marts.dim_customers").count()
    assert len(os.listdir(tmp_path / "out")) == 10


def test_build_stops_before_the_marts(spark, delivery, tmp_path):
    from tidemark.plans import pipeline
    from tidemark.plans.workspace import STAR_CONFIG

    path = delivery / "olap_orders.csv"
    lines = path.read_text().splitlines()
    path.write_text("\n".join([*lines, lines[1]]) + "\n")
    with pytest.raises(pipeline.TestError, match="orders.order_id unique: 1"):
        pipeline.build(spark, str(delivery), str(tmp_path / "db"), STAR_CONFIG, prefix="olap_")
    assert not (tmp_path / "db" / "marts").exists()
    path.write_text("\n".join([*lines, "x,y"]) + "\n")
    with pytest.raises(pipeline.LoadError, match="olap_orders.csv"):
        pipeline.build(spark, str(delivery), str(tmp_path / "db2"), STAR_CONFIG, prefix="olap_")
    assert not (tmp_path / "db2").exists()


def test_a_workspace_releases_what_it_stored(spark):
    import os

    from tidemark.plans.workspace import Workspace

    with Workspace.over_star(spark, "/root/testdata/sf0.001", keep=True) as w:
        assert w.kpi_summary.count() == 1 and os.listdir(w.folder)
    assert not os.path.exists(w.folder)


def test_the_scoring_date_is_honoured(spark):
    import dataclasses
    import datetime as dt

    from tidemark.plans.workspace import STAR_CONFIG, Workspace
    from tidemark.sources.star_binding import StarTables, raw_tables

    raw = raw_tables(StarTables(spark, "/root/testdata/sf0.001"))
    with Workspace(raw, dataclasses.replace(STAR_CONFIG, scoring_date=dt.date(2001, 3, 1))) as w:
        assert {r.as_of_date for r in w.current.select("as_of_date").distinct().collect()} == {dt.date(2001, 3, 1)}
