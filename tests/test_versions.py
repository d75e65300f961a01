"""All tables of a load or none, staged tables of the catalog, and tests measured by the write."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.sources import tables
from tidemark.sources.versions import LoadConflictError, VersionedTables

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def failing(spark):
    """A row that fails while the table is written."""
    return numbers(spark, 1, 2, 3).withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("bad row")).cast("int")).otherwise(F.col("n")))


def test_a_failure_in_the_last_table_leaves_all_old_ones(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    names = [f"t{k}" for k in range(9)]
    with store.load() as load:
        for k, name in enumerate(names):
            load.write(name, numbers(spark, k))
    with pytest.raises(Exception, match="bad row"), store.load() as load:
        for name in names[:-1]:
            load.write(name, numbers(spark, 100))
        load.write(names[-1], failing(spark))
    assert [store.read(n).first()[0] for n in names] == list(range(9))
    assert len(os.listdir(tmp_path / "versions")) == 1 and store.current().number == 0
    with store.load() as load:
        for name in names:
            load.write(name, numbers(spark, 7, 8))
    assert store.current().tables["t3"] == {"rows": 2} and store.read("t8").count() == 2


def test_two_loads_from_the_same_version_cannot_both_commit(spark, tmp_path):
    first, second = (VersionedTables(spark, str(tmp_path)) for _ in range(2))
    with pytest.raises(LoadConflictError), first.load() as a:
        a.write("t", numbers(spark, 1))
        with second.load() as b:
            b.write("t", numbers(spark, 2))
    assert first.read("t").first()[0] == 2 and len(first.history()) == 1


def test_old_versions_stay_readable_until_they_are_dropped(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    for k in range(4):
        with store.load(keep=2) as load:
            load.write("t", numbers(spark, k))
    assert [store.read("t", v).first()[0] for v in store.history()] == [2, 3]
    assert len(os.listdir(tmp_path / "versions")) == 2
    # A writer that died while writing its commit leaves a number that nobody reads and nobody takes again.
    (tmp_path / "commits" / "0000000004").write_text('{"folder": "ver')
    assert store.read("t").first()[0] == 3
    with store.load() as load:
        load.write("t", numbers(spark, 9))
    assert store.current().number == 5 and store.read("t").first()[0] == 9
    with pytest.raises(LookupError):
        store.read("other")
    with pytest.raises(ValueError, match="already"), store.load() as load:
        load.write("t", numbers(spark, 1))
        load.write("t", numbers(spark, 1))
    with pytest.raises(LookupError):
        VersionedTables(spark, str(tmp_path / "none")).read("t")


def test_full_reload_keeps_the_old_rows_when_a_row_is_bad(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "sellers.csv").write_text(HEADER + "s1,1,x,SP\ns2,2,y,RJ\n")
    assert tables.full_reload(spark, str(source), "sellers", target).count() == 2
    (source / "sellers.csv").write_text(HEADER + "s3,1,x,SP\n" + "s4\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.full_reload(spark, str(source), "sellers", target)
    assert {r.seller_id for r in VersionedTables(spark, target).read("sellers").collect()} == {"s1", "s2"}
    (source / "sellers.csv").write_text(HEADER + "s3,1,x,SP\n")
    for _ in range(2):
        assert [r.seller_id for r in tables.full_reload(spark, str(source), "sellers", target).collect()] == ["s3"]


def test_overwrite_keeps_the_old_table_and_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.table_overwrite(numbers(spark, 1, 2), "ml", "t_staged", path) == 2
    with pytest.raises(Exception, match="bad row"):
        tables.table_overwrite(failing(spark), "ml", "t_staged", path)
    assert spark.table("ml.t_staged").count() == 2 and len(os.listdir(path)) == 1
    for k in range(3):
        tables.table_overwrite(numbers(spark, *range(k)), "ml", "t_staged", path)
    assert spark.table("ml.t_staged").count() == 2 and len(os.listdir(path)) == 2
    tables.table_overwrite(numbers(spark, 5).withColumn("m", F.lit("x")), "ml", "t_staged", path)
    assert tuple(spark.table("ml.t_staged").first()) == (5, "x")
    assert tables.table_overwrite(numbers(spark, 4), "ml", "t_in_warehouse") == 1 and spark.table("ml.t_in_warehouse").first()[0] == 4


def test_a_layer_changes_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    tables.layer_materialise({"a_whole": numbers(spark, 1), "b_whole": numbers(spark, 2)}, "ml", True, root)
    with pytest.raises(Exception, match="bad row"):
        tables.layer_materialise({"a_whole": numbers(spark, 10), "b_whole": failing(spark)}, "ml", True, root)
    assert (spark.table("ml.a_whole").first()[0], spark.table("ml.b_whole").first()[0]) == (1, 2)
    assert len(os.listdir(tmp_path / "ml" / "a_whole")) == 1
    tables.layer_materialise({}, "ml", True, root)


def test_rules_measured_by_the_write_equal_the_tests(spark, workspace, tmp_path):
    spoiled = workspace.customer_rfm.withColumn("r_score", F.when(F.col("order_count") > 4, 9).otherwise(F.col("r_score")))
    spoiled = spoiled.withColumn("rfm_segment", F.when(F.col("m_score") == 1, None).otherwise(F.col("rfm_segment")))
    staged = tables.stage_table(spoiled, "ml", "t_rules", str(tmp_path / "t"), quality.observed_rules("customer_rfm"))
    nulls, odd = spoiled.where("rfm_segment is null").count(), spoiled.where("r_score = 9").count()
    assert nulls and odd
    assert quality.observed_failures("customer_rfm", staged.measured) == [
        f"customer_rfm.rfm_segment not_null: {nulls}", f"customer_rfm.r_score accepted_values: {odd}"]
    clean = tables.stage_table(workspace.customer_rfm, "ml", "t_rules", str(tmp_path / "t"), quality.observed_rules("customer_rfm"))
    assert quality.observed_failures("customer_rfm", clean.measured) == []
    assert clean.measured["rows"] == workspace.customer_rfm.count()
