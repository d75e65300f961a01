"""Column profiles and dashboard tiles: the same rows from fewer scans and narrower shuffles."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dashboards, quality


def rows_of(df):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())


@pytest.fixture(scope="module")
def wide(spark):
    return spark.range(3000).selectExpr(
        "id", "concat(repeat('long text ', 200), id % 700) as body", "if(id % 3 = 0, null, 'x') as `odd name`", "cast(null as string) as nothing",
        "'same' as hot", "concat('a', chr(10), 'b') as broken")


def test_profile_counts_exactly(spark, wide):
    found = {r.column_name: r for r in quality.profile_columns(wide, "t").collect()}
    assert {c: r.distinct_values for c, r in found.items()} == {"id": 3000, "body": 700, "odd name": 1, "nothing": 0, "hot": 1, "broken": 1}
    assert found["odd name"].nulls == 1000 and found["nothing"].null_pct == 100 and found["broken"].example == "a b"
    assert found["body"].example == "long text " * 200 + "0" and found["nothing"].example is None
    assert quality.profile_columns(wide.where("false"), "t").count() == 6
    assert quality.profile_columns(wide, "t", width=3).where("column_name = 'hot'").first().example == "sam"


def test_exact_counts_shuffle_hashes_only(wide):
    plan = quality.distinct_values(wide)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("body" not in line and "example" not in line for line in exchanges)
    assert all(r.collisions == 0 for r in quality.distinct_values(wide).collect())


def test_estimates_stay_within_three_standard_errors(wide):
    exact = {r.column_name: r.distinct_values for r in quality.profile_columns(wide, "t").collect()}
    close = {r.column_name: r.distinct_values for r in quality.profile_columns(wide, "t", approximate=True).collect()}
    assert all(abs(close[c] - n) <= 3 * 1.04 / 2 ** (quality.SKETCH_LOG_K / 2) * n for c, n in exact.items())


def test_tiles_from_measures_equal_their_own_functions(workspace):
    extract = workspace.extract
    tiles = dashboards.tiles_of(workspace.tile_measures, "SP")
    assert set(tiles) == set(dashboards.TILES)
    for name, tile in tiles.items():
        own = dashboards.segment_bars(extract, "SP") if name == "segment_bars_by_state" else getattr(dashboards, name)(extract)
        assert tile.columns == own.columns and rows_of(tile) == rows_of(own), name


def test_tiles_read_the_extract_once_and_keep_missing_keys_apart(spark, workspace):
    stored = workspace.extract.withColumn("risk_tier", F.when(F.col("r_score") > 1, F.col("risk_tier")))
    path = f"{workspace.folder}/extract-copy"
    stored.write.mode("overwrite").parquet(path)
    extract = spark.read.parquet(path)
    measures = dashboards.tile_measures(extract)
    plan = measures._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert rows_of(dashboards.tiles_of(measures, "SP")["risk_distribution"]) == rows_of(dashboards.risk_distribution(extract))
    assert measures.where("tile is null").count() == 0
