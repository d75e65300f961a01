"""Table sources and sinks: reloads, overwrites, layers and dashboard extracts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.csv_files import csv_scan
from tidemark.sources.versions import Folder, VersionedTables, write_observed

LAYERS = ("raw", "staging", "intermediate", "marts", "ml")
EXTRACTS = (
    "customers", "kpi_summary", "monthly_revenue", "cohort_retention", "customer_acquisition_monthly",
    "category_performance", "budget_scenarios", "model_evaluation", "model_lift_by_decile", "model_coefficients",
)


def full_reload(spark: SparkSession, source: str, table: str, target: str) -> DataFrame:
    """Replace the target with everything in the source folder; rerunning changes nothing.

    The old rows stay in place until the new ones are complete: a bad row leaves the target as it was.
    """
    target_tables = VersionedTables(spark, target)
    with target_tables.load() as load:
        load.write(table, csv_scan(spark, source, table))
    return target_tables.read(table)


def lowercase(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def table_scan_lowercase(spark: SparkSession, table: str) -> DataFrame:
    return lowercase(spark.table(table))


def dates_for_timestamps(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.to_date(c) for c in stamps}) if stamps else df


@dataclass(frozen=True)
class StagedTable:
    """A complete table that nobody sees yet."""

    database: str
    table: str
    base: str
    version: str
    measured: dict[str, int]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/{self.version}")


def stage_table(
    df: DataFrame, database: str, table: str, path: str | None = None, metrics: dict[str, Column] | None = None,
) -> StagedTable:
    """Write a table's next version (timestamps as dates) beside the one in use, measuring it on the way."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    base = (path or f"{spark.catalog.getDatabase(database).locationUri}/{table}").rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    try:
        measured = write_observed(dates_for_timestamps(df), f"{base}/{version}", metrics)
    except BaseException:
        Folder(spark, base).delete(version)
        raise
    return StagedTable(database, table, base, version, measured)


def publish_tables(spark: SparkSession, staged: list[StagedTable]) -> None:
    """Let the catalog's tables point to the staged versions; the version in use before stays on disk, older ones go."""
    for s in staged:
        name, location = f"`{s.database}`.`{s.table}`", f"{s.base}/{s.version}"
        before = None
        if spark.catalog.tableExists(f"{s.database}.{s.table}"):
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
            before = rows[0].data_type.rstrip("/").rsplit("/", 1)[-1] if rows else None
            if spark.table(name).schema == s.read(spark).schema:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
                spark.catalog.refreshTable(name)
            else:
                spark.sql(f"DROP TABLE {name}")
        if not spark.catalog.tableExists(f"{s.database}.{s.table}"):
            spark.catalog.createTable(f"{s.database}.{s.table}", path=location, source="parquet")
        folder = Folder(spark, s.base)
        for old in folder.names(""):
            if old.startswith("v-") and old not in (s.version, before):
                folder.delete(old)


def drop_staged(spark: SparkSession, staged: list[StagedTable]) -> None:
    for s in staged:
        Folder(spark, s.base).delete(s.version)


def table_overwrite(df: DataFrame, database: str, table: str, path: str | None = None) -> int:
    """Create the database if needed, replace the table and return the rows written.

    A failing write leaves the table as it was.
    """
    staged = stage_table(df, database, table, path)
    publish_tables(df.sparkSession, [staged])
    return int(staged.measured["rows"])


def layer_materialise(models: dict[str, DataFrame], layer: str, as_tables: bool, root: str | None = None) -> None:
    """Staging and intermediate models become views, marts become tables of their layer: all of them, or none."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    if not as_tables:
        for name, df in models.items():
            df.createOrReplaceTempView(f"{layer}_{name}")
        return
    staged: list[StagedTable] = []
    try:
        for name, df in models.items():
            staged.append(stage_table(df, layer, name, f"{root}/{layer}/{name}" if root else None))
    except BaseException:
        if staged:
            drop_staged(next(iter(models.values())).sparkSession, staged)
        raise
    if staged:
        publish_tables(next(iter(models.values())).sparkSession, staged)


def csv_export(extracts: dict[str, DataFrame], folder: str) -> None:
    """One folder of header CSV files per extract, written by the executors."""
    for name, df in extracts.items():
        df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(f"{folder}/{name}")
