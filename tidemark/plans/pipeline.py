"""The production runs: load files, build and test the marts, score customers and plan actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import RetentionConfig
from tidemark.operators import dashboards, decisions, quality
from tidemark.plans.workspace import Workspace
from tidemark.sources import csv_files
from tidemark.sources.schemas import RAW_TABLES
from tidemark.sources.scratch import inside, store
from tidemark.sources.tables import StagedTable, csv_export, drop_staged, layer_materialise, publish_tables, stage_table
from tidemark.sources.versions import VersionedTables

MARTS = (
    "fct_orders", "dim_customers", "dim_products", "customer_rfm", "kpi_summary", "monthly_revenue",
    "customer_acquisition_monthly", "category_performance", "cohort_retention",
)


def stage_all(spark: SparkSession, tables: dict[str, DataFrame], layer: str, root: str) -> dict[str, StagedTable]:
    """Write the next version of every table, measuring its declared tests on the way; none stays if one fails."""
    staged: dict[str, StagedTable] = {}
    try:
        for name, df in tables.items():
            staged[name] = stage_table(df, layer, name, f"{root}/{layer}/{name}", quality.observed_rules(name))
    except BaseException:
        drop_staged(spark, list(staged.values()))
        raise
    return staged


def score_customers(workspace: Workspace) -> dict[str, DataFrame]:
    """Fit, evaluate, refit, score and decide; the gate runs before anything is returned."""
    cfg = workspace.cfg
    with inside(workspace.folder):
        decided = store(workspace.decided, "decided")
    quality.require_gate(quality.gate_checks(decided, workspace.customer_rfm))
    as_of = F.col("as_of_date")
    return {
        "customer_retention_scores": decisions.retention_scores(decided, cfg, as_of),
        "model_evaluation": workspace.model_evaluation.withColumns(
            {"test_snapshot": F.lit(cfg.test_date), "horizon_days": F.lit(cfg.horizon_days)}
        ),
        "model_coefficients": workspace.coefficients,
        "model_lift_by_decile": workspace.model_deciles,
        "budget_scenarios": decisions.budget_scenarios(decided, cfg.budgets),
    }


def run(workspace: Workspace, database_root: str, extract_folder: str | None = None) -> dict[str, int]:
    """Marts and score tables as Parquet tables, dashboard extracts as CSV; returns rows per score table."""
    marts = stage_all(workspace.spark, {name: workspace.model(name) for name in MARTS}, "marts", database_root)
    publish_tables(workspace.spark, list(marts.values()))
    return publish(workspace, database_root, extract_folder)


def publish(workspace: Workspace, database_root: str, extract_folder: str | None) -> dict[str, int]:
    """Score tables, all or none, and the extracts from the written tables."""
    scored = stage_all(workspace.spark, score_customers(workspace), "ml", database_root)
    publish_tables(workspace.spark, list(scored.values()))
    written = {name: int(s.measured["rows"]) for name, s in scored.items()}
    if extract_folder:
        spark = workspace.spark
        marts = {n: spark.table(f"marts.{n}") for n in (
            "kpi_summary", "monthly_revenue", "cohort_retention", "customer_acquisition_monthly", "category_performance")}
        models = {
            "budget_scenarios": "budget_scenarios", "model_evaluation": "model_evaluation",
            "model_lift_by_decile": "model_lift_by_decile", "model_coefficients": "model_coefficients",
        }
        customers = dashboards.customers_extract(
            spark.table("ml.customer_retention_scores"), spark.table("marts.customer_rfm"))
        csv_export(
            {"customers": customers, **marts, **{n: spark.table(f"ml.{t}") for n, t in models.items()}}, extract_folder)
    return written


class LoadError(RuntimeError):
    """Files do not load completely; nothing was replaced."""


class TestError(RuntimeError):
    """A declared test failed; later layers were not built."""

    __test__ = False


def load_raw(
    spark: SparkSession, folder: str, root: str, prefix: str = "",
) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Audit the files of all nine tables, and only if every row loads replace the raw layer, in one commit.

    Rows and NULLs are counted by the load itself; a table whose rows differ from the audit's stops it.
    """
    patterns = {name: csv_files.file_pattern(name, prefix) for name in RAW_TABLES}
    audits = quality.stack([csv_files.load_audit(spark, folder, name, p) for name, p in patterns.items()])
    # One row for each file.
    rows = audits.select("table_name", "file_name", "status", "first_error", "rows_loaded").collect()
    bad = [f"{r.file_name}: {r.first_error}" for r in rows if r.status != "LOADED"]
    bad += [f"{name}: no file" for name in RAW_TABLES if name not in {r.table_name for r in rows}]
    if bad:
        raise LoadError("; ".join(bad))
    raw = VersionedTables(spark, f"{root}/raw")
    with raw.load() as load:
        for name, pattern in patterns.items():
            metrics = quality.null_counters(name) | quality.observed_rules(f"raw_{name}")
            measured = load.write(name, csv_files.csv_scan(spark, folder, name, pattern), metrics)
            expected = sum(r.rows_loaded for r in rows if r.table_name == name)
            if measured["rows"] != expected:
                raise LoadError(f"{name}: {expected} rows audited, {measured['rows']} loaded")
    version = raw.current()
    return {name: raw.read(name, version) for name in RAW_TABLES}, version.tables


def require_tests(workspace: Workspace, names: tuple[str, ...], measured: dict[str, dict[str, int]] | None = None) -> None:
    """Generic tests of the named models; the first failing layer stops the build.

    What the write of a model ``measured`` is not read again; uniqueness and relationships always are.
    """
    measured = measured or {}
    failed = [text for name in names if name in measured for text in quality.observed_failures(name, measured[name])]
    unseen = tuple(n for n in names if n not in measured)
    checks = [
        f(workspace.model, of) for f, of in (
            (quality.generic_unique, names), (quality.generic_relationships, names),
            (quality.generic_not_null, unseen), (quality.generic_accepted_values, unseen))
        if _declared(f, of)]
    if checks:
        rows = quality.stack(checks).where("failures > 0").collect()  # at most one row for each declared test
        failed += [f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in rows]
    if failed:
        raise TestError("; ".join(failed))


def _declared(test, names: tuple[str, ...]) -> bool:
    kind = {"generic_accepted_values": "accepted"}.get(test.__name__, test.__name__.removeprefix("generic_"))
    return any(quality.MODEL_TESTS.get(n, {}).get(kind) for n in names)


def require_singular(workspace: Workspace) -> None:
    tests = quality.singular_tests(
        workspace.joined_orders, workspace.dim_customers, workspace.customer_rfm, workspace.monthly_revenue,
        workspace.kpi_summary, workspace.cohort_retention, workspace.cfg)
    rows = quality.stack([quality.as_check(n, bad) for n, bad in tests.items()]).collect()  # one row for each test
    failed = [f"{r.check_name}: {r.violations}" for r in rows if r.status != "PASS"]
    if failed:
        raise TestError("; ".join(failed))


def build(
    spark: SparkSession, folder: str, root: str, cfg: RetentionConfig, extracts: str | None = None, prefix: str = "",
) -> dict[str, int]:
    """From nine CSV files (plain or gzip) to marts, score tables and dashboard extracts.

    Files are audited first. Staging models become views and are tested before the
    marts are written; the marts are tested before they replace the old ones, and the old score tables stay
    until the new ones are complete.
    """
    raw, loaded = load_raw(spark, folder, root, prefix)
    with Workspace(raw, cfg, keep=True) as workspace:
        staging = tuple(n for n in quality.MODEL_TESTS if n not in MARTS)
        layer_materialise({n: workspace.model(n) for n in staging}, "staging", as_tables=False)
        require_tests(workspace, staging, {f"raw_{name}": m for name, m in loaded.items()})
        marts = stage_all(spark, {name: workspace.model(name) for name in MARTS}, "marts", root)
        try:
            # Tests and later steps read what was written.
            for name, staged in marts.items():
                setattr(workspace, name, staged.read(spark))
            require_tests(workspace, tuple(n for n in quality.MODEL_TESTS if n in MARTS), {n: s.measured for n, s in marts.items()})
            require_singular(workspace)
        except BaseException:
            drop_staged(spark, list(marts.values()))
            raise
        publish_tables(spark, list(marts.values()))
        return publish(workspace, root, extracts)
