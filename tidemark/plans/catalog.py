"""Named queries: what runs in Spark, and the oracle SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.oracle_models import with_models
from tidemark.plans.workspace import Workspace
from tidemark.sources.scratch import inside

DIGITS = 6


@dataclass(frozen=True)
class Query:
    """``money`` columns are decimals shown as doubles; ``approx`` doubles are shown to six digits,
    because the order of floating-point addition is not fixed."""

    build: Callable[[Workspace], DataFrame]
    sql: str | None = None
    money: tuple[str, ...] = ()
    approx: tuple[str, ...] = ()

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        workspace = shared_workspace(spark, folder)
        with inside(workspace.folder):
            return self.shown(self.build(workspace))

    def shown(self, df: DataFrame) -> DataFrame:
        decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
        shown = {c: F.col(c).cast("double") for c in decimals}
        shown |= {c: F.round(F.col(c).cast("double"), DIGITS) for c in self.approx}
        return df.withColumns(shown) if shown else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        swaps = [f"{c}::DOUBLE as {c}" for c in self.money if c not in self.approx]
        swaps += [f"round({c}::DOUBLE, {DIGITS}) as {c}" for c in self.approx]
        replace = f" replace ({', '.join(swaps)})" if swaps else ""
        return with_models(f"select *{replace} from ({self.sql}) final_rows")


CATALOG: dict[str, Query] = {}
_WORKSPACES: dict[tuple[str, str], tuple[tuple, Workspace]] = {}


def file_state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files of a data set."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    state = []
    while found.hasNext():
        f = found.next()
        state.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(state))


def shared_workspace(spark: SparkSession, folder: str) -> Workspace:
    """One workspace per session and data set: marts are stored once and all queries read them.

    Files that changed since make a new one; what the old one stored is released.
    """
    key, state = (spark.sparkContext.applicationId, folder), file_state(spark, folder)
    if key in _WORKSPACES and _WORKSPACES[key][0] != state:
        _WORKSPACES.pop(key)[1].close()
    if key not in _WORKSPACES:
        _WORKSPACES[key] = (state, Workspace.over_star(spark, folder, keep=True))
    return _WORKSPACES[key][1]


def query(key: str, sql: str | None = None, money: str = "", approx: str = ""):
    """Register a workspace function under a key."""

    def register(build: Callable[[Workspace], DataFrame]):
        if key in CATALOG:
            raise ValueError(f"duplicate query {key}")
        CATALOG[key] = Query(build, sql, tuple(money.split()), tuple(approx.split()))
        return build

    return register


def model_query(key: str, source: str, money: str = "", approx: str = "", model: str | None = None) -> None:
    """Register a model as it is."""
    query(key, f"from {source}", money, approx)(lambda w: w.model(model or source))


def load() -> dict[str, Query]:
    """The complete catalog (query modules register on import)."""
    from tidemark.plans import (  # noqa: F401
        queries_decisions, queries_marts, queries_models, queries_quality, queries_relational, queries_sources,
    )

    return CATALOG
