"""Time the headline queries; prints one JSON line.

Every query starts from the source tables in a workspace of its own, so nothing
stored by one query helps another; what it stored is released after it. A warm-up
over one query comes first, so that start-up is in no figure. Beside the seconds
stand the shuffled megabytes and the longest task's share of its stage's task time
(of the stage that ran longest).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import pipeline  # noqa: E402
from tidemark.plans.workspace import Workspace  # noqa: E402
from tidemark.sources.scratch import fresh_path  # noqa: E402
from tidemark.sources.session import build_session  # noqa: E402

HEADLINE = (
    "joined_orders", "orders_enriched", "customer_rfm", "kpi_summary", "monthly_revenue", "category_performance",
    "cohort_retention", "labelled", "rule_evaluation", "rule_decided", "null_checks", "value_domain_checks",
    "relationship_checks", "full_pipeline",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(name: str, workspace: Workspace) -> None:
    from tidemark.operators import quality

    if name == "full_pipeline":
        pipeline.run(workspace, fresh_path(workspace.spark, "tables"), fresh_path(workspace.spark, "extracts"))
    elif name == "value_domain_checks":
        consume(quality.value_domain_checks(workspace.raw, workspace.cfg))
    elif name in ("null_checks", "relationship_checks"):
        consume(getattr(quality, name)(workspace.raw))
    else:
        consume(workspace.model(name))


class Stages:
    """What the session's stages did since the last look."""

    def __init__(self, spark):
        self.store, self.seen = spark.sparkContext._jsc.sc().statusStore(), -1
        self.none, self.no_quantiles = spark._jvm.java.util.ArrayList(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def look(self) -> dict[str, float]:
        found = self.store.stageList(self.none, False, False, self.no_quantiles, self.none)
        new = [s for s in (found.apply(i) for i in range(found.size())) if s.stageId() > self.seen]
        self.seen = max([self.seen, *(s.stageId() for s in new)])
        moved = sum(s.shuffleWriteBytes() for s in new)
        share = 0.0
        if longest := max(new, key=lambda s: s.executorRunTime(), default=None):
            tasks = self.store.taskList(longest.stageId(), longest.attemptId(), 10_000)
            times = [t.duration().get() for t in (tasks.apply(i) for i in range(tasks.size())) if t.duration().isDefined()]
            share = max(times, default=0) / max(1, sum(times))
        return {"shuffle_mb": round(moved / 1e6, 2), "longest_task_share": round(share, 3)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    several_readers = {"labelled", "rule_decided", "rule_evaluation", "full_pipeline"}
    with Workspace.over_star(spark, folder) as workspace:
        run("orders_enriched", workspace)
    stages, seconds, moved = Stages(spark), {}, {}
    stages.look()
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        with Workspace.over_star(spark, folder, keep=name in several_readers) as workspace:
            run(name, workspace)
            seconds[name] = round(time.time() - start, 3)
        moved[name] = stages.look()
        print(name, seconds[name], moved[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "stages": moved, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
