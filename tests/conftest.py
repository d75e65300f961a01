import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.sources.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(folder / "stored"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.driver.memory": "4g",
            # Tiny tables would be coalesced into one slice; the scans must be tested across slices.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def workspace(spark):
    from tidemark.plans.workspace import Workspace

    return Workspace.over_star(spark, SMALL, keep=True)
