from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelworks.session import ensure_checkpoint_dir, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("panelworks-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "10g")
        .config("spark.sql.ui.retainedExecutions", "10")
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "50")
        .config("spark.sql.maxPlanStringLength", "200000")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield tune(session)
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a list of tuples, in the order of the named columns."""

    def collect(df, *cols, by=None):
        found = [tuple(r) for r in df.select(*cols).collect()]
        return sorted(found, key=by or (lambda r: tuple((v is not None, v) for v in r)))

    return collect
