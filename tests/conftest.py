import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples; NULL sorts first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return plan_of
