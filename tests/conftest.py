import datetime as dt
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lake(spark, tmp_path):
    from rosterlake.sources.tables import Lake

    return Lake(spark, f"test_{uuid.uuid4().hex[:12]}", str(tmp_path))


@pytest.fixture
def no_broadcast(spark):
    """Every join shuffles, as with dimensions beyond the broadcast threshold."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def day(text):
    return dt.date.fromisoformat(text)


def rows(frame, *columns):
    """Rows as sorted tuples."""
    columns = columns or frame.columns
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
