import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trolley.plans.baskets import open_baskets
from trolley.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "trolley-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def baskets(spark):
    return open_baskets(spark, SMALL)


@pytest.fixture(scope="module", autouse=True)
def no_rows_left():
    """Rows that a module's tests keep in memory go with it."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test only."""
    changed = []

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.append((name, spark.conf.get(name, None)))
            spark.conf.set(name, value)

    yield change
    for name, value in reversed(changed):
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
