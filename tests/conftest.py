import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.session import build_session  # noqa: E402
from tallyframe.sources.tables import inline_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            # Small data: quick start matters more than peak speed.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.sql.codegen.wholeStage": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def frame(spark):
    """Build a small relation: frame("a int, b string", (1, "x"), ..)."""
    return lambda schema, *rows: inline_rows(spark, rows, schema)


@pytest.fixture
def no_broadcast(spark):
    """Treat every side as too large to broadcast and large enough to skew, so the shuffle paths run."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df, *columns):
    """Rows as tuples, in the order given."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def bag(df, *columns):
    """Rows as tuples, in an order of their own."""
    return sorted(rows(df, *columns), key=str)
