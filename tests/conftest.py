from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wheelhouse.session import build_session

    session = build_session(
        "wheelhouse-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('scratch')}"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """The plan after adaptive execution, without the initial one."""
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture()
def plan():
    return plan_of


@pytest.fixture()
def final_plan():
    return final_plan_of
