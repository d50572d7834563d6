import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagewright.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        cores=4,
        extra={
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
