import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from granary.session import build_session  # noqa: E402


def final_plan(df):
    """The physical plan of `df`; after a run with what adaptive execution made of it."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "granary-tests",
        "local[8]",
        {
            "spark.checkpoint.dir": f"{root}/shared",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
