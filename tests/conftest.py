import os
import sys

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(TESTS))
# functions defined in test modules run in Python workers as well
os.environ["PYTHONPATH"] = os.pathsep.join([TESTS, os.environ.get("PYTHONPATH", "")])

from docpipe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, name="docpipe-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="session")
def records(spark):
    """JSON texts to (doc_id, response VARIANT), ids from 1."""

    def build(*texts):
        rows = [(str(i), t) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame(rows, "doc_id string, json string").selectExpr(
            "doc_id", "try_parse_json(json) AS response"
        )

    return build
