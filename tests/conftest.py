import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gleaner.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate a column over one row of named string, list or other values."""

    def evaluate(column, **inputs):
        schema = inputs.pop("schema", None)
        rows = [tuple(inputs.values()) or (0,)]
        columns = schema or ", ".join(f"{n} STRING" for n in inputs) or "unused INT"
        return spark.createDataFrame(rows, columns).select(column.alias("v")).first()["v"]

    return evaluate


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
