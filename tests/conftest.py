import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ombuds.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
            "spark.driver.memory": "6g",
            # Compiling plans takes longer than running them on a handful of rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}"


def rows(df, *order):
    """Rows as tuples in a stable order, NULLs first."""
    found = [tuple(row) for row in df.select(*(order or df.columns)).collect()]
    return sorted(found, key=lambda row: [(value is not None, str(value)) for value in row])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
