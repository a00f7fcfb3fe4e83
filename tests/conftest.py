import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from concordat import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared").as_uri()
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.default.parallelism": "2", "spark.checkpoint.dir": shared},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a table as sorted tuples, nulls first."""

    def collect(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect


@pytest.fixture
def plan_of():
    """Text of the physical plan."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
