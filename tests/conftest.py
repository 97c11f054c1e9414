import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roomtide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def d():
    """``d("2016-01-29")`` is that date."""
    return lambda text: date.fromisoformat(text) if text else None


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def plan():
    """Physical plan text of a DataFrame."""
    def text(df):
        return df._jdf.queryExecution().toString()

    return text
