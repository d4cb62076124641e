import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from shopstrata import Lake, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
