import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from formline.operators.ordered import HOT_ROWS_CONF  # noqa: E402
from formline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "formline-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_groups(spark):
    """Makes every group above 20 rows count as hot."""
    spark.conf.set(HOT_ROWS_CONF, "20")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


def rows_of(df, *columns):
    """Rows as sorted tuples, for order-free comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
