import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airgrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Rows ``(series_id, date, v)`` from a list of values on consecutive days from 2025-01-01."""
    from datetime import date, timedelta

    def make(values, days=None, kind="double", name="s"):
        days = days or range(1, len(values) + 1)
        rows = [
            (name, date(2025, 1, 1) + timedelta(days=d - 1), v)
            for d, v in zip(days, values, strict=True)
        ]
        return spark.createDataFrame(rows, f"series_id string, date date, v {kind}")

    return make


def column(df, name, *order):
    """Values of one column, ordered."""
    return [r[name] for r in df.orderBy(*(order or ("date",))).collect()]
