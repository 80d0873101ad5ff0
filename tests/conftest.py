from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from flowplan import schemas  # noqa: E402
from flowplan.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("flowplan-tests", 4)
    yield session
    session.stop()


def day(i: int) -> dt.date:
    return dt.date(2023, 1, 1) + dt.timedelta(days=i)


class Make:
    """Tiny tables from plain values."""

    def __init__(self, spark):
        self.spark = spark

    def demand(self, **series):
        """Daily series from 2023-01-01, by destination."""
        rows = [(day(i), d, None if v is None else float(v)) for d, vs in series.items() for i, v in enumerate(vs)]
        return self.spark.createDataFrame(rows, schemas.DEMAND_HISTORY)

    def origins(self, **capacity):
        return self.spark.createDataFrame(
            [(o, float(c)) for o, c in capacity.items()], schemas.ORIGINS
        )

    def lanes(self, *rows):
        return self.spark.createDataFrame([(o, d, float(c)) for o, d, c in rows], schemas.LANES)

    def destinations(self, **holding):
        return self.spark.createDataFrame(
            [(d, None if h is None else float(h)) for d, h in holding.items()], schemas.DESTINATIONS
        )

    def stock(self, **qty):
        return self.spark.createDataFrame(
            [(d, float(q)) for d, q in qty.items()], schemas.INITIAL_INVENTORY
        )


@pytest.fixture
def make(spark):
    return Make(spark)
