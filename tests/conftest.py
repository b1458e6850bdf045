import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandgrid.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="demandgrid-tests", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="demandgrid-test-wh-"),
                         "spark.checkpoint.dir": tempfile.mkdtemp(prefix="demandgrid-test-ckpt-"),
                         "spark.driver.memory": "4g"})
    yield s


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@pytest.fixture
def two_entity_panel(spark):
    """SP 10..50, RJ 5..45 over 5 days from 2024-01-01."""
    rows = []
    for i in range(5):
        d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        rows.append((d, "SP", 10 * (i + 1)))
        rows.append((d, "RJ", 5 + 10 * i))
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")
