from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest
from helpers import LINE_SCHEMA

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.functions.sharing import release_shared  # noqa: E402
from tillroll.operators.cleaning import add_sales_amounts  # noqa: E402
from tillroll.session import local_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "6g")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def _drop_shared():
    yield
    release_shared()


@pytest.fixture
def lines(spark):
    """Order lines from dicts; dates as ISO text, prices as text. ``place`` is the
    position in the list."""

    def build(*rows: dict):
        defaults = {
            "customer_id": "c",
            "order_id": "o",
            "product_name": "p",
            "customer_segment": "Corporate",
            "order_date": "2013-01-01",
            "quantity": 1,
            "unit_price": "1.00",
            "shipping_cost": "0.00",
        }

        def record(place, row):
            r = {**defaults, **row, "place": place}
            if r["order_date"] is not None:
                r["order_date"] = dt.date.fromisoformat(r["order_date"])
            for c in ("unit_price", "shipping_cost"):
                r[c] = None if r[c] is None else Decimal(r[c])
            return tuple(r[f.name] for f in LINE_SCHEMA)

        records = [record(i, row) for i, row in enumerate(rows)]
        return add_sales_amounts(spark.createDataFrame(records, LINE_SCHEMA))

    return build
