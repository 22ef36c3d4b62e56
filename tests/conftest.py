import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import schemas  # noqa: E402
from tidemark.session import build_session, scratch_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    s.conf.set("tidemark.state.partitions", "2")     # small streams: few state stores
    yield s


@pytest.fixture
def scratch(spark, request):
    return scratch_dir(spark, request.node.name.replace("[", "_").replace("]", "_"))


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def raw_row(order_id, amount, status="SUCCESS", method="UPI", device="ANDROID",
            time="2024-01-01 00:00:00", customer="C1", product="P1", city="Mumbai", quantity=1):
    t = ts(time)
    return (t.strftime("%Y%m%d"), order_id, customer, product,
            None if amount is None else Decimal(str(amount)), quantity, status, "PLACED", method,
            device, city, t)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDERS_RAW)


def customers_df(spark, rows):
    """rows: (customer_id, name, tier)"""
    return spark.createDataFrame(
        [(c, n, "Mumbai", tier, dt.date(2023, 1, 1), ts("2023-01-01 10:30:00")) for c, n, tier in rows],
        schemas.CUSTOMER_PROFILE)


def products_df(spark, rows):
    """rows: (product_id, name, category)"""
    return spark.createDataFrame(
        [(p, n, cat, "Brand", Decimal("10.00"), 50, ts("2024-01-01 00:00:00")) for p, n, cat in rows],
        schemas.PRODUCT_CATALOG)
