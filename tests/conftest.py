from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from winback import ShopTables, build_session  # noqa: E402
from winback.sources import delivered, schemas  # noqa: E402
from winback.sources.shop_csv import to_schema  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "winback-tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["even", "hot"])
def hot_or_even(spark, request):
    """Run a test twice: once as is, once with every key (and null) treated as hot."""
    if request.param == "hot":
        spark.conf.set("spark.winback.skew.minRows", "0")
    yield request.param
    spark.conf.unset("spark.winback.skew.minRows")


CUSTOMERS = [
    ("c1", "U1", "SP"), ("c2", "U1", "RJ"), ("c3", "U2", "SP"), ("c4", "U3", "RJ"),
    ("c5", "U4", "AM"), ("c6", "U5", "SP"), ("c7", "U6", "SP"), ("c8", "U7", "MG"),
]
ORDERS = [
    ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-05 09:00:00"),
    ("o2", "c2", "delivered", "2018-06-01 00:00:00", "2018-06-11 00:00:00"),
    ("o3", "c3", "delivered", "2017-01-01 12:00:00", None),
    ("o4", "c3", "delivered", "2017-10-13 12:00:00", "2017-10-13 06:00:00"),
    ("o5", "c4", "delivered", "2018-07-21 12:00:00", None),
    ("o6", "c5", "delivered", "2017-10-13 12:00:01", "not a date"),
    ("o7", "c6", "canceled", "2018-12-31 00:00:00", None),
    ("o8", "c7", "delivered", "2018-05-01 00:00:00", None),
    ("o9", "c8", "delivered", "2018-05-02 00:00:00", "2018-05-22 00:00:00"),
    ("o10", "c99", "delivered", "2019-01-01 00:00:00", "2019-01-03 00:00:00"),
]
PAYMENTS = [
    ("o1", "1", "100"), ("o1", "3", "50"), ("o2", "5", "30"), ("o3", "1", "10"), ("o5", "10", "500"),
    ("o6", "1", None), ("o7", "1", "999"), ("o9", "1", "70"), ("o9", "2", "5"),
]
REVIEWS = [("o1", "5"), ("o1", "3"), ("o2", "1"), ("o3", "4"), ("o6", "2"), ("o9", "5")]

# person: frequency, delivery days, spend, instalments, review, has_review, churned, recency
EXPECTED_FEATURES = {
    "U1": (2, 6.5, 180.0, 3.0, 3.0, 1, 0, 50),
    "U2": (2, -1.0, 10.0, 1.0, 4.0, 1, 1, 281),
    "U3": (1, 7.0625, 500.0, 10.0, 3.0, 0, 0, 0),
    "U4": (1, 7.0625, 0.0, 1.0, 2.0, 1, 0, 280),
    "U6": (1, 2.75, 0.0, 0.0, 3.0, 0, 0, 81),
    "U7": (1, 20.0, 75.0, 1.5, 5.0, 1, 0, 80),
}


def text_frame(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in columns))


def shop_tables(spark, customers=CUSTOMERS, orders=ORDERS, payments=PAYMENTS, reviews=REVIEWS) -> ShopTables:
    order_columns = [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
    ]
    dated = [row + (None, None, None) for row in orders]
    order_columns += ["order_approved_at", "order_delivered_carrier_date", "order_estimated_delivery_date"]
    return ShopTables(
        customers=to_schema(
            text_frame(spark, customers, ["customer_id", "customer_unique_id", "customer_state"]), schemas.CUSTOMERS
        ),
        orders=delivered(to_schema(text_frame(spark, dated, order_columns), schemas.ORDERS)),
        payments=to_schema(
            text_frame(spark, payments, ["order_id", "payment_installments", "payment_value"]), schemas.PAYMENTS
        ),
        reviews=to_schema(text_frame(spark, reviews, ["order_id", "review_score"]), schemas.REVIEWS),
    )


@pytest.fixture(scope="session")
def shop(spark):
    return shop_tables(spark)


def feature_rows(df) -> dict:
    names = [
        "frequency", "avg_delivery_days", "monetary_value", "avg_installments",
        "avg_review_score", "has_review", "is_churn", "recency",
    ]
    return {row["customer_unique_id"]: tuple(row[name] for name in names) for row in df.collect()}
