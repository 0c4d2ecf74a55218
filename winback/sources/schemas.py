"""Columns the engine reads, and the set of shop tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TEXT, NUMBER, MOMENT = T.StringType(), T.DoubleType(), T.TimestampNTZType()

CUSTOMERS = _struct(customer_id=TEXT, customer_unique_id=TEXT, customer_state=TEXT)
ORDERS = _struct(
    order_id=TEXT,
    customer_id=TEXT,
    order_status=TEXT,
    order_purchase_timestamp=MOMENT,
    order_approved_at=MOMENT,
    order_delivered_carrier_date=MOMENT,
    order_delivered_customer_date=MOMENT,
    order_estimated_delivery_date=MOMENT,
)
PAYMENTS = _struct(order_id=TEXT, payment_installments=NUMBER, payment_value=NUMBER)
REVIEWS = _struct(order_id=TEXT, review_score=NUMBER)

ORDER_DATES = [field.name for field in ORDERS if field.dataType == MOMENT]


@dataclass(frozen=True)
class ShopTables:
    """The tables of one shop; a table that was not found is ``None``."""

    customers: DataFrame | None = None
    orders: DataFrame | None = None
    payments: DataFrame | None = None
    reviews: DataFrame | None = None
    geolocation: DataFrame | None = None

    def found(self) -> list[str]:
        return [field.name for field in fields(self) if getattr(self, field.name) is not None]

    def require(self, *names: str) -> tuple[DataFrame, ...]:
        """The named tables, or one error that lists every missing one."""
        missing = [name for name in names if getattr(self, name) is None]
        if missing:
            raise ValueError(f"this step needs tables that were not loaded: {', '.join(missing)}")
        return tuple(getattr(self, name) for name in names)
