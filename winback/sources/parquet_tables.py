"""Parquet sources: the shop's own tables once converted, and a star-schema warehouse."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.sources.schemas import ShopTables
from winback.sources.shop_csv import SCHEMAS, delivered

# Columns of the star-schema tables that are read.
WAREHOUSE_SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double",
    "events": "event_id bigint",
}


def save_tables(tables: ShopTables, path: str) -> None:
    """Write every loaded table as parquet: one conversion, then splittable and column-pruned scans."""
    for name in tables.found():
        getattr(tables, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_tables(spark: SparkSession, path: str) -> ShopTables:
    """Read tables written by :func:`save_tables`; a missing one is left out."""
    tables: dict[str, DataFrame] = {}
    for name in [*SCHEMAS, "geolocation"]:
        try:
            tables[name] = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if "orders" in tables:
        tables["orders"] = delivered(tables["orders"])
    return ShopTables(**tables)


def warehouse_orders(spark: SparkSession, directory: str, delivered_only: bool = False) -> DataFrame:
    return map_warehouse_orders(read_warehouse(spark, directory, "orders"), delivered_only)


def read_warehouse(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(WAREHOUSE_SCHEMAS[name]).parquet(f"{directory.rstrip('/')}/{name}.parquet")


def map_warehouse_orders(stored: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Orders with a delivery date made from the order date and key.

    ``delivered_only`` filters on the stored status, which the parquet scan can skip by.
    """
    placed, key = F.col("o_orderdate"), F.col("o_orderkey")
    late_hours = (24 + (key * 37) % 600).cast("int")
    if delivered_only:
        stored = stored.filter(F.col("o_orderstatus") == "F")
    return stored.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
        .alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        F.when(key % 7 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(key % 97 == 0, placed - F.make_dt_interval(hours=F.lit(6)))
        .otherwise(placed + F.make_dt_interval(hours=late_hours))
        .alias("order_delivered_customer_date"),
    )


def load_warehouse(spark: SparkSession, directory: str) -> ShopTables:
    """Map the star-schema tables of ``directory`` onto the shop's tables."""
    account = F.col("c_custkey")
    customers = (
        read_warehouse(spark, directory, "customer")
        .join(read_warehouse(spark, directory, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            account.alias("customer_id"),
            F.when(account % 10 == 1, account - 1).otherwise(account).alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"),
        )
    )
    payments = read_warehouse(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )
    reviews = read_warehouse(spark, directory, "events").select(
        F.col("event_id").alias("order_id"),
        (1 + (F.col("event_id") * 7) % 5).alias("review_score"),
    )
    return ShopTables(
        customers=customers,
        orders=warehouse_orders(spark, directory, delivered_only=True),
        payments=payments,
        reviews=reviews,
    )
