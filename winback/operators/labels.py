"""Churn labels: how long ago each person last bought."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.functions import moment, whole_days
from winback.operators.joins import join_to_unique
from winback.operators.reuse import checkpointed

PERSON = "customer_unique_id"
DEFAULT_THRESHOLD_DAYS = 280


def orders_until(orders: DataFrame, as_of: dt.datetime | None) -> DataFrame:
    """Orders bought up to ``as_of``; all of them without one."""
    if as_of is None:
        return orders
    return orders.filter(F.col("order_purchase_timestamp") <= moment(as_of))


def churn_flag(recency: Column, threshold_days: int) -> Column:
    """1 when the last order is more than ``threshold_days`` old; unknown recency counts as 0."""
    return F.coalesce((recency > threshold_days).cast("int"), F.lit(0))


def last_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """(person, last_order_date), with one row for orders of known accounts without a person.

    Orders shrink to one row per account before they meet the customers, so an account with a
    large share of the orders costs nothing extra.
    """
    accounts = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.max("order_purchase_timestamp").alias("last_order_date"))
    )
    owners = customers.filter(F.col("customer_id").isNotNull()).select("customer_id", PERSON)
    return (
        join_to_unique(owners, accounts, "customer_id", "inner")
        .groupBy(PERSON)
        .agg(F.max("last_order_date").alias("last_order_date"))
    )


def label_people(people: DataFrame, snapshot: Column, threshold_days: int) -> DataFrame:
    """Add recency and is_churn to rows that have last_order_date."""
    return (
        people.withColumn("snapshot", snapshot)
        .withColumn("recency", whole_days(F.col("last_order_date"), F.col("snapshot")))
        .withColumn("is_churn", churn_flag(F.col("recency"), threshold_days))
        .drop("snapshot")
    )


def generate_churn_labels(
    orders: DataFrame,
    customers: DataFrame,
    threshold_days: int = DEFAULT_THRESHOLD_DAYS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """(customer_unique_id, last_order_date, recency, is_churn) for everyone with an order.

    The snapshot is the newest order of any known account, not today's date.
    """
    people = checkpointed(last_orders(orders_until(orders, as_of), customers))
    snapshot = moment(people.agg(F.max("last_order_date")).first()[0])
    return label_people(people.filter(F.col(PERSON).isNotNull()), snapshot, threshold_days)


def churn_rate_report(labels: DataFrame) -> DataFrame:
    """One row: snapshot date, number of people, share of churned."""
    return labels.agg(
        F.to_date(F.max("last_order_date")).alias("snapshot_date"),
        F.count(F.lit(1)).alias("people"),
        F.avg("is_churn").alias("churn_rate"),
    )
