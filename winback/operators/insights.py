"""Churn rates by what happened to people: delays, reviews, spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.operators.quantiles import bucket_of, exact_quantiles


def _churn_rate(groups: DataFrame, *keys: str) -> DataFrame:
    return groups.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("people"),
        F.sum("is_churn").alias("churned"),
        F.avg("is_churn").alias("churn_rate"),
    )


def _days_beyond_average(features: DataFrame) -> Column:
    average = features.agg(F.avg("avg_delivery_days")).scalar()
    return F.round(F.col("avg_delivery_days") - average, 6)


def churn_by_delay(features: DataFrame, step: float = 3.0) -> DataFrame:
    """Churn per band of delivery days beyond the average."""
    beyond = F.col("beyond")
    band = (
        F.when(beyond > step, "late by more than the step")
        .when(beyond > 0, "late within the step")
        .when(beyond >= -step, "early within the step")
        .otherwise("early by more than the step")
    )
    banded = features.withColumn("beyond", _days_beyond_average(features)).withColumn("delay_band", band)
    return _churn_rate(banded, "delay_band")


def churn_by_review(features: DataFrame) -> DataFrame:
    """Churn per rounded review score of people who left one (filled-in scores would blur it)."""
    reviewed = features.filter(F.col("has_review") == 1)
    return _churn_rate(reviewed.withColumn("stars", F.round("avg_review_score").cast("int")), "stars")


def churn_by_spend_service(features: DataFrame) -> DataFrame:
    """Churn per spend quartile (1 lowest), for people served later than average and the others."""
    found = exact_quantiles(features, ["monetary_value"], [0.25, 0.5, 0.75])
    edges = [round(found[key], 9) for key in sorted(found)]
    grouped = features.withColumn("spend_quartile", 1 + bucket_of(F.col("monetary_value"), edges)).withColumn(
        "late", (_days_beyond_average(features) > 0).cast("int")
    )
    return _churn_rate(grouped, "spend_quartile", "late")
