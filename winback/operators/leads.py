"""People to contact."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from winback.functions import risk_tier, tier_action, tier_strategy
from winback.operators.evaluate import churn_probability
from winback.operators.labels import PERSON
from winback.operators.reuse import checkpointed

DEFAULT_THRESHOLD = 0.75
# Business columns shown when the frame has them.
DISPLAY_COLUMNS = [
    "churn_probability",
    "frequency",
    "monetary_value",
    "avg_delivery_days",
    "avg_review_score",
    "tenure_days",
]


def high_risk(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Rows strictly above the threshold, as far as display columns exist, in no order."""
    shown = [name for name in [PERSON, *DISPLAY_COLUMNS] if name in scored.columns]
    return scored.filter(F.col("churn_probability") > threshold).select(shown)


def ranked(leads: DataFrame) -> DataFrame:
    """Most likely to leave first; equal scores in the order of the person id."""
    return leads.orderBy(F.desc("churn_probability"), PERSON)


def with_position(leads: DataFrame) -> DataFrame:
    """:func:`ranked` with ``position`` (from 1) in front.

    The list is sorted in ranges once and stored; a row's place in its range follows from its number, and each range starts
    after the rows of those before it. No task sees more than its range.
    """
    # a row number holds the range in its upper bits and the place inside it in the lower 33
    numbered = checkpointed(ranked(leads).withColumn("__number", F.monotonically_increasing_id()))
    part, place = F.shiftright("__number", 33), F.col("__number").bitwiseAND(F.lit(2**33 - 1))
    sizes = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # one row per range
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    placed = numbered.join(F.broadcast(starts), part == F.col("part"))
    return placed.select((F.col("start") + place + 1).alias("position"), *leads.columns)


def top_leads(leads: DataFrame, n: int = 10) -> DataFrame:
    return ranked(leads).limit(n)


def generate_leads(model: PipelineModel, frame: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Score a frame that has raw and scaled features and list the people above the threshold."""
    return ranked(high_risk(churn_probability(model, frame), threshold))


def with_risk_tier(scored: DataFrame) -> DataFrame:
    """Add tier, strategy and action per person."""
    return (
        scored.withColumn("risk_tier", risk_tier(F.col("churn_probability")))
        .withColumn("strategy", tier_strategy(F.col("risk_tier")))
        .withColumn("action", tier_action(F.col("risk_tier")))
    )


def tier_counts(scored: DataFrame) -> DataFrame:
    """People and mean probability per tier."""
    return with_risk_tier(scored).groupBy("risk_tier", "strategy", "action").agg(
        F.count(F.lit(1)).alias("people"),
        F.avg("churn_probability").alias("mean_probability"),
    )
