"""Has the input moved, and did the intervention work."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from winback.functions import id_hash, ratio, whole_days
from winback.operators.labels import PERSON
from winback.operators.quantiles import bucket_of, exact_quantiles

PSI_BINS = 10
SMALLEST_SHARE = 1e-4


def bin_counts(frame: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin, people) of a table or a stream; a count per bin, so counts of disjoint rows add up."""
    items = [F.struct(F.lit(name).alias("feature"), bucket_of(F.col(name), cuts).alias("bin")) for name, cuts in edges.items()]
    return frame.select(F.inline(F.array(*items))).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("people"))


@dataclass(frozen=True)
class DriftBaseline:
    """What later tables are compared with: per feature the inner edges of its bins and the people in each.

    The bins are the baseline's own quantiles; quantiles that coincide merge their bins.
    """

    edges: dict[str, list[float]]
    people: dict[tuple[str, int], int]

    @classmethod
    def of(cls, frame: DataFrame, columns: Sequence[str], bins: int = PSI_BINS) -> DriftBaseline:
        found = exact_quantiles(frame, columns, [i / bins for i in range(1, bins)])
        edges = {
            name: sorted({round(value, 9) for (_, feature, _), value in found.items() if feature == name})
            for name in columns
        }
        # a row per bin
        counted = bin_counts(frame, edges).collect()
        return cls(edges, {(row["feature"], row["bin"]): row["people"] for row in counted})

    def table(self, spark: SparkSession) -> DataFrame:
        """(feature, bin, upper_edge, people) of every bin, empty ones too; the last has no edge. To be stored."""
        rows = [
            (name, at, cuts[at] if at < len(cuts) else None, self.people.get((name, at), 0))
            for name, cuts in self.edges.items()
            for at in range(len(cuts) + 1)
        ]
        return spark.createDataFrame(rows, "feature string, bin int, upper_edge double, people bigint")

    @classmethod
    def from_table(cls, stored: DataFrame) -> DriftBaseline:
        rows = sorted(tuple(row) for row in stored.select("feature", "bin", "upper_edge", "people").collect())
        edges: dict[str, list[float]] = {}
        for name, _, edge, _ in rows:
            edges.setdefault(name, []).extend([] if edge is None else [edge])
        return cls(edges, {(name, at): people for name, at, _, people in rows})

    def psi(self, counts: DataFrame) -> DataFrame:
        """(feature, psi): population stability index of :func:`bin_counts` against the baseline.

        A bin without rows counts as a very small share.
        """
        old = self.table(counts.sparkSession).withColumnRenamed("people", "old")
        # a row per bin on both sides
        both = old.join(F.broadcast(counts.withColumnRenamed("people", "new")), ["feature", "bin"], "left")
        totals = W.partitionBy("feature")

        def share(count: str) -> Column:
            part = ratio(F.coalesce(count, F.lit(0)), F.sum(count).over(totals))
            return F.greatest(F.coalesce(part, F.lit(0.0)), F.lit(SMALLEST_SHARE))

        shares = both.withColumns({"p": share("old"), "q": share("new")})
        moved = F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p")))
        return shares.groupBy("feature").agg(moved.alias("psi"))


def feature_drift_psi(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """(feature, psi) of one table against another."""
    known = DriftBaseline.of(baseline, columns, bins)
    return known.psi(bin_counts(current, known.edges))


def delivery_rows(orders: DataFrame) -> DataFrame:
    """(order_id, order_purchase_timestamp, delivery_days) of orders with both dates."""
    days = whole_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return orders.select("order_id", "order_purchase_timestamp", days.alias("delivery_days")).filter(
        F.col("delivery_days").isNotNull()
    )


def delivery_windows(orders: DataFrame, width: str = "30 days") -> DataFrame:
    """(window_start, deliveries, mean_delivery_days, over_average) per tumbling window of the purchase date.

    ``over_average`` is the window's mean over the mean of all deliveries; a sudden rise shows there.
    """
    windows = (
        delivery_rows(orders)
        .groupBy(F.window("order_purchase_timestamp", width).alias("span"))
        .agg(F.count(F.lit(1)).alias("deliveries"), F.sum("delivery_days").alias("days"))
    )
    # from the windows, not from the orders: both read the same shuffle
    overall = windows.agg(ratio(F.sum("days"), F.sum("deliveries"))).scalar()
    return windows.select(
        F.col("span.start").alias("window_start"),
        "deliveries",
        ratio(F.col("days"), F.col("deliveries")).alias("mean_delivery_days"),
    ).withColumn("over_average", F.try_divide(F.col("mean_delivery_days"), overall))


def with_arm(people: DataFrame, experiment: str, treated_share: float = 0.5, id_column: str = PERSON) -> DataFrame:
    """Assign 'treatment' or 'control' by a hash of experiment name and id; repeatable."""
    limit = math.floor(treated_share * 2**32)
    return people.withColumn(
        "arm", F.when(id_hash(F.col(id_column), experiment) < limit, "treatment").otherwise("control")
    )


def ab_uplift(people: DataFrame, converted: str = "converted") -> DataFrame:
    """One row: people and conversion rate per arm, their difference and its z-score."""

    def rows(arm: str, condition: Column | None = None) -> Column:
        inside = F.col("arm") == arm
        return F.count(F.when(inside if condition is None else inside & condition, 1)).cast("double")

    hit = F.col(converted) == 1
    totals = people.agg(
        rows("treatment").alias("n_t"),
        rows("control").alias("n_c"),
        rows("treatment", hit).alias("k_t"),
        rows("control", hit).alias("k_c"),
    )
    rate_t, rate_c = F.try_divide("k_t", "n_t"), F.try_divide("k_c", "n_c")
    pooled = F.try_divide(F.col("k_t") + F.col("k_c"), F.col("n_t") + F.col("n_c"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n_t") + F.try_divide(F.lit(1.0), "n_c")))
    return totals.select(
        F.col("n_t").cast("bigint").alias("treated"),
        F.col("n_c").cast("bigint").alias("controls"),
        rate_t.alias("treatment_rate"),
        rate_c.alias("control_rate"),
        (rate_t - rate_c).alias("uplift"),
        F.try_divide(rate_t - rate_c, error).alias("z_score"),
    )
