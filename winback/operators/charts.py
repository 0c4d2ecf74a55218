"""The tables behind the charts."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.functions import impact_direction
from winback.operators.evaluate import confusion_matrix, roc_chart, stack_predictions
from winback.operators.prepare import TARGET

HISTOGRAM_BINS = 50
DENSITY_POINTS = 200
DENSITY_BINS = 2048
THRESHOLD_MARK = 0.75


def probability_stats(scored: DataFrame, column: str = "churn_probability") -> DataFrame:
    return scored.agg(
        F.count(column).alias("people"),
        F.max(column).alias("max_probability"),
        F.avg(column).alias("mean_probability"),
    )


@dataclass(frozen=True)
class Spread:
    """Number of scores, their range and sample deviation."""

    n: int
    low: float
    high: float
    deviation: float

    @classmethod
    def of(cls, scored: DataFrame, column: str) -> Spread:
        row = scored.agg(
            F.count(column).alias("n"),
            F.min(column).alias("low"),
            F.max(column).alias("high"),
            F.stddev_samp(column).alias("deviation"),
        ).first()
        return cls(row["n"], row["low"] or 0.0, row["high"] or 0.0, row["deviation"] or 0.0)

    @property
    def width(self) -> float:
        return self.high - self.low


def _binned(scored: DataFrame, column: str, spread: Spread, bins: int) -> DataFrame:
    """Non-empty equal-width bins: (bin, people, mean_value); the last bin includes the maximum.

    All scores go to bin 0 when they are equal.
    """
    if spread.width:
        position = F.floor((F.col(column) - F.lit(spread.low)) / F.lit(spread.width) * bins)
    else:
        position = F.lit(0)
    return (
        scored.filter(F.col(column).isNotNull())
        .groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("people"), F.avg(column).alias("mean_value"))
    )


def _histogram(scored: DataFrame, column: str, spread: Spread, bins: int) -> DataFrame:
    counts = _binned(scored, column, spread, bins)
    edge = F.lit(spread.width / bins)
    # at most one row per bin
    every_bin = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(spread.low) + F.col("bin") * edge).alias("bin_start"),
        (F.lit(spread.low) + (F.col("bin") + 1) * edge).alias("bin_end"),
        F.coalesce("people", F.lit(0).cast("bigint")).alias("people"),
    )


def probability_histogram(
    scored: DataFrame, column: str = "churn_probability", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """(bin, bin_start, bin_end, people) for every bin between minimum and maximum, empty ones too."""
    return _histogram(scored, column, Spread.of(scored, column), bins)


def _density(scored: DataFrame, column: str, spread: Spread, points: int, fine_bins: int, bins: int) -> DataFrame:
    bandwidth = spread.deviation * max(spread.n, 1) ** -0.2
    if not bandwidth:
        return scored.sparkSession.createDataFrame([], "point int, x double, density double, curve double")
    z = (F.col("x") - F.col("mean_value")) / F.lit(bandwidth)
    return (
        _binned(scored, column, spread, fine_bins)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.lit(spread.low) + F.col("point") * F.lit(spread.width) / (points - 1))
        .groupBy("point", "x")
        .agg(F.sum(F.col("people") * F.exp(z * z * -0.5)).alias("height"))
        .select(
            "point",
            "x",
            (F.col("height") / F.lit(spread.n * bandwidth * math.sqrt(2 * math.pi))).alias("density"),
            (F.col("height") * F.lit(spread.width / bins / (bandwidth * math.sqrt(2 * math.pi)))).alias("curve"),
        )
    )


def probability_density(
    scored: DataFrame,
    column: str = "churn_probability",
    points: int = DENSITY_POINTS,
    fine_bins: int = DENSITY_BINS,
    histogram_bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """(point, x, density, curve): Gaussian density over the range of the scores.

    Bandwidth is Scott's rule on the sample deviation. The rows are first counted in fine bins
    and each bin stands at its mean, so the work is ``points x fine_bins`` at most, whatever
    the number of rows. ``curve`` is the density in units of the histogram's counts. Empty when
    all scores are equal.
    """
    return _density(scored, column, Spread.of(scored, column), points, fine_bins, histogram_bins)


def probability_chart(scored: DataFrame, column: str = "churn_probability") -> DataFrame:
    """Histogram, density curve and threshold mark as one table: (series, x, y)."""
    spread = Spread.of(scored, column)
    bars = _histogram(scored, column, spread, HISTOGRAM_BINS).select(
        F.lit("histogram").alias("series"), F.col("bin_start").alias("x"), F.col("people").cast("double").alias("y")
    )
    curve = _density(scored, column, spread, DENSITY_POINTS, DENSITY_BINS, HISTOGRAM_BINS).select(
        F.lit("density").alias("series"), "x", F.col("curve").alias("y")
    )
    mark = scored.sparkSession.createDataFrame(
        [("threshold", THRESHOLD_MARK, None)], "series string, x double, y double"
    )
    return bars.unionByName(curve).unionByName(mark)


def confusion_matrix_table(y: DataFrame, actual: str = TARGET, predicted: str = "predicted") -> DataFrame:
    """One confusion matrix from a frame with both columns: (actual, predicted_0, predicted_1)."""
    named = y.select(
        F.lit("model").alias("model"), F.col(actual).alias(TARGET), F.col(predicted).cast("int").alias("predicted")
    )
    return confusion_matrix(named).drop("model")


def roc_curve_table(models: Mapping[str, PipelineModel], test: DataFrame, score_steps: int | None = None) -> DataFrame:
    """ROC chart of fitted models on the test part; a model that gives no probabilities has no curve."""
    drawn = {name: model for name, model in models.items() if "probability" in model.transform(test.limit(0)).columns}
    return roc_chart(stack_predictions(drawn, test), score_steps)


def coefficient_chart(coefficients: DataFrame, top_n: int = 15) -> DataFrame:
    """The strongest coefficients with the side of the chart they belong to."""
    return (
        coefficients.orderBy(F.desc("Abs_Impact"), "Feature")
        .limit(top_n)
        .withColumn("direction", impact_direction(F.col("Coefficient")))
    )


def top_risk_factors(coefficients: DataFrame, n: int = 5) -> DataFrame:
    """The strongest coefficients that raise the risk."""
    return coefficients.filter(F.col("Coefficient") > 0).orderBy(F.desc("Abs_Impact"), "Feature").limit(n)
