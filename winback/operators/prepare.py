"""From feature table to model input: repeat buyers, stratified split, robust scaling, weights."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.functions import id_hash, ratio
from winback.operators.features import FEATURES
from winback.operators.labels import PERSON
from winback.operators.quantiles import exact_quantiles

TARGET = "is_churn"
SEED = 42
SCALED = "scaled_"
# ranges below this are rounding noise
NO_SPREAD = 10 * sys.float_info.epsilon


def repeat_buyers(features: DataFrame, min_orders: int = 2) -> DataFrame:
    return features.filter(F.col("frequency") >= min_orders)


def row_counts(features: DataFrame) -> DataFrame:
    """One row: people in total and repeat buyers among them."""
    return features.agg(
        F.count(F.lit(1)).alias("people"),
        F.count(F.when(F.col("frequency") >= 2, 1)).alias("repeat_buyers"),
    )


def stratified_split(
    df: DataFrame,
    target: str = TARGET,
    test_size: float = 0.2,
    seed: int = SEED,
    id_column: str = PERSON,
) -> DataFrame:
    """Add ``split`` ('train' or 'test') with the same test share in every class.

    Rows are ranked by a hash of their id and the lowest share of each class is the test part,
    so the split depends on the data alone: not on row order, partitions or retries. A class of one row is for training.
    """
    hashed = df.withColumn("id_hash", id_hash(F.col(id_column), seed))
    cuts = exact_quantiles(hashed, ["id_hash"], [test_size], by=target)
    cut = F.lit(None).cast("double")
    for (label, _, _), value in cuts.items():
        if cuts.rows[label, "id_hash"] < 2:
            continue
        cut = F.when(F.col(target).cast("string") == label, value).otherwise(cut)
    return hashed.withColumn("split", F.when(F.col("id_hash") <= cut, "test").otherwise("train")).drop("id_hash")


@dataclass(frozen=True)
class RobustScale:
    """Median and interquartile range per feature."""

    medians: dict[str, float]
    ranges: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str] = FEATURES) -> RobustScale:
        found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        known = [name for name in columns if ("all", name, 0.5) in found]
        return cls(
            medians={name: found["all", name, 0.5] for name in known},
            ranges={name: found["all", name, 0.75] - found["all", name, 0.25] for name in known},
        )

    def scale_of(self, name: str) -> float:
        """What a feature is divided by: its range, or 1 for a feature without spread."""
        return self.ranges[name] if self.ranges[name] >= NO_SPREAD else 1.0

    def scaled(self, name: str) -> Column:
        return (F.col(name) - F.lit(self.medians[name])) / F.lit(self.scale_of(name))

    def transform(self, df: DataFrame, prefix: str = SCALED) -> DataFrame:
        """Add a scaled copy of each feature; the raw ones stay for reports."""
        return df.withColumns({prefix + name: self.scaled(name) for name in self.medians})

    def parameters(self, spark: SparkSession) -> DataFrame:
        """(feature, median, iqr, scale)."""
        rows = [(name, self.medians[name], self.ranges[name], self.scale_of(name)) for name in self.medians]
        return spark.createDataFrame(rows, "feature string, median double, iqr double, scale double")


@dataclass(frozen=True)
class ModelInput:
    """Repeat buyers with raw and scaled features, the target and the split they belong to."""

    frame: DataFrame
    scaler: RobustScale
    target: str = TARGET

    @property
    def train(self) -> DataFrame:
        return self.frame.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.frame.filter(F.col("split") == "test")

    @property
    def scaled_columns(self) -> list[str]:
        return [SCALED + name for name in self.scaler.medians]

    def preview(self, rows: int = 3) -> DataFrame:
        """A few training rows, the same ones every time."""
        return self.train.orderBy(PERSON).limit(rows)


def split_and_scale(
    features: DataFrame,
    target_col: str = TARGET,
    test_size: float = 0.2,
    seed: int = SEED,
) -> ModelInput:
    """Keep repeat buyers, split them, and scale with parameters from the training part only."""
    split = stratified_split(repeat_buyers(features), target_col, test_size, seed)
    scaler = RobustScale.fit(split.filter(F.col("split") == "train"))
    return ModelInput(scaler.transform(split), scaler, target_col)


def split_counts(split: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows per split and class."""
    return split.groupBy("split", target).agg(F.count(F.lit(1)).alias("people"))


@dataclass(frozen=True)
class ClassWeights:
    """Counts of both classes in the training part and the weights that follow from them."""

    negatives: int
    positives: int

    @classmethod
    def fit(cls, train: DataFrame, target: str = TARGET) -> ClassWeights:
        row = class_counts(train, target).first()
        return cls(row["negatives"], row["positives"])

    @property
    def total(self) -> int:
        return self.negatives + self.positives

    def balanced(self, target: str = TARGET) -> Column:
        """Both classes weigh the same in total, and all rows together weigh ``total``."""
        return (
            F.when(F.col(target) == 1, self.total / (2 * self.positives) if self.positives else 1.0)
            .otherwise(self.total / (2 * self.negatives) if self.negatives else 1.0)
        )

    def positive_only(self, target: str = TARGET) -> Column:
        """Negatives weigh 1, positives as much as there are negatives per positive."""
        return F.when(F.col(target) == 1, self.negatives / self.positives if self.positives else 1.0).otherwise(1.0)


def class_counts(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.agg(
        F.count(F.when(F.col(target) == 0, 1)).alias("negatives"),
        F.count(F.when(F.col(target) == 1, 1)).alias("positives"),
    )


def class_weights(train: DataFrame, target: str = TARGET) -> DataFrame:
    """(class, people, balanced_weight, scale_pos_weight) from one pass over the rows."""
    counted = class_counts(train, target)
    classes = F.array(
        F.struct(F.lit(0).alias("class"), F.col("negatives").alias("people")),
        F.struct(F.lit(1).alias("class"), F.col("positives").alias("people")),
    )
    return counted.select("negatives", "positives", F.inline(classes)).select(
        "class",
        "people",
        ratio(F.col("negatives") + F.col("positives"), 2 * F.col("people")).alias("balanced_weight"),
        ratio(F.col("negatives"), F.col("positives")).alias("scale_pos_weight"),
    )
