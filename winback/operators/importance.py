"""What a model looks at: coefficients of a linear one, permutation importance of any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from winback.functions import id_hash
from winback.operators.evaluate import churn_probability, roc_auc
from winback.operators.features import FEATURES
from winback.operators.labels import PERSON
from winback.operators.models import get_model_coefficients
from winback.operators.prepare import SCALED, SEED, TARGET
from winback.operators.reuse import checkpointed

#: rows among which values are exchanged
EXCHANGED_TOGETHER = 10_000
UNCHANGED = ""


def with_exchanged(frame: DataFrame, columns: Sequence[str], seed: int = SEED) -> DataFrame:
    """Add ``other``: the columns of another row, each row's used once.

    Rows are dealt to groups and ordered inside them by hashes of the person, and take from the next row, the last from
    the first; so the exchange depends on the ids alone and no group grows with the table. A row alone keeps its own.
    """
    groups = max(1, frame.count() // EXCHANGED_TOGETHER)
    group = F.pmod(id_hash(F.col(PERSON), f"{seed}:group"), F.lit(groups))
    named = frame.withColumns({"__group": group, "__turn": id_hash(F.col(PERSON), f"{seed}:turn")})
    order = W.partitionBy("__group").orderBy("__turn", PERSON)
    mine = F.struct(*columns)
    following = F.coalesce(F.lead(mine).over(order), F.first(mine).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return named.withColumn("other", following).drop("__group", "__turn")


def permutation_importance(
    model: PipelineModel, frame: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, seed: int = SEED
) -> DataFrame:
    """(Feature, Coefficient, Abs_Impact), strongest first: the loss of ROC-AUC when one feature's values are exchanged between rows.

    ``Coefficient`` carries the sign of the feature's correlation with the score. All variants of a row stand
    side by side, so the frame is read and scored once.
    """
    columns = [SCALED + name for name in features]

    def variant(changed: str):
        values = [F.col(f"other.{name}" if name == SCALED + changed else name).alias(name) for name in columns]
        return F.struct(F.lit(changed).alias("model"), *values)

    exchanged = with_exchanged(frame.select(PERSON, target, *columns), columns, seed)
    variants = F.array(*[variant(name) for name in [UNCHANGED, *features]])
    scored = churn_probability(model, exchanged.select(PERSON, F.col(target).alias(TARGET), F.inline(variants)))
    scored = checkpointed(scored.select("model", TARGET, *columns, F.col("churn_probability").alias("probability")))
    areas = {row["model"]: row["roc_auc"] or 0.0 for row in roc_auc(scored).collect()}
    directions = scored.filter(F.col("model") == UNCHANGED).agg(*[F.corr(name, "probability").alias(name) for name in columns]).first()
    rows = []
    for name in features:
        lost = areas.get(UNCHANGED, 0.0) - areas.get(name, 0.0)
        rows.append((name, -lost if (directions[SCALED + name] or 0.0) < 0 else lost, abs(lost)))
    table = frame.sparkSession.createDataFrame(rows, "Feature string, Coefficient double, Abs_Impact double")
    return table.orderBy(F.desc("Abs_Impact"), "Feature")


def feature_influence(model: PipelineModel, frame: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """(Feature, Coefficient, Abs_Impact): coefficients if the model is linear, else permutation importance on ``frame``."""
    if hasattr(model.stages[-1], "coefficients"):
        return get_model_coefficients(model, features)
    return permutation_importance(model, frame, features)
