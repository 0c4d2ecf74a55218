"""Predictions of several models side by side, and what they are worth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.functions import ratio
from winback.operators.labels import PERSON
from winback.operators.prepare import TARGET
from winback.operators.reuse import checkpointed
from winback.operators.running import running_totals, with_neighbours

CUTOFF = 0.5


def churn_probability(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """The frame with ``churn_probability`` and ``churn_predicted``; ids and raw columns stay on their rows.

    A model that gives no probabilities scores 0 everywhere but keeps its own predictions.
    """
    scored = model.transform(frame)
    has_probability = "probability" in scored.columns
    probability = vector_to_array("probability")[1] if has_probability else F.lit(0.0)
    return scored.withColumns(
        {"churn_probability": probability, "churn_predicted": F.col("prediction").cast("int")}
    ).drop("features", "rawPrediction", "probability", "prediction")


def hard_prediction(probability: Column) -> Column:
    return (probability > CUTOFF).cast("int")


def stack_predictions(models: Mapping[str, PipelineModel], frame: DataFrame, target: str = TARGET) -> DataFrame:
    """(model, person, is_churn, probability, predicted) for every model and row, from one reading of the frame."""
    scored, stacked = frame, []
    for at, (name, model) in enumerate(models.items()):
        columns = {"churn_probability": f"__probability_{at}", "churn_predicted": f"__predicted_{at}"}
        scored = churn_probability(model, scored).withColumnsRenamed(columns)
        stacked.append(
            F.struct(
                F.lit(name).alias("model"),
                F.col(f"__probability_{at}").alias("probability"),
                F.col(f"__predicted_{at}").alias("predicted"),
            )
        )
    rows = scored.select(PERSON, F.col(target).alias(TARGET), F.inline(F.array(*stacked)))
    return rows.select("model", PERSON, TARGET, "probability", "predicted")


def score_counts(predictions: DataFrame) -> DataFrame:
    """(model, probability, pos, neg, flagged_pos, flagged_neg): rows of each class per distinct score.

    Everything below is read off this table, so the rows are scored and shuffled once however
    many figures are asked for, and a score shared by many rows is one row.
    """
    churned, stayed = F.col(TARGET) == 1, F.col(TARGET) == 0
    flagged = F.col("predicted") == 1 if "predicted" in predictions.columns else F.col("probability") > CUTOFF
    return (
        predictions.filter(F.col("probability").isNotNull())
        .groupBy("model", "probability")
        .agg(
            F.count(F.when(churned, 1)).alias("pos"),
            F.count(F.when(stayed, 1)).alias("neg"),
            F.count(F.when(churned & flagged, 1)).alias("flagged_pos"),
            F.count(F.when(stayed & flagged, 1)).alias("flagged_neg"),
        )
    )


def _areas(counts: DataFrame) -> DataFrame:
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    curve = running_totals(counts, "probability", ["neg"], by="model")
    return curve.groupBy("model").agg(F.try_divide(F.sum(won), pairs).alias("roc_auc"))


def roc_auc(predictions: DataFrame) -> DataFrame:
    """(model, roc_auc): exact, ties count half; null when a class is missing."""
    return _areas(checkpointed(score_counts(predictions)))


def _threshold_metrics(counts: DataFrame) -> DataFrame:
    """(model, recall, precision, f1, accuracy) of the hard predictions; undefined ratios are 0."""

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    names = ["pos", "neg", "flagged_pos", "flagged_neg"]
    churned, stayed, hits, false_alarms = (F.col(name) for name in names)
    return counts.groupBy("model").agg(*[F.sum(name).alias(name) for name in names]).select(
        "model",
        share(hits, churned).alias("recall"),
        share(hits, hits + false_alarms).alias("precision"),
        share(2 * hits, hits + false_alarms + churned).alias("f1"),
        ratio(hits + stayed - false_alarms, churned + stayed).alias("accuracy"),
    )


def _comparison(counts: DataFrame) -> DataFrame:
    return (
        _threshold_metrics(counts)
        .join(_areas(counts), "model")
        .select(
            F.col("model").alias("Model"),
            F.col("roc_auc").alias("ROC-AUC"),
            F.col("recall").alias("Recall"),
            F.col("precision").alias("Precision"),
            F.col("f1").alias("F1-Score"),
            F.col("accuracy").alias("Accuracy"),
        )
        .orderBy(F.desc("Recall"), "Model")
    )


def evaluate_predictions(predictions: DataFrame) -> DataFrame:
    """Model comparison, best recall first."""
    return _comparison(checkpointed(score_counts(predictions)))


def evaluate_models(models: Mapping[str, PipelineModel], test: DataFrame, target: str = TARGET) -> DataFrame:
    """Compare fitted models on the test part."""
    return evaluate_predictions(stack_predictions(models, test, target))


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """(model, actual, predicted, people), always with all four cells per model."""
    cells = [(actual, predicted) for actual in (0, 1) for predicted in (0, 1)]
    counted = predictions.groupBy("model").agg(
        *[F.count(F.when((F.col(TARGET) == a) & (F.col("predicted") == p), 1)).alias(f"cell_{a}{p}") for a, p in cells]
    )
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"cell_{a}{p}").alias("people"))
        for a, p in cells
    ]
    return counted.select("model", F.inline(F.array(*rows)))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """(model, actual, predicted_0, predicted_1): rows are the truth, columns the prediction."""

    def cell(predicted: int) -> Column:
        return F.sum(F.when(F.col("predicted") == predicted, F.col("people"))).alias(f"predicted_{predicted}")

    return confusion_counts(predictions).groupBy("model", "actual").agg(cell(0), cell(1))


def _points(counts: DataFrame, inner: bool = False) -> DataFrame:
    # one row per model compared
    totals = F.broadcast(counts.groupBy("model").agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")))
    summed = running_totals(counts, "probability", ["pos", "neg"], by="model")
    if not inner:
        # a point between two equal steps lies on the line of its neighbours
        stepped = with_neighbours(summed, "probability", ["pos", "neg"], by="model")
        same = (F.col("previous_pos") == F.col("pos")) & (F.col("previous_neg") == F.col("neg"))
        summed = stepped.filter(~F.coalesce(same & F.col("next_pos").isNotNull(), F.lit(False)))
    points = summed.join(totals, "model").select(
        "model",
        F.col("probability").alias("threshold"),
        ratio(F.col("negatives") - F.col("neg_before"), F.col("negatives")).alias("fpr"),
        ratio(F.col("positives") - F.col("pos_before"), F.col("positives")).alias("tpr"),
    )
    start = totals.select(
        "model", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def _stepped(counts: DataFrame, score_steps: int | None) -> DataFrame:
    """Scores rounded up to a number of steps, which bounds the points of a chart."""
    if not score_steps:
        return counts
    step = F.ceil(F.col("probability") * score_steps) / F.lit(float(score_steps))
    return counts.groupBy("model", step.alias("probability")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def roc_points(predictions: DataFrame, score_steps: int | None = None, inner: bool = False) -> DataFrame:
    """(model, threshold, fpr, tpr): a point per distinct score, after a start at (0, 0).

    A point counts rows scored at or above its threshold. Points in the middle of a line, between two steps of the same
    size, are left out unless ``inner`` asks for them; the first and last stay.
    """
    return _points(checkpointed(_stepped(score_counts(predictions), score_steps)), inner)


def roc_chart(predictions: DataFrame, score_steps: int | None = None) -> DataFrame:
    """(series, fpr, tpr) of every model, the series named with its exact area, plus the diagonal."""
    counts = checkpointed(score_counts(predictions))
    named = _areas(counts).select(
        "model", F.concat("model", F.lit(" (AUC = "), F.format_number("roc_auc", 2), F.lit(")")).alias("series")
    )
    # one row per model compared
    curves = _points(checkpointed(_stepped(counts, score_steps))).join(F.broadcast(named), "model")
    diagonal = predictions.sparkSession.createDataFrame(
        [("chance", 0.0, 0.0), ("chance", 1.0, 1.0)], "series string, fpr double, tpr double"
    )
    return curves.select("series", "fpr", "tpr").unionByName(diagonal)
