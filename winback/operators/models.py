"""Three class-weighted classifiers on the scaled features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.operators.features import FEATURES
from winback.operators.labels import PERSON
from winback.operators.prepare import SCALED, SEED, TARGET, ClassWeights
from winback.operators.trees import NewtonBooster
from winback.session import ensure_checkpoint_dir

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
BOOSTED = "Boosted Trees"
# Chosen by name for its recall and its readable coefficients, not by comparing metrics.
CHAMPION = LOGISTIC

BALANCED_WEIGHT, POSITIVE_WEIGHT = "balanced_weight", "positive_weight"
MODELS = (LOGISTIC, FOREST, BOOSTED)
# Bagging of the forest follows the layout of the rows, so it is fixed: parts by person, sorted inside, about so many rows each.
ROWS_PER_PART = 50_000


def logistic_regression(weight_sum: float, strength: float = 1.0) -> LogisticRegression:
    """L2-penalised regression.

    Spark divides the weighted loss by the sum of weights and then adds the penalty, so a
    penalty of ``1 / strength`` on the summed loss is ``1 / (strength * weight_sum)`` here.
    The features arrive scaled; scaling them again would change what is penalised.
    """
    return LogisticRegression(
        labelCol="label",
        weightCol=BALANCED_WEIGHT,
        regParam=1.0 / (strength * weight_sum),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        tol=1e-9,
    )


def random_forest(seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label",
        weightCol=BALANCED_WEIGHT,
        numTrees=100,
        maxDepth=8,
        maxBins=128,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )


def boosted_trees() -> NewtonBooster:
    """Second-order boosting on log loss."""
    return NewtonBooster(POSITIVE_WEIGHT, rounds=100, depth=5, rate=0.05)


def baseline_estimators(weights: ClassWeights) -> dict[str, Estimator | NewtonBooster]:
    return {
        LOGISTIC: logistic_regression(weights.total),
        FOREST: random_forest(),
        BOOSTED: boosted_trees(),
    }


def checked_names(names: Sequence[str] | None, champion_name: str | None = None) -> tuple[list[str], str]:
    """The models to train and the champion among them; a ValueError for names nobody has.

    Without a name the champion is the default one, or the only model that is trained.
    """
    chosen = list(names or MODELS)
    unknown = [name for name in [*chosen, *filter(None, [champion_name])] if name not in MODELS]
    if unknown:
        raise ValueError(f"no such model: {', '.join(unknown)}; there are {', '.join(MODELS)}")
    best = champion_name or (CHAMPION if CHAMPION in chosen else chosen[0] if len(chosen) == 1 else None)
    if best not in chosen:
        raise ValueError(f"the champion must be one of the models that are trained: {', '.join(chosen)}")
    return chosen, best


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[SCALED + name for name in features], outputCol="features")


def _weighted(train: DataFrame, features: Sequence[str], target: str, weights: ClassWeights) -> DataFrame:
    """features, label and both weights, and what rows are dealt by: the person, or the features where there is none."""
    order = [PERSON] if PERSON in train.columns else [SCALED + name for name in features]
    return _assembler(features).transform(train).select(
        "features",
        F.col(target).cast("double").alias("label"),
        weights.balanced(target).alias(BALANCED_WEIGHT),
        weights.positive_only(target).alias(POSITIVE_WEIGHT),
        F.struct(*order, target).alias("order"),
    )


def train_baseline_models(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    names: Sequence[str] | None = None,
    rows_per_part: int = ROWS_PER_PART,
    estimators: Callable[[ClassWeights], Mapping[str, Estimator | NewtonBooster]] | None = None,
) -> dict[str, PipelineModel]:
    """Fit the named models (all three by default) on a frame with scaled features.

    The forest depends on ``rows_per_part``, and no model on how the input was divided or ordered. ``estimators`` replaces
    :func:`baseline_estimators`.
    """
    chosen, _ = checked_names(names, champion_name=(names or MODELS)[0])
    ensure_checkpoint_dir(train.sparkSession)
    weights = ClassWeights.fit(train, target)
    made = (estimators or baseline_estimators)(weights)
    rows = _weighted(train, features, target, weights).persist(StorageLevel.MEMORY_AND_DISK)
    parts = max(1, -(-weights.total // rows_per_part))
    try:
        fitted = {}
        for name in chosen:
            layout = rows
            if name == FOREST:
                layout = rows.repartition(parts, "order").sortWithinPartitions("order")
            fitted[name] = PipelineModel([_assembler(features), made[name].fit(layout.drop("order"))])
        return fitted
    finally:
        rows.unpersist()


def single_split(
    train: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, bins: int = 20_000
) -> tuple[str, float] | None:
    """(feature, threshold) of one unbagged tree of depth 1 that sees all features, else grown as the forest's trees are.

    Exact while a feature has fewer than ``bins`` values. None if no split helps.
    """
    weights = ClassWeights.fit(train, target)
    stump = random_forest().setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy("all").setMaxDepth(1)
    tree = stump.setMaxBins(min(bins, weights.total + 1)).fit(_weighted(train, features, target, weights)).trees[0]
    if tree.depth == 0:
        return None
    split = tree._call_java("rootNode").split()
    return features[split.featureIndex()], split.threshold()


def get_model_coefficients(model: PipelineModel, feature_names: Sequence[str] = FEATURES) -> DataFrame:
    """(Feature, Coefficient, Abs_Impact), strongest first; only for a linear model."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not hasattr(fitted, "coefficients"):
        raise ValueError("coefficients exist only for a linear model")
    rows = [(name, float(value)) for name, value in zip(feature_names, fitted.coefficients.toArray(), strict=True)]
    spark = SparkSession.active()
    return (
        spark.createDataFrame(rows, "Feature string, Coefficient double")
        .withColumn("Abs_Impact", F.abs("Coefficient"))
        .orderBy(F.desc("Abs_Impact"), "Feature")
    )
