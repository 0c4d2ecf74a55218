"""Training, evaluation, leads, charts and the whole run."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import TABLES
from pyspark.sql import functions as F

import winback
from winback import build_features, load_warehouse, run_churn, split_and_scale
from winback.functions import risk_tier
from winback.operators import charts, evaluate, importance, leads, models


@pytest.fixture(scope="module")
def ready(spark):
    ready = split_and_scale(build_features(load_warehouse(spark, "/root/testdata/sf0.01")))
    return ready


@pytest.fixture(scope="module")
def fitted(ready):
    return models.train_baseline_models(ready.train, names=[models.LOGISTIC])


def newton(x, y, w, steps=50):
    """Summed weighted log loss plus half the squared coefficients, intercept free."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - y)) + penalty @ beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_logistic_regression_solves_the_balanced_penalised_problem(ready, fitted):
    rows = np.array([list(row) for row in ready.train.select(*ready.scaled_columns, "is_churn").collect()])
    x, y = rows[:, :-1], rows[:, -1]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta = newton(x, y, w)
    model = fitted[models.LOGISTIC].stages[-1]
    assert np.allclose([model.intercept, *model.coefficients.toArray()], beta, atol=1e-6)


def test_coefficients_find_a_planted_effect(spark):
    rng = np.random.default_rng(9)
    delay, stars = rng.normal(size=3000), rng.normal(size=3000)
    churn = rng.random(3000) < 1 / (1 + np.exp(-(2 * delay - 1 * stars)))
    names = ["avg_delivery_days", "avg_review_score"]
    df = spark.createDataFrame(
        [(float(a), float(b), int(c)) for a, b, c in zip(delay, stars, churn, strict=True)],
        "scaled_avg_delivery_days double, scaled_avg_review_score double, is_churn int",
    )
    model = models.train_baseline_models(df, features=names, names=[models.LOGISTIC])[models.LOGISTIC]
    table = models.get_model_coefficients(model, names)
    assert [row["Feature"] for row in table.collect()] == names
    chart = charts.coefficient_chart(table).collect()
    assert [row["direction"] for row in chart] == ["Increases Churn Risk", "Increases Loyalty"]
    assert [row["Feature"] for row in charts.top_risk_factors(table).collect()] == names[:1]


def test_all_three_models(spark, ready, fitted):
    small = {models.FOREST: models.random_forest().setNumTrees(20), models.BOOSTED: replace(models.boosted_trees(), rounds=5)}
    quick = lambda weights: {**models.baseline_estimators(weights), **small}
    trained = models.train_baseline_models(ready.train, estimators=quick)
    names = [models.FOREST, models.BOOSTED]
    layouts = [ready.train.repartition(7), ready.train.orderBy(F.desc("customer_unique_id")).coalesce(1)]
    again = [models.train_baseline_models(layout, names=names, estimators=quick) for layout in layouts]
    assert list(trained) == [models.LOGISTIC, models.FOREST, models.BOOSTED]
    table = winback.evaluate_models(trained, ready.test)
    assert table.columns == ["Model", "ROC-AUC", "Recall", "Precision", "F1-Score", "Accuracy"]
    rows = table.collect()
    assert [row["Recall"] for row in rows] == sorted((row["Recall"] for row in rows), reverse=True)
    assert all(0.55 < row["ROC-AUC"] < 0.85 for row in rows)
    for name in names:
        # the layout of the training rows must not matter
        first, *others = [
            [row["churn_probability"] for row in winback.churn_probability(run[name], ready.test).orderBy("customer_unique_id").collect()]
            for run in (trained, *again)
        ]
        assert all(first == other for other in others)
    with pytest.raises(ValueError, match="linear"):
        models.get_model_coefficients(trained[models.FOREST])


def test_a_model_without_probabilities_keeps_its_predictions(ready):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import VectorAssembler

    stages = [
        VectorAssembler(inputCols=ready.scaled_columns, outputCol="features"),
        LinearSVC(labelCol="is_churn", maxIter=5),
    ]
    row = winback.evaluate_models({"svc": Pipeline(stages=stages).fit(ready.train)}, ready.test).first()
    assert row["ROC-AUC"] == 0.5 and row["Recall"] > 0.5


def test_estimator_settings():
    from winback.operators.prepare import ClassWeights

    built = models.baseline_estimators(ClassWeights(60, 40))
    assert built[models.LOGISTIC].getRegParam() == pytest.approx(1 / 100)
    assert not built[models.LOGISTIC].getStandardization()
    forest, boosted = built[models.FOREST], built[models.BOOSTED]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 8, 42)
    assert (boosted.rounds, boosted.depth, boosted.rate, boosted.penalty) == (100, 5, 0.05, 1.0)


def test_names_are_checked_before_anything_is_done():
    assert models.checked_names(None) == (list(models.MODELS), models.LOGISTIC)
    assert models.checked_names([models.FOREST]) == ([models.FOREST], models.FOREST)
    for names, best in (([models.FOREST, models.BOOSTED], None), (["Oracle"], None), ([models.FOREST], models.LOGISTIC), (None, "Oracle")):
        with pytest.raises(ValueError, match="model"):
            models.checked_names(names, best)
    with pytest.raises(ValueError, match="model"):
        run_churn(None, model_names=["Oracle"])


def test_exchanged_values_are_a_permutation(spark, monkeypatch):
    monkeypatch.setattr(importance, "EXCHANGED_TOGETHER", 40)
    df = spark.range(200).select(F.col("id").alias("customer_unique_id"), F.col("id").cast("double").alias("v"))
    pairs = {row["v"]: row["other"]["v"] for row in importance.with_exchanged(df, ["v"]).collect()}
    assert sorted(pairs.values()) == sorted(pairs) and sum(a == b for a, b in pairs.items()) < 5
    again = {row["v"]: row["other"]["v"] for row in importance.with_exchanged(df.repartition(7), ["v"]).collect()}
    assert again == pairs
    assert importance.with_exchanged(df.limit(1), ["v"]).first()["other"]["v"] == 0.0


def test_permutation_importance_finds_what_the_model_uses(spark):
    rng = np.random.default_rng(3)
    delay, stars, noise = rng.normal(size=(3, 2000))
    churn = rng.random(2000) < 1 / (1 + np.exp(-(2 * delay - stars)))
    names = ["avg_delivery_days", "avg_review_score", "frequency"]
    rows = [(at, *map(float, values), int(c)) for at, (*values, c) in enumerate(zip(delay, stars, noise, churn, strict=True))]
    df = spark.createDataFrame(rows, "customer_unique_id int, " + ", ".join(f"scaled_{name} double" for name in names) + ", is_churn int")
    quick = lambda weights: {models.BOOSTED: replace(models.boosted_trees(), rounds=8, depth=3, rate=0.3)}
    model = models.train_baseline_models(df, features=names, names=[models.BOOSTED], estimators=quick)[models.BOOSTED]
    found = importance.feature_influence(model, df, names).collect()
    assert [row["Feature"] for row in found] == names
    assert found[0]["Coefficient"] > 0.1 and found[1]["Coefficient"] < -0.03 and found[2]["Abs_Impact"] < 0.02


SCORES = [(1, 0.9), (1, 0.75), (0, 0.75), (1, 0.5), (0, 0.3), (0, 0.1)]


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [("m", i, y, p, int(p > 0.5)) for i, (y, p) in enumerate(SCORES)]
    return spark.createDataFrame(
        rows, "model string, customer_unique_id int, is_churn int, probability double, predicted int"
    )


def test_metrics_of_known_scores(predictions):
    row = evaluate.evaluate_predictions(predictions).first()
    assert row["Recall"] == row["Precision"] == pytest.approx(2 / 3)
    assert row["F1-Score"] == pytest.approx(2 / 3) and row["Accuracy"] == pytest.approx(4 / 6)
    assert row["ROC-AUC"] == pytest.approx(0.8333333333)


def test_metrics_without_positives_or_flags(spark):
    rows = [("m", 0, 0.2, 0), ("m", 0, 0.4, 0)]
    df = spark.createDataFrame(rows, "model string, is_churn int, probability double, predicted int")
    row = evaluate.evaluate_predictions(df).first()
    assert row["ROC-AUC"] is None
    assert (row["Recall"], row["Precision"], row["F1-Score"], row["Accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_confusion_matrix(spark, predictions):
    rows = {(r["actual"], r["predicted"]): r["people"] for r in evaluate.confusion_counts(predictions).collect()}
    assert rows == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    table = charts.confusion_matrix_table(predictions).orderBy("actual").collect()
    assert [tuple(row) for row in table] == [(0, 2, 1), (1, 1, 2)]
    one_sided = charts.confusion_matrix_table(predictions.filter("probability > 0.8"))
    assert sorted(tuple(row) for row in one_sided.collect()) == [(0, 0, 0), (1, 0, 1)]


def test_roc_points(predictions):
    third = 1 / 3
    every = [(0, 0), (0, third), (third, 2 * third), (third, 1), (2 * third, 1), (1, 1)]
    # the point between two equal steps to the right is left out
    for inner, expected in ((True, every), (False, [*every[:4], every[5]])):
        points = sorted((row["fpr"], row["tpr"]) for row in evaluate.roc_points(predictions, inner=inner).collect())
        assert np.allclose(points, expected)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False))
        assert area == pytest.approx(0.8333333333)


def test_roc_chart(predictions):
    rows = evaluate.roc_chart(predictions).collect()
    assert {row["series"] for row in rows} == {"m (AUC = 0.83)", "chance"}
    assert [(r["fpr"], r["tpr"]) for r in rows if r["series"] == "chance"] == [(0, 0), (1, 1)]
    assert evaluate.roc_chart(predictions, score_steps=2).filter("series != 'chance'").count() == 3


def test_area_of_many_scores_matches_pair_counting(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 800), np.round(rng.random(800), 2)
    df = spark.createDataFrame(
        [("m", int(a), float(b)) for a, b in zip(y, p, strict=True)], "model string, is_churn int, probability double"
    )
    pos, neg = p[y == 1][:, None], p[y == 0][None, :]
    expected = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(expected, abs=1e-12)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(f"U{i}", p, 2 + i, 10.0) for i, (_, p) in enumerate(SCORES)]
    return spark.createDataFrame(
        rows, "customer_unique_id string, churn_probability double, frequency int, monetary_value double"
    )


def test_leads(scored):
    assert [row["customer_unique_id"] for row in leads.high_risk(scored).collect()] == ["U0"]
    listed = leads.ranked(leads.high_risk(scored, 0.3))
    assert listed.columns == ["customer_unique_id", "churn_probability", "frequency", "monetary_value"]
    assert [row["customer_unique_id"] for row in listed.collect()] == ["U0", "U1", "U2", "U3"]
    assert [row["customer_unique_id"] for row in leads.top_leads(listed, 2).collect()] == ["U0", "U1"]


def test_tiers(spark, scored):
    counts = {row["risk_tier"]: row["people"] for row in leads.tier_counts(scored).collect()}
    assert counts == {"Critical": 1, "At Risk": 3, "Safe": 2}
    assert spark.range(1).select(risk_tier(F.lit(None).cast("double"))).first()[0] is None


def test_generated_leads(ready, fitted):
    rows = winback.generate_leads(fitted[models.LOGISTIC], ready.test, 0.6).collect()
    scores = [row["churn_probability"] for row in rows]
    assert scores and min(scores) > 0.6 and max(scores) <= 1 and scores == sorted(scores, reverse=True)


def test_histogram_matches_numpy(spark):
    values = [0, 0.1, 0.1, 0.35, 0.5, 0.99, 1]
    df = spark.createDataFrame([(float(v),) for v in values], "churn_probability double")
    rows = charts.probability_histogram(df, bins=4).orderBy("bin").collect()
    assert [row["people"] for row in rows] == [3, 1, 1, 2]
    rng = np.random.default_rng(2)
    many = rng.random(1000)
    df = spark.createDataFrame([(float(v),) for v in many], "churn_probability double")
    counts, edges = np.histogram(many, bins=50)
    rows = charts.probability_histogram(df).orderBy("bin").collect()
    assert [row["people"] for row in rows] == counts.tolist()
    assert np.allclose([row["bin_start"] for row in rows], edges[:-1])


def test_equal_and_absent_scores(spark):
    df = spark.createDataFrame([(0.5,)] * 3, "churn_probability double")
    rows = charts.probability_histogram(df, bins=4).collect()
    assert {row["bin"]: row["people"] for row in rows} == {0: 3, 1: 0, 2: 0, 3: 0}
    assert charts.probability_density(df).count() == 0
    assert charts.probability_stats(df.limit(0)).first()["people"] == 0
    assert sum(row["people"] for row in charts.probability_histogram(df.limit(0)).collect()) == 0


def test_density_matches_a_kernel_on_the_rows(spark):
    rng = np.random.default_rng(8)
    values = rng.beta(2, 3, 2000)
    df = spark.createDataFrame([(float(v),) for v in values], "churn_probability double")
    rows = charts.probability_density(df).orderBy("point").collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    exact = np.exp(-0.5 * ((grid[:, None] - values) / width) ** 2).sum(1) / (len(values) * width * math.sqrt(2 * math.pi))
    assert np.allclose([row["x"] for row in rows], grid)
    assert np.allclose([row["density"] for row in rows], exact, rtol=1e-4)
    step = (values.max() - values.min()) / 50
    assert np.allclose([row["curve"] for row in rows], exact * len(values) * step, rtol=1e-4)


def test_probability_chart(scored):
    series = {row["series"]: row["n"] for row in charts.probability_chart(scored).groupBy("series").agg(F.count("*").alias("n")).collect()}
    assert series == {"histogram": 50, "density": 200, "threshold": 1}


def test_whole_run(spark, tmp_path):
    run = run_churn(
        load_warehouse(spark, TABLES), model_names=[models.LOGISTIC], leads_path=str(tmp_path / "leads")
    )
    assert run.churn_report.first()["people"] == 131
    assert run.counts.first()["repeat_buyers"] == 112
    assert run.labels.count() == run.features.count() == 131
    assert [row["Model"] for row in run.comparison.collect()] == [models.LOGISTIC]
    assert run.coefficients.count() == run.coefficient_chart.count() == 6
    assert run.top_risk_factors.count() <= 5 and run.top_leads.count() <= 10
    assert run.probability_stats.first()["people"] == run.model_input.test.count()
    assert run.probability_chart.count() == 251
    assert run.roc_chart(100).filter("series = 'chance'").count() == 2
    saved = spark.read.csv(str(tmp_path / "leads"), header=True)
    assert saved.columns[0] == "customer_unique_id" and saved.count() == run.leads.count()


def test_command_line(spark, capsys):
    from winback.__main__ import main

    main([TABLES, "--format", "warehouse", "--models", models.LOGISTIC])
    printed = capsys.readouterr().out
    assert "Top leads" in printed and models.LOGISTIC in printed


def test_whole_run_with_a_forest_alone(spark, tmp_path, monkeypatch):
    original = models.random_forest
    monkeypatch.setattr(models, "random_forest", lambda: original().setNumTrees(10))
    run = run_churn(load_warehouse(spark, TABLES), model_names=[models.FOREST], leads_path=str(tmp_path / "leads"))
    assert [row["Model"] for row in run.comparison.collect()] == [models.FOREST]
    assert run.coefficients.columns == ["Feature", "Coefficient", "Abs_Impact"]
    assert run.coefficients.count() == run.coefficient_chart.count() == 6
    assert spark.read.csv(str(tmp_path / "leads"), header=True).count() == run.leads.count()
    with pytest.raises(ValueError, match="champion"):
        run_churn(load_warehouse(spark, TABLES), model_names=[models.FOREST], champion_name=models.BOOSTED, leads_path=str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
