"""Every query the engine is checked with: name -> function of (session, table folder).

Results carry rounded doubles, because sums over different partitions differ in the last
bits; rows come in no particular order. Queries on scores use a fixed linear model, so that
they can be checked exactly without training.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.functions import known_number, logistic, safe_timestamp, whole_days
from winback.operators import charts, evaluate, features, insights, labels, leads, models, monitor, prepare, trees
from winback.operators.labels import PERSON
from winback.operators.reuse import checkpointed
from winback.plans.churn_run import run_churn
from winback.session import ensure_checkpoint_dir
from winback.sources import csv_rejects, load_and_clean_data, load_warehouse, warehouse_orders, write_leads
from winback.streaming.deliveries import replay_delivery_windows
from winback.streaming.drift import replay_drift
from winback.streaming.scoring import replay_scoring

FIXED_WEIGHTS = {
    "frequency": -0.8,
    "avg_delivery_days": 0.3,
    "monetary_value": -0.2,
    "avg_installments": 0.1,
    "avg_review_score": -0.4,
    "has_review": -0.5,
}
FIXED_INTERCEPT = 0.2
SECOND_WEIGHTS = {"frequency": -0.5}
SECOND_INTERCEPT = 0.0
LEAD_THRESHOLD = 0.60
BASELINE_DATE = dt.datetime(1998, 1, 1)

PLACES = {"monetary_value": 4}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double: spend to 4 places, the rest as asked."""
    doubles = [field.name for field in df.schema if field.dataType.simpleString() == "double"]
    return df.withColumns({name: F.round(name, PLACES.get(name, places)) for name in doubles})


# --- sources ------------------------------------------------------------------------------


def customers_scan(spark: SparkSession, folder: str) -> DataFrame:
    return load_warehouse(spark, folder).customers


def payments_scan(spark: SparkSession, folder: str) -> DataFrame:
    return load_warehouse(spark, folder).payments


def reviews_scan(spark: SparkSession, folder: str) -> DataFrame:
    return load_warehouse(spark, folder).reviews


def delivered_orders(spark: SparkSession, folder: str) -> DataFrame:
    start, end = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return load_warehouse(spark, folder).orders.withColumn("delivery_days", whole_days(start, end))


def safe_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates and numbers as text, some of them broken, read back without an error."""
    key = F.col("order_id")
    written = F.col("order_purchase_timestamp").cast("string")
    text = (
        F.when(key % 5 == 0, "not a date")
        .when(key % 11 == 0, "1997-13-45 00:00:00")
        .when(key % 13 == 0, "")
        .when(key % 17 == 0, "2018")
        .when(key % 19 == 0, F.concat(written, F.lit("+03:00")))
        .otherwise(written)
    )
    number = (
        F.when(key % 3 == 0, "1.5d").when(key % 7 == 0, " 2.5 ").when(key % 11 == 0, "1e3").when(key % 13 == 0, "0x1f").otherwise(key.cast("string"))
    )
    return warehouse_orders(spark, folder).select(key, safe_timestamp(text).alias("purchased_at"), known_number(number).alias("number"))


# --- labels and features ------------------------------------------------------------------


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_warehouse(spark, folder)
    return labels.generate_churn_labels(tables.orders, tables.customers)


def churn_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder)


def churn_rate_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(labels.churn_rate_report(_labels(spark, folder)))


def logistics_features(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_warehouse(spark, folder)
    return rounded(features.logistics_features(tables.orders, tables.customers))


def monetary_features(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_warehouse(spark, folder)
    return rounded(features.monetary_features(tables.payments, tables.orders, tables.customers))


def review_features(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_warehouse(spark, folder)
    return rounded(features.review_features(tables.reviews, tables.orders, tables.customers))


def order_ledger(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_warehouse(spark, folder)
    return rounded(features.order_ledger(tables.payments, tables.reviews))


def state_delivery_means(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_warehouse(spark, folder)
    return rounded(features.state_delivery_means(features.logistics_features(tables.orders, tables.customers)))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return features.build_features(load_warehouse(spark, folder))


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_features(spark, folder))


def customer_features_joined_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The same table from separately made labels."""
    tables = load_warehouse(spark, folder)
    return rounded(features.build_features(tables, labels.generate_churn_labels(tables.orders, tables.customers)))


def features_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table from orders up to a date, with that date's labels."""
    return rounded(features.build_features(load_warehouse(spark, folder), as_of=BASELINE_DATE))


def _csv_shop(spark: SparkSession, folder: str) -> str:
    """The tables as CSV files: headers, text dates, words for missing values, half of the files with another order of columns."""
    tables = load_warehouse(spark, folder)
    work = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    arrived = F.col("order_delivered_customer_date").cast("string")
    unknown = F.lit(None).cast("string")
    orders = warehouse_orders(spark, folder).withColumns(
        {
            "order_purchase_timestamp": F.col("order_purchase_timestamp").cast("string"),
            "order_delivered_customer_date": F.coalesce(arrived, F.lit("no date")),
            "order_approved_at": unknown,
            "order_delivered_carrier_date": F.lit("NaN"),
            "order_estimated_delivery_date": F.lit("1998-02-30 00:00:00"),
        }
    )
    reviews = tables.reviews.withColumn("review_comment_message", F.lit('first line\nsecond "line", end'))
    files = {"customers": tables.customers, "orders": orders, "order_payments": tables.payments, "order_reviews": reviews}
    for name, table in files.items():
        half = F.col(table.columns[0]) % 2 == 0
        for number, part in enumerate((table.filter(half), table.filter(~half).select(*reversed(table.columns)))):
            part.write.csv(f"{work}/shop{number}_{name}_dataset.csv", header=True, escape='"')
    return work


def features_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table by way of CSV files."""
    built = features.build_features(load_and_clean_data(spark, _csv_shop(spark, folder)))
    return rounded(built.withColumn(PERSON, F.col(PERSON).cast("bigint")))


def _broken_payments(orders: DataFrame, work: str) -> None:
    """A third set of payments, two files of it: some amounts are words, some lines have a field too many."""
    key = F.col("order_id")
    amount = F.when(key % 3 == 0, "x12").when(key % 3 == 1, "12,ab").otherwise("NA")
    # one column, named by the whole header line and with a separator that no line holds: each part gets the header
    line = F.concat_ws(",", key, F.lit("1"), amount).alias("order_id,payment_installments,payment_value")
    for part in range(2):
        path = f"{work}/shop{2 + part}_order_payments_dataset.csv"
        orders.filter(key % 2 == part).select(line).write.csv(path, header=True, sep="\x01")


def csv_reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Cells and lines of the CSV files that could not be read, by table, file and reason."""
    work = _csv_shop(spark, folder)
    _broken_payments(load_warehouse(spark, folder).reviews, work)
    rejects = csv_rejects(spark, work)
    file = F.regexp_extract("file", "([^/]+_dataset[.]csv)", 1)
    return rejects.groupBy("table", file.alias("file"), "reason").agg(F.count(F.lit(1)).alias("rejects"))


# --- preparation --------------------------------------------------------------------------


def repeat_buyers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prepare.repeat_buyers(_features(spark, folder)))


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.row_counts(_features(spark, folder))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.stratified_split(prepare.repeat_buyers(_features(spark, folder)))


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).select(PERSON, "is_churn", "split")


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.split_counts(_split(spark, folder))


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prepare.class_weights(_split(spark, folder).filter(F.col("split") == "train")))


def _model_input(spark: SparkSession, folder: str) -> prepare.ModelInput:
    return prepare.split_and_scale(_features(spark, folder))


def scaler_params(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_model_input(spark, folder).scaler.parameters(spark))


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    ready = _model_input(spark, folder)
    return rounded(ready.frame.select(PERSON, "is_churn", "split", *ready.scaled_columns))


def training_preview(spark: SparkSession, folder: str) -> DataFrame:
    ready = _model_input(spark, folder)
    return rounded(ready.preview(3).select(PERSON, *ready.scaled_columns))


# --- scores of a fixed model --------------------------------------------------------------


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    frame = _model_input(spark, folder).frame
    return frame.withColumns(
        {
            "churn_probability": F.round(logistic(FIXED_WEIGHTS, FIXED_INTERCEPT, prepare.SCALED), 6),
            "second_probability": F.round(logistic(SECOND_WEIGHTS, SECOND_INTERCEPT, prepare.SCALED), 6),
        }
    )


def _scored_test(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).filter(F.col("split") == "test")


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Both fixed models on the test part, stacked."""
    pairs = F.array(
        F.struct(F.lit("fixed").alias("model"), F.col("churn_probability").alias("probability")),
        F.struct(F.lit("frequency only").alias("model"), F.col("second_probability").alias("probability")),
    )
    stacked = _scored_test(spark, folder).select(PERSON, "is_churn", F.inline(pairs))
    return stacked.withColumn("predicted", evaluate.hard_prediction(F.col("probability")))


def scored_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select(PERSON, "split", "is_churn", "churn_probability", "second_probability")


def metrics_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.evaluate_predictions(_predictions(spark, folder)))


def roc_auc_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.roc_auc(_predictions(spark, folder)))


def roc_points_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.roc_points(_predictions(spark, folder)))


def roc_chart_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.roc_chart(_predictions(spark, folder), score_steps=100))


def confusion_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_matrix(_predictions(spark, folder))


def confusion_counts_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_counts(_predictions(spark, folder))


def prob_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(charts.probability_stats(_scored_test(spark, folder)))


def prob_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(charts.probability_histogram(_scored_test(spark, folder)), places=9)


def prob_density(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(charts.probability_density(_scored_test(spark, folder)))


def prob_chart(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(charts.probability_chart(_scored_test(spark, folder)), places=9)


def high_risk_leads(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(leads.high_risk(_scored_test(spark, folder), LEAD_THRESHOLD))


def top10_leads(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(leads.top_leads(leads.high_risk(_scored_test(spark, folder), LEAD_THRESHOLD)))


def exported_leads(spark: SparkSession, folder: str) -> DataFrame:
    """The ranked list with positions, exported and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/leads-{uuid.uuid4().hex}"
    listed = leads.with_position(leads.high_risk(_scored_test(spark, folder), LEAD_THRESHOLD))
    for _ in range(2):  # the second list takes the place of the first
        write_leads(rounded(listed), path, "csv")
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in listed.schema)
    return spark.read.schema(schema).csv(path, header=True)


def ordered_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Names in the order in which the short ordered reports give them."""
    frames = {
        "comparison": (evaluate.evaluate_predictions(_predictions(spark, folder)), "Model"),
        "coefficients": (models.get_model_coefficients(_logistic(spark, folder)[1][models.CHAMPION]), "Feature"),
        "top leads": (leads.top_leads(leads.high_risk(_scored_test(spark, folder), LEAD_THRESHOLD)), PERSON),
    }
    rows = [(report, at, str(row[name])) for report, (frame, name) in frames.items() for at, row in enumerate(frame.collect(), 1)]
    return spark.createDataFrame(rows, "report string, position int, name string")


def risk_tiers(spark: SparkSession, folder: str) -> DataFrame:
    tiered = leads.with_risk_tier(_scored_test(spark, folder))
    return tiered.select(PERSON, "churn_probability", "risk_tier", "strategy", "action")


def risk_tier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(leads.tier_counts(_scored_test(spark, folder)))


# --- trained models (4 places: both engines stop a little short of the optimum) ------------


def _logistic(spark: SparkSession, folder: str) -> tuple[prepare.ModelInput, dict]:
    ready = prepare.split_and_scale(checkpointed(_features(spark, folder)))
    return ready, models.train_baseline_models(ready.train, names=[models.LOGISTIC])


def lr_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    _, fitted = _logistic(spark, folder)
    return rounded(charts.coefficient_chart(models.get_model_coefficients(fitted[models.CHAMPION]), top_n=10), places=4)


def lr_risk_factors(spark: SparkSession, folder: str) -> DataFrame:
    _, fitted = _logistic(spark, folder)
    return rounded(charts.top_risk_factors(models.get_model_coefficients(fitted[models.CHAMPION])), places=4)


def lr_leads(spark: SparkSession, folder: str) -> DataFrame:
    ready, fitted = _logistic(spark, folder)
    return rounded(leads.generate_leads(fitted[models.CHAMPION], ready.test, LEAD_THRESHOLD), places=4)


def lr_metrics(spark: SparkSession, folder: str) -> DataFrame:
    ready, fitted = _logistic(spark, folder)
    return rounded(evaluate.evaluate_models(fitted, ready.test), places=4)


def lr_prob_stats(spark: SparkSession, folder: str) -> DataFrame:
    ready, fitted = _logistic(spark, folder)
    return rounded(charts.probability_stats(evaluate.churn_probability(fitted[models.CHAMPION], ready.test)), places=4)


def churn_run_leads(spark: SparkSession, folder: str) -> DataFrame:
    """The lead list of the whole run, training the champion alone."""
    run = run_churn(load_warehouse(spark, folder), model_names=[models.CHAMPION])
    return rounded(run.leads, places=4)


def tree_stumps(spark: SparkSession, folder: str) -> DataFrame:
    """The exact best cut of every feature, and which of them a single tree of the forest's kind takes."""
    ready = prepare.split_and_scale(checkpointed(_features(spark, folder)))
    cuts = trees.best_splits(ready.train, ready.scaled_columns, prepare.ClassWeights.fit(ready.train))
    feature, threshold = models.single_split(ready.train) or ("", 0.0)
    taken = (F.col("feature") == prepare.SCALED + feature) & (F.abs(F.col("threshold") - threshold) < 1e-9)
    return rounded(cuts.withColumn("taken", taken))


def boosting_first_round(spark: SparkSession, folder: str) -> DataFrame:
    """Split and leaves of the first boosted tree, cut once."""
    ready = prepare.split_and_scale(checkpointed(_features(spark, folder)))
    booster = replace(models.boosted_trees(), rounds=1, depth=1, rate=1.0, bins=4096)
    fitted = models.train_baseline_models(ready.train, names=[models.BOOSTED], estimators=lambda _: {models.BOOSTED: booster})
    fitted = fitted[models.BOOSTED].stages[-1]
    tree = fitted.trees[0]
    feature = tree.features[0]
    row = (features.FEATURES[feature], fitted.cuts[feature][tree.cuts[0]], tree.leaves[0], tree.leaves[1])
    return rounded(spark.createDataFrame([row], "feature string, cut double, left_leaf double, right_leaf double"))


def model_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    """All three models on the test part: whom they scored, and whether each beats chance with probabilities that are some."""
    ready = prepare.split_and_scale(checkpointed(_features(spark, folder)))
    booster = replace(models.boosted_trees(), rounds=10, rate=0.3)
    fitted = models.train_baseline_models(
        ready.train, estimators=lambda weights: {**models.baseline_estimators(weights), models.BOOSTED: booster}
    )
    predictions = checkpointed(evaluate.stack_predictions(fitted, ready.test))
    chance = (F.col("probability") > 0) & (F.col("probability") < 1) & ((F.col("probability") > 0.5).cast("int") == F.col("predicted"))
    counts = predictions.groupBy("model").agg(
        F.count(F.lit(1)).alias("people"), F.sum("is_churn").alias("churned"), F.bool_and(chance).alias("sound")
    )
    return counts.join(evaluate.roc_auc(predictions), "model").select(
        "model", "people", "churned", "sound", (F.col("roc_auc") > 0.55).alias("beats_chance")
    )


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare.split_and_scale(checkpointed(_features(spark, folder)))
    return rounded(evaluate.evaluate_models(models.train_baseline_models(ready.train), ready.test))


# --- insights and monitoring --------------------------------------------------------------


def churn_by_delay(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(insights.churn_by_delay(customer_features(spark, folder)))


def churn_by_review(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(insights.churn_by_review(customer_features(spark, folder)))


def churn_by_spend_service(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(insights.churn_by_spend_service(customer_features(spark, folder)))


def _then_and_now(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The compared features of people at the earlier date and now, from one pass over the shop's tables."""
    columns = [name for name in features.FEATURES if name != "has_review"]
    views = features.people_then_and_now(load_warehouse(spark, folder), BASELINE_DATE)
    then, now = (rounded(features.features_of(people, features.state_summary(people))).select(PERSON, *columns) for people in views)
    return then, now


def feature_drift_psi(spark: SparkSession, folder: str) -> DataFrame:
    then, now = _then_and_now(spark, folder)
    return rounded(monitor.feature_drift_psi(then, now, now.columns[1:]))


def stream_drift_psi(spark: SparkSession, folder: str) -> DataFrame:
    """The same, from a stored baseline and people who arrive in batches."""
    then, now = _then_and_now(spark, folder)
    return rounded(replay_drift(monitor.DriftBaseline.of(then, then.columns[1:]), now))


def delivery_windows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(monitor.delivery_windows(load_warehouse(spark, folder).orders))


def ab_uplift(spark: SparkSession, folder: str) -> DataFrame:
    """Arms among the people at risk; staying active counts as converted."""
    people = _scored(spark, folder).filter(F.col("churn_probability") > 0.5)
    armed = monitor.with_arm(people, "winback").withColumn("converted", 1 - F.col("is_churn"))
    return rounded(monitor.ab_uplift(armed))


# --- streams, replayed from the stored tables ---------------------------------------------


def stream_delivery_windows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(replay_delivery_windows(spark, folder))


def stream_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(replay_scoring(spark, folder, FIXED_WEIGHTS, FIXED_INTERCEPT))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        customers_scan,
        payments_scan,
        reviews_scan,
        delivered_orders,
        safe_timestamps,
        churn_labels,
        churn_rate_report,
        logistics_features,
        monetary_features,
        review_features,
        order_ledger,
        state_delivery_means,
        customer_features,
        customer_features_joined_labels,
        features_as_of,
        features_from_csv,
        csv_reject_counts,
        repeat_buyers,
        row_counts,
        stratified_split,
        split_counts,
        class_weights,
        scaler_params,
        scaled_features,
        training_preview,
        scored_fixed,
        metrics_fixed,
        roc_auc_fixed,
        roc_points_fixed,
        roc_chart_fixed,
        confusion_fixed,
        confusion_counts_fixed,
        prob_stats,
        prob_histogram,
        prob_density,
        prob_chart,
        high_risk_leads,
        top10_leads,
        exported_leads,
        ordered_reports,
        risk_tiers,
        risk_tier_counts,
        lr_coefficients,
        lr_risk_factors,
        lr_leads,
        lr_metrics,
        lr_prob_stats,
        churn_run_leads,
        tree_stumps,
        boosting_first_round,
        model_scorecard,
        model_comparison,
        churn_by_delay,
        churn_by_review,
        churn_by_spend_service,
        feature_drift_psi,
        delivery_windows,
        ab_uplift,
        stream_delivery_windows,
        stream_scoring,
        stream_drift_psi,
    ]
}
