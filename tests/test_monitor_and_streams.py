"""Drift, experiment, insight tables and the two streams."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from conftest import shop_tables
from pyspark.sql import Window
from pyspark.sql import functions as F

from winback import build_features, split_and_scale
from winback.operators import insights, monitor
from winback.operators.features import people_table, people_then_and_now, person_averages, person_rollup, state_summary
from winback.operators.prepare import RobustScale
from winback.sources.snapshots import PublishedTable
from winback.streaming.deliveries import delivery_window_stream, watch_deliveries
from winback.streaming.drift import replay_drift
from winback.streaming.scoring import ScoringModel, ShopStreams, latest_scores, linear_score, score_shop, state_partitions


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def test_psi_of_equal_and_moved_tables(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=2000)
    same = monitor.feature_drift_psi(numbers(spark, base), numbers(spark, base), ["v"]).first()
    assert same["psi"] == pytest.approx(0, abs=1e-12)
    moved = base + 0.5
    got = monitor.feature_drift_psi(numbers(spark, base), numbers(spark, moved), ["v"]).first()["psi"]
    edges = np.quantile(base, np.arange(1, 10) / 10)
    p = np.bincount(np.searchsorted(edges, base), minlength=10) / len(base)
    q = np.maximum(np.bincount(np.searchsorted(edges, moved), minlength=10) / len(base), 1e-4)
    assert got == pytest.approx(((q - p) * np.log(q / p)).sum(), rel=1e-9)


def test_psi_of_a_flat_feature(spark):
    flat = monitor.feature_drift_psi(numbers(spark, [1] * 50), numbers(spark, [1] * 30 + [2] * 10), ["v"]).first()
    p, q = np.array([1.0, 1e-4]), np.array([0.75, 0.25])
    assert flat["psi"] == pytest.approx(((q - p) * np.log(q / p)).sum())


def test_people_then_and_now_equal_two_rollups(spark):
    shop = shop_tables(spark)
    for as_of in (dt.datetime(2018, 1, 1, 10), dt.datetime(2018, 5, 1), dt.datetime(2016, 1, 1), dt.datetime(2030, 1, 1)):
        then, now = people_then_and_now(shop, as_of)
        for got, until in ((then, as_of), (now, None)):
            expected = people_table(shop, until)
            assert sorted(map(str, got.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_a_stored_baseline_and_counts_that_add_up(spark):
    rng = np.random.default_rng(1)
    base, moved = rng.normal(size=(500, 2)), rng.normal(0.4, 1, size=(300, 2))
    frames = [spark.createDataFrame([tuple(map(float, row)) for row in rows], "v double, w double") for rows in (base, moved)]
    baseline = monitor.DriftBaseline.of(frames[0], ["v", "w"])
    again = monitor.DriftBaseline.from_table(baseline.table(spark))
    assert again == baseline
    whole = {row["feature"]: row["psi"] for row in monitor.feature_drift_psi(*frames, ["v", "w"]).collect()}
    parts = [monitor.bin_counts(frames[1].filter(condition), again.edges) for condition in ("v > 0", "v <= 0")]
    added = parts[0].unionByName(parts[1]).groupBy("feature", "bin").agg(F.sum("people").alias("people"))
    assert {row["feature"]: row["psi"] for row in again.psi(added).collect()} == pytest.approx(whole)
    streamed = {row["feature"]: row["psi"] for row in replay_drift(baseline, frames[1], batches=4).collect()}
    assert streamed == pytest.approx(whole)


def test_ab_uplift(spark):
    people = spark.range(1000).select(F.col("id").alias("customer_unique_id"))
    armed = monitor.with_arm(people, "spring")
    assert {tuple(r) for r in armed.collect()} == {tuple(r) for r in monitor.with_arm(people.repartition(7), "spring").collect()}
    treated = armed.filter("arm = 'treatment'").count()
    assert 430 < treated < 570
    rows = [("treatment", 1)] * 30 + [("treatment", 0)] * 70 + [("control", 1)] * 20 + [("control", 0)] * 80
    row = monitor.ab_uplift(spark.createDataFrame(rows, "arm string, converted int")).first()
    assert row["uplift"] == pytest.approx(0.1)
    assert row["z_score"] == pytest.approx(0.1 / math.sqrt(0.25 * 0.75 * 0.02))
    empty = monitor.ab_uplift(spark.createDataFrame([], "arm string, converted int")).first()
    assert empty["treated"] == 0 and empty["uplift"] is None


def test_insights(spark):
    rows = [(f"U{i}", float(i), float(10 * i), 1.0 + i % 5, i % 2, int(i % 3 > 0)) for i in range(20)]
    df = spark.createDataFrame(
        rows,
        "customer_unique_id string, avg_delivery_days double, monetary_value double, avg_review_score double,"
        " is_churn int, has_review int",
    )
    bands = {r["delay_band"]: r["people"] for r in insights.churn_by_delay(df).collect()}
    assert bands == {
        "late by more than the step": 7, "late within the step": 3,
        "early within the step": 3, "early by more than the step": 7,
    }
    stars = insights.churn_by_review(df).collect()
    assert sum(r["people"] for r in stars) == sum(r[5] for r in rows)
    spend = insights.churn_by_spend_service(df).collect()
    assert sorted((r["spend_quartile"], r["late"], r["people"]) for r in spend) == [(1, 0, 5), (2, 0, 5), (3, 1, 5), (4, 1, 5)]


def test_closed_windows_are_appended_once(spark, tmp_path):
    days = [1, 2, 8, 9, 30, 60]
    rows = [(f"o{d}", dt.datetime(2024, 1, 1) + dt.timedelta(days=d), dt.datetime(2024, 1, 1) + dt.timedelta(days=2 * d)) for d in days]
    schema = "order_id string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz"
    incoming, table, progress = (str(tmp_path / name) for name in ("incoming", "table", "progress"))
    spark.createDataFrame(rows[:4], schema).coalesce(1).write.mode("append").parquet(incoming)

    def drain():
        stream = spark.readStream.schema(schema).parquet(incoming)
        windows = delivery_window_stream(stream, "7 days", "3 days")
        watch_deliveries(windows, table, progress, availableNow=True).awaitTermination()

    drain()
    spark.createDataFrame(rows[4:], schema).coalesce(1).write.mode("append").parquet(incoming)
    drain()
    got = [tuple(r) for r in spark.read.parquet(table).orderBy("window_start").collect()]
    starts = [r[0] for r in got]
    assert starts == sorted(set(starts))
    batch = monitor.delivery_windows(spark.read.parquet(incoming), "7 days").orderBy("window_start").collect()
    # all windows but the newest, which the watermark has not passed
    assert got == [tuple(r)[:3] for r in batch][:-1]


WEIGHTS = {"frequency": -0.8, "avg_delivery_days": 0.3}


@pytest.fixture(scope="module")
def scoring(spark):
    shop = shop_tables(spark)
    people = person_averages(person_rollup(shop.orders, shop.customers, shop.payments, shop.reviews))
    scaler = RobustScale({"frequency": 1.0, "avg_delivery_days": 5.0}, {"frequency": 1.0, "avg_delivery_days": 2.0})
    return shop, ScoringModel(state_summary(people), scaler, linear_score(WEIGHTS, 0.1))


def scores(spark, store):
    return {r["customer_unique_id"]: (r["frequency"], r["churn_probability"]) for r in latest_scores(spark, store).collect()}


def expected_scores(shop, model):
    buyers = build_features(shop).filter("frequency >= 2")
    scored = model.add_score(model.scaler.transform(buyers))
    return {r["customer_unique_id"]: (r["frequency"], r["churn_probability"]) for r in scored.collect()}


STREAMED = ["customers", "orders", "payments", "reviews"]


def keyed(shop):
    """The small shop with a column that tells repeats of payments and reviews from others."""
    window = Window.partitionBy("order_id").orderBy(F.col("payment_value").desc_nulls_last())
    payments = shop.payments.withColumn("payment_sequential", F.row_number().over(window))
    reviews = shop.reviews.withColumn("review_id", F.concat("order_id", F.col("review_score").cast("string")))
    return {"customers": shop.customers, "orders": shop.orders, "payments": payments, "reviews": reviews}


def stream_turns(spark, turns, model, tmp_path, lateness=None, merge_every=2):
    """Let rows arrive turn by turn; both queries run after each turn and go on from their checkpoints."""
    store = str(tmp_path / "store")
    for turn in turns:
        for name, rows in turn.items():
            rows.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        incoming = {name: spark.readStream.schema(turns[0][name].schema).parquet(str(tmp_path / name)) for name in STREAMED}
        streams = ShopStreams(**incoming, payment_key="payment_sequential", review_key="review_id")
        for query in score_shop(streams, model, store, lateness, merge_every, availableNow=True):
            query.awaitTermination()
    return store


@pytest.mark.parametrize("lateness", [None, "30 days"])
def test_late_and_repeated_rows_are_counted_once(spark, scoring, tmp_path, lateness):
    shop, model = scoring
    tables = keyed(shop)
    nothing = {name: rows.limit(0) for name, rows in tables.items()}
    # amounts first, then half the orders, then customers and the other half, at last everything again
    half = F.substring("order_id", 2, 2).cast("int") % 2 == 0
    turns = [
        {**nothing, "payments": tables["payments"], "reviews": tables["reviews"].filter(half)},
        {**nothing, "orders": tables["orders"].filter(half)},
        {**nothing, "customers": tables["customers"], "orders": tables["orders"].filter(~half)},
        {**nothing, "reviews": tables["reviews"].filter(~half)},
        tables,
    ]
    store = stream_turns(spark, turns, model, tmp_path, lateness)
    assert scores(spark, store) == expected_scores(shop, model)


def test_amounts_without_their_order_are_not_scored_until_it_comes(spark, scoring, tmp_path):
    shop, model = scoring
    tables = keyed(shop)
    late = F.col("order_id") == "o2"
    turns = [{**tables, "orders": tables["orders"].filter(~late)}, {**tables, "orders": tables["orders"].filter(late)}]
    store = stream_turns(spark, turns[:1], model, tmp_path)
    assert "U1" not in scores(spark, store)
    store = stream_turns(spark, turns, model, tmp_path)
    assert scores(spark, store) == expected_scores(shop, model)


def test_state_lies_on_disk_and_the_session_keeps_its_settings(spark, scoring, tmp_path):
    shop, model = scoring
    tables = keyed(shop)
    store = stream_turns(spark, [tables, tables], model, tmp_path)
    assert scores(spark, store) == expected_scores(shop, model)
    for progress in ("increments-progress", "scores-progress"):
        states = list((tmp_path / "store" / progress / "state").rglob("*"))
        assert [file for file in states if file.suffix == ".changelog"] and not [file for file in states if file.suffix == ".delta"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None


def test_state_is_kept_once_in_few_stores_however_wide_shuffles_are(spark, scoring, tmp_path):
    shop, model = scoring
    tables = keyed(shop)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        store = stream_turns(spark, [tables, tables], model, tmp_path)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64" and state_partitions(spark) == 8
        spark.conf.set("spark.winback.state.partitions", "3")
        assert state_partitions(spark) == 3
    finally:
        spark.conf.unset("spark.winback.state.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert scores(spark, store) == expected_scores(shop, model)
    # three times repeats, the join of orders with customers, the join of amounts with orders; a store for each and partition
    logs = [file for file in (tmp_path / "store/increments-progress/state").rglob("1.changelog")]
    assert sorted({file.relative_to(tmp_path / "store/increments-progress/state").parts[0] for file in logs}) == list("01234")
    assert len(logs) == 5 * 8


def test_bulk_runs_store_state_as_files(spark, scoring, tmp_path):
    shop, model = scoring
    tables = keyed(shop)
    half = F.substring("order_id", 2, 2).cast("int") % 2 == 0
    turns = [{**tables, "orders": tables["orders"].filter(half)}, {**tables, "orders": tables["orders"].filter(~half)}, tables]
    for turn in turns:
        for name, rows in turn.items():
            rows.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        incoming = {name: spark.readStream.schema(tables[name].schema).parquet(str(tmp_path / name)) for name in STREAMED}
        streams = ShopStreams(**incoming, payment_key="payment_sequential", review_key="review_id")
        for query in score_shop(streams, model, str(tmp_path / "store"), None, bulk=True, availableNow=True):
            query.awaitTermination()
    assert scores(spark, str(tmp_path / "store")) == expected_scores(shop, model)
    for progress in ("increments-progress", "scores-progress"):
        states = {file.suffix for file in (tmp_path / "store" / progress / "state").rglob("*") if file.is_file()}
        assert ".zip" in states and ".changelog" not in states
    assert spark.conf.get("spark.sql.streaming.stateStore.unloadOnCommit", None) is None


def test_payments_without_a_key_are_all_counted(spark, scoring, tmp_path):
    shop, model = scoring
    tables = keyed(shop)
    for name in STREAMED:
        tables[name].coalesce(1).write.parquet(str(tmp_path / name))
    incoming = {name: spark.readStream.schema(tables[name].schema).parquet(str(tmp_path / name)) for name in STREAMED}
    twice = {**incoming, "payments": incoming["payments"].unionByName(incoming["payments"])}
    for query in score_shop(ShopStreams(**twice, review_key="review_id"), model, str(tmp_path / "store"), None, availableNow=True):
        query.awaitTermination()
    paid = {r["customer_unique_id"]: r["monetary_value"] for r in latest_scores(spark, str(tmp_path / "store")).collect()}
    known = {r["customer_unique_id"]: 2 * r["monetary_value"] for r in build_features(shop).filter("frequency >= 2").collect()}
    assert paid == pytest.approx(known)


def published(table):
    return sorted(tuple(row) for row in table.read().collect())


def test_readers_see_whole_publications(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "table"), grace_seconds=0)
    assert table.manifest is None
    with pytest.raises(ValueError, match="nothing"):
        table.read()
    table.replace(spark.range(5), 0)
    before = table.read()
    slow = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.replace(slow, 1)
    # the failed attempt is nowhere to be seen, and the batch can be repeated
    assert published(table) == [(n,) for n in range(5)] and before.count() == 5
    table.replace(spark.range(2), 1)
    table.replace(spark.range(9), 1)
    assert published(table) == [(0,), (1,)]
    # superseded folders, also of the failed attempt, are gone after the grace time
    table.replace(spark.range(4), 2)
    assert len(list((tmp_path / "table/data").iterdir())) == 1 and len(list((tmp_path / "table/manifests").glob("*.json"))) == 1


def test_superseded_folders_stay_for_the_grace_time(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "table"), grace_seconds=3600)
    table.replace(spark.range(5), 0)
    held = table.read()
    table.replace(spark.range(2), 1)
    assert held.count() == 5 and table.read().count() == 2


def test_appended_folders_are_merged(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "table"), grace_seconds=0)
    for number in range(7):
        for _ in range(2):
            table.append(spark.range(number, number + 2), number, lambda rows: rows.distinct(), merge_every=3)
        assert len(table.manifest.folders) <= 3
    assert {row["id"] for row in table.read().collect()} == set(range(8))


def test_model_input_of_the_small_shop_is_not_needed_for_scoring(spark, scoring):
    shop, _ = scoring
    assert split_and_scale(build_features(shop)).frame.count() == 2
