"""Skew-safe join, exact quantiles, running totals, split, scaling, weights."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import TABLES
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winback import RobustScale, build_features, load_warehouse, split_and_scale
from winback.operators import prepare
from winback.operators.joins import find_hot_keys, join_to_unique
from winback.operators.quantiles import exact_quantiles, merge_sketches, quantile_sketches
from winback.operators.running import running_totals


def test_hot_keys_are_found_and_nulls_noticed(spark):
    rows = [(1,)] * 400 + [(None,)] * 300 + [(key,) for key in range(2, 302)]
    df = spark.createDataFrame(rows, "k bigint")
    spark.conf.set("spark.winback.skew.minRows", "100")
    try:
        hot = find_hot_keys(df, "k")
    finally:
        spark.conf.unset("spark.winback.skew.minRows")
    assert hot.keys == (1,) and hot.nulls
    assert not find_hot_keys(df, "k")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_join_with_hot_keys_equals_the_plain_join(spark, how, kind):
    rng = random.Random(5)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else rng.randrange(50), i) for i in range(900)]
    left = spark.createDataFrame(rows, "k bigint, i int").withColumn("k", F.col("k").cast(kind))
    right = spark.range(0, 40, 2).select(F.col("id").cast(kind).alias("k"), (F.col("id") * 10).alias("v"))
    plain = sorted(map(tuple, left.join(right, "k", how).collect()), key=lambda r: r[1])
    spark.conf.set("spark.winback.skew.minRows", "100")
    try:
        split = join_to_unique(left, right, "k", how)
    finally:
        spark.conf.unset("spark.winback.skew.minRows")
    assert split.columns == ["k", "i", "v"]
    assert sorted(map(tuple, split.collect()), key=lambda r: r[1]) == plain


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(0, 3).map(float)), min_size=1, max_size=60))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.2, 0.25, 0.5, 0.75, 1.0]
    for size in (8, 4096):
        found = exact_quantiles(df, ["v"], probs, size=size)
        for prob in probs:
            assert found["all", "v", prob] == pytest.approx(np.quantile(values, prob), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("size", [8, 40, 4096])
def test_quantiles_by_group_with_a_hot_value(spark, size):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(4000, 1.5), rng.exponential(size=8000)])
    groups = rng.integers(0, 2, values.size)
    df = spark.createDataFrame([(int(g), float(v), None) for g, v in zip(groups, values, strict=True)], "g int, v double, w double")
    probs = [0.1, 0.25, 0.5, 0.99]
    found = exact_quantiles(df, ["v", "w"], probs, by="g", size=size)
    assert len(found) == 8 and found.rows == {(str(group), "v"): int((groups == group).sum()) for group in (0, 1)}
    for group in (0, 1):
        for prob in probs:
            assert found[str(group), "v", prob] == pytest.approx(np.quantile(values[groups == group], prob))


def test_quantiles_take_two_passes(spark):
    """Every row is read once for the sketches and once for the ranks, for all columns and groups together."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rng = np.random.default_rng(8)
    rows = [(int(g), float(v), float(w)) for g, v, w in zip(rng.integers(0, 3, 3000), rng.normal(size=3000), rng.exponential(size=3000), strict=True)]
    df = spark.createDataFrame(rows, "g int, v double, w double").mapInArrow(count, "g int, v double, w double")
    found = exact_quantiles(df, ["v", "w"], [0.25, 0.5, 0.75], by="g")
    assert len(found) == 18 and seen.value == 2 * len(rows)
    assert found["1", "w", 0.75] == pytest.approx(np.quantile([w for g, _, w in rows if g == 1], 0.75))


def test_sketches_of_parts_merge(spark):
    rng = np.random.default_rng(9)
    values = [(float(v), None if v > 1 else float(-v)) for v in rng.normal(size=5000)] + [(float("nan"), None)]
    df = spark.createDataFrame(values, "v double, w double").withColumn("part", F.pmod(F.xxhash64("v"), F.lit(4)))
    parts = [quantile_sketches(df.filter(F.col("part") == at), ["v", "w"]) for at in range(4)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    merged = merge_sketches(stored, ["v", "w"])
    found = exact_quantiles(df, ["v", "w"], [0.1, 0.9], sketches=merged)
    for at, name in enumerate(("v", "w")):
        known = [row[at] for row in values if row[at] is not None and row[at] == row[at]]
        assert found.rows["all", name] == len(known)
        assert [found["all", name, prob] for prob in (0.1, 0.9)] == pytest.approx(list(np.quantile(known, [0.1, 0.9])))


def test_quantiles_of_nothing_and_of_too_many_groups(spark):
    empty = spark.createDataFrame([], "g int, v double")
    assert exact_quantiles(empty, ["v"], [0.5]) == {} and exact_quantiles(empty, ["v"], [0.5], by="g") == {}
    with pytest.raises(ValueError, match="groups"):
        exact_quantiles(spark.range(1200).select("id", F.lit(1.0).alias("v")), ["v"], [0.5], by="id")


def test_running_totals(spark):
    rng = np.random.default_rng(4)
    rows = [(m, float(x), int(n)) for m in ("a", "b") for x, n in zip(rng.permutation(500), rng.integers(0, 9, 500), strict=True)]
    df = spark.createDataFrame(rows, "model string, x double, n bigint")
    got = {(r["model"], r["x"]): r["n_before"] for r in running_totals(df, "x", ["n"], "model", ranges=7).collect()}
    for model in ("a", "b"):
        total = 0
        for _, x, n in sorted(row for row in rows if row[0] == model):
            assert got[model, x] == total
            total += n
    assert len(got) == 1000


def test_scaler_interpolates_and_leaves_a_flat_feature_unscaled(spark):
    df = spark.createDataFrame([(float(v), 2.0) for v in (1, 2, 3, 4)], "a double, b double")
    scaler = RobustScale.fit(df, ["a", "b"])
    assert (scaler.medians, scaler.ranges) == ({"a": 2.5, "b": 2.0}, {"a": 1.5, "b": 0.0})
    assert RobustScale({"a": 1.0}, {"a": 1e-16}).scale_of("a") == 1.0
    scaled = scaler.transform(spark.createDataFrame([(4.0, 9.0)], "a double, b double")).first()
    assert (scaled["scaled_a"], scaled["scaled_b"]) == (1.0, 7.0)


@pytest.fixture(scope="module")
def ready(spark):
    return split_and_scale(build_features(load_warehouse(spark, TABLES)))


def test_split_is_complete_disjoint_and_stratified(ready):
    rows = ready.frame.select("customer_unique_id", "is_churn", "split", "frequency").collect()
    assert len({row[0] for row in rows}) == len(rows) == 112
    assert min(row["frequency"] for row in rows) == 2
    for label in (0, 1):
        part = [row["split"] for row in rows if row["is_churn"] == label]
        assert abs(part.count("test") - 0.2 * len(part)) <= 1
    assert ready.train.count() + ready.test.count() == len(rows)


def test_split_does_not_depend_on_partitions(spark, ready):
    frame = ready.frame.drop("split")
    expected = {tuple(row) for row in ready.frame.select("customer_unique_id", "split").collect()}
    for partitions in (1, 7, 50):
        again = prepare.stratified_split(frame.repartition(partitions))
        assert {tuple(row) for row in again.select("customer_unique_id", "split").collect()} == expected


def test_split_of_one_class(spark):
    df = spark.range(100).select(F.col("id").alias("customer_unique_id"), F.lit(1).alias("is_churn"))
    counts = dict(prepare.stratified_split(df).groupBy("split").count().collect())
    assert counts == {"test": 20, "train": 80}


def test_a_class_of_one_row_is_for_training(spark):
    df = spark.range(50).select(F.col("id").alias("customer_unique_id"), (F.col("id") == 7).cast("int").alias("is_churn"))
    split = prepare.stratified_split(df)
    assert {(row["is_churn"], row["split"]) for row in split.filter("is_churn = 1").collect()} == {(1, "train")}
    assert split.filter("split = 'test'").count() == 10


def test_scaled_training_part_has_median_zero(ready):
    scaled = np.array([list(row) for row in ready.train.select(ready.scaled_columns).collect()])
    assert np.allclose(np.median(scaled, axis=0), 0)
    assert [name.removeprefix("scaled_") for name in ready.scaled_columns] == prepare.FEATURES


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 9, "is_churn int")
    weights = prepare.ClassWeights.fit(df)
    assert (weights.negatives, weights.positives) == (9, 3)
    summed = df.agg(F.sum(weights.balanced()), F.sum(weights.positive_only())).first()
    assert summed[0] == pytest.approx(12) and summed[1] == pytest.approx(18)
    rows = {row["class"]: row for row in prepare.class_weights(df).collect()}
    assert rows[1]["balanced_weight"] == 2.0 and rows[0]["balanced_weight"] == pytest.approx(12 / 18)
    assert rows[0]["scale_pos_weight"] == rows[1]["scale_pos_weight"] == 3.0


def test_preview_is_repeatable(ready):
    ids = [row["customer_unique_id"] for row in ready.preview().collect()]
    assert len(ids) == 3 and ids == sorted(ids) == [row["customer_unique_id"] for row in ready.preview().collect()]


def test_row_counts(spark):
    row = prepare.row_counts(build_features(load_warehouse(spark, TABLES))).first()
    assert (row["people"], row["repeat_buyers"]) == (131, 112)
    assert not math.isnan(row["people"])
