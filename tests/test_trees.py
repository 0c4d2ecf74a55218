"""Exact splits and second-order boosting against plain loops over the rows."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import TABLES
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from winback import build_features, load_warehouse, split_and_scale
from winback.operators import trees
from winback.operators.prepare import SCALED, ClassWeights
from winback.operators.running import with_neighbours


def test_neighbours_across_ranges(spark):
    rng = np.random.default_rng(1)
    rows = [(m, float(x), int(n)) for m in ("a", "b") for x, n in zip(rng.permutation(200), rng.integers(0, 99, 200), strict=True)]
    df = spark.createDataFrame(rows, "m string, x double, n int")
    for ranges in (2, 9, 1000):
        got = {(r["m"], r["x"]): (r["previous_n"], r["next_n"], r["previous_x"]) for r in with_neighbours(df, "x", ["n", "x"], "m", ranges).collect()}
        assert len(got) == 400
        for model in ("a", "b"):
            mine = sorted(row[1:] for row in rows if row[0] == model)
            for at, (x, _) in enumerate(mine):
                before, after = (mine[at - 1] if at else (None, None)), (mine[at + 1] if at + 1 < len(mine) else (None, None))
                assert got[model, x] == (before[1], after[1], before[0])


def plain_split(x, y, w):
    """Best Gini cut of one feature by trying all."""
    def impurity(part):
        whole = w[part].sum()
        p = w[part & (y == 1)].sum() / whole
        return whole * 2 * p * (1 - p)

    values, everyone = np.unique(x), np.ones(len(x), bool)
    cuts = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    gains = [(impurity(everyone) - impurity(x <= cut) - impurity(x > cut)) / w.sum() for cut in cuts]
    return (cuts[int(np.argmax(gains))], max(gains)) if cuts else None


def test_best_splits_against_all_cuts(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(400, 3)), 1)
    x[:, 2] = 5
    y = (x[:, 0] + rng.normal(size=400) > 0.4).astype(int)
    df = spark.createDataFrame([(*map(float, row), int(label)) for row, label in zip(x, y, strict=True)], "a double, b double, c double, is_churn int")
    weights = ClassWeights.fit(df)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    got = {row["feature"]: row for row in trees.best_splits(df, ["a", "b", "c"], weights).collect()}
    assert got.keys() == {"a", "b"}
    for at, name in enumerate(["a", "b"]):
        cut, gain = plain_split(x[:, at], y, w)
        assert got[name]["threshold"] == pytest.approx(cut) and got[name]["gain"] == pytest.approx(gain)
        assert got[name]["left_weight"] == pytest.approx(w[x[:, at] <= cut].sum())


def plain_booster(x, y, w, rounds, depth, rate, penalty=1.0, least=1.0):
    """Greedy second-order trees over all cuts; returns the margins of the rows."""
    margin = np.zeros(len(y))

    def grow(rows, level):
        g, h = gradient[rows].sum(), curvature[rows].sum()
        best = (1e-9, None)
        if level < depth:
            for feature in range(x.shape[1]):
                for cut in np.unique(x[rows, feature])[:-1]:
                    left = rows & (x[:, feature] <= cut)
                    lg, lh = gradient[left].sum(), curvature[left].sum()
                    if lh < least or h - lh < least:
                        continue
                    gain = lg**2 / (lh + penalty) + (g - lg) ** 2 / (h - lh + penalty) - g**2 / (h + penalty)
                    if gain > best[0] + 1e-12:
                        best = (gain, left)
        if best[1] is None:
            step[rows] = -rate * g / (h + penalty)
            return
        grow(best[1], level + 1)
        grow(rows & ~best[1], level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature, step = w * (p - y), w * p * (1 - p), np.zeros(len(y))
        grow(np.ones(len(y), bool), 0)
        margin += step
    return margin


def frame_of(spark, x, y, w):
    rows = [(at, [float(v) for v in row], float(label), float(weight)) for at, (row, label, weight) in enumerate(zip(x, y, w, strict=True))]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double, weight double")
    return df.select("id", array_to_vector("x").alias("features"), "label", "weight")


@pytest.mark.parametrize("rounds, depth, least", [(3, 2, 1.0), (2, 3, 8.0), (6, 1, 0.0)])
def test_rounds_of_boosting_equal_a_plain_booster(spark, rounds, depth, least):
    rng = np.random.default_rng(rounds)
    x = np.round(rng.normal(size=(150, 3)), 1)
    y = (x[:, 0] * x[:, 1] + rng.normal(size=150) > 0).astype(float)
    w = np.where(y == 1, 1.7, 1.0)
    frame = frame_of(spark, x, y, w)
    booster = trees.NewtonBooster("weight", rounds=rounds, depth=depth, rate=0.3, least_curvature=least)
    model = booster.fit(frame)
    assert len(model.trees) == rounds
    scored = {row["id"]: row for row in model.transform(frame).collect()}
    plain = 1 / (1 + np.exp(-plain_booster(x, y, w, rounds, depth, 0.3, least=least)))
    assert [scored[at]["probability"][1] for at in range(150)] == pytest.approx(list(plain), abs=1e-9)
    assert all(scored[at]["prediction"] == float(plain[at] > 0.5) for at in range(150))


def test_trees_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(300, 4)), rng.integers(0, 2, 300)
    frame = frame_of(spark, x, y, rng.random(300) + 0.5)
    booster = trees.NewtonBooster("weight", rounds=3, depth=3, bins=16)
    models = [booster.fit(layout) for layout in (frame.repartition(7), frame.orderBy(F.desc("id")).coalesce(1))]
    assert models[0] == models[1]
    assert all(len(mine) < 16 for mine in models[0].cuts)


def test_of_two_siblings_only_the_lighter_one_is_summed(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3))
    seen = []

    class Watched(trees.NewtonBooster):
        def _sums(self, placed, count):
            seen.append(placed.count())
            return super()._sums(placed, count)

    model = Watched("weight", rounds=1, depth=3, bins=16).fit(frame_of(spark, x, (x[:, 0] > 0.5).astype(float), [1.0] * 400))
    # equal weights have equal curvatures before the first tree
    assert seen[0] == 400 and len(seen) == 3 and max(seen[1:]) <= 200
    assert model.trees[0].features[0] == 0


def test_boosting_without_anything_to_learn(spark):
    frame = frame_of(spark, [[1.0, 2.0]] * 20, [1] * 20, [1.0] * 20)
    scored = trees.NewtonBooster("weight", rounds=3, depth=2).fit(frame).transform(frame).first()
    assert 0.5 < scored["probability"][1] < 0.6
    empty = frame.limit(0)
    assert trees.NewtonBooster("weight", rounds=3, depth=2).fit(empty).trees == []


def test_spark_s_single_tree_splits_where_the_exact_finder_does(spark):
    from winback.operators.models import single_split

    ready = split_and_scale(build_features(load_warehouse(spark, TABLES)))
    weights = ClassWeights.fit(ready.train)
    found = max(trees.best_splits(ready.train, ready.scaled_columns, weights).collect(), key=lambda row: row["gain"])
    feature, threshold = single_split(ready.train)
    assert (SCALED + feature, threshold) == (found["feature"], pytest.approx(found["threshold"]))
