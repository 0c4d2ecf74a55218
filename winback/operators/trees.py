"""Decision trees as DataFrame work: the exact best split, and boosting by gradients and curvatures.

``best_splits`` looks at every distinct value of every feature. Rows collapse to class counts per value, running totals give
both sides of every cut, so nothing but counts is shuffled and no feature is sorted in one task.

``NewtonBooster`` grows trees level by level. One grouped pass per level sums gradients and curvatures per (node, feature,
bin), of two siblings only over the lighter one; the driver sees at most ``2^level x features x bins`` sums and picks the
splits. A leaf is worth -G / (H + penalty). The sums are whole numbers (fixed point, scaled to the total weight), so they do not depend on the order in which rows are
added: the same rows give the same trees, however they are divided.
"""

from __future__ import annotations

import json
import math
import sys
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.operators.prepare import TARGET, ClassWeights
from winback.operators.reuse import checkpointed
from winback.operators.running import running_totals, with_neighbours

#: rounds of boosting between two stored states
STORE_EVERY = 3
#: rows that one task sums in a pass
ROWS_PER_PART = 50_000
NO_SPLIT = 2**31 - 1


def _impurity(positive: Column, negative: Column) -> Column:
    """Gini impurity times weight."""
    return F.try_divide(2 * positive * negative, positive + negative)


def best_splits(rows: DataFrame, features: Sequence[str], weights: ClassWeights, target: str = TARGET) -> DataFrame:
    """(feature, threshold, gain, left_weight, right_weight): the cut of each feature with the largest Gini gain.

    Classes are weighted to the same total. A threshold lies midway between two neighbouring values; rows up to it go left.
    Of equal gains the smallest threshold counts. Features with one value only have no row.
    """
    items = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value")) for name in features])
    tall = rows.select(F.inline(items), F.col(target).alias("label")).filter(F.col("value").isNotNull())
    counts = tall.groupBy("feature", "value").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("positives"), F.count(F.when(F.col("label") == 0, 1)).alias("negatives")
    )
    counts = checkpointed(counts)
    passed = running_totals(with_neighbours(counts, "value", ["value"], by="feature"), "value", ["positives", "negatives"], by="feature")
    up, down = (weights.total / (2 * count) if count else 1.0 for count in (weights.positives, weights.negatives))
    # whole counts until here, so that both engines and all layouts round alike
    left_p, left_n = (F.col(f"{name}_before") * F.lit(weight) for name, weight in (("positives", up), ("negatives", down)))
    totals = F.broadcast(
        counts.groupBy("feature").agg(F.sum("positives").alias("all_positives"), F.sum("negatives").alias("all_negatives"))
    )
    right_p, right_n = (
        (F.col(f"all_{name}") - F.col(f"{name}_before")) * F.lit(weight) for name, weight in (("positives", up), ("negatives", down))
    )
    whole = left_p + left_n + right_p + right_n
    none = F.lit(0.0)
    parted = F.coalesce(_impurity(left_p, left_n), none) + F.coalesce(_impurity(right_p, right_n), none)
    gain = (_impurity(left_p + right_p, left_n + right_n) - parted) / whole
    cuts = passed.join(totals, "feature").filter(F.col("previous_value").isNotNull()).select(
        "feature",
        ((F.col("previous_value") + F.col("value")) / 2).alias("threshold"),
        gain.alias("gain"),
        (left_p + left_n).alias("left_weight"),
        (right_p + right_n).alias("right_weight"),
    )
    best = F.max_by(F.struct("threshold", "gain", "left_weight", "right_weight"), F.struct("gain", -F.col("threshold")))
    return cuts.groupBy("feature").agg(best.alias("best")).select("feature", "best.*")


# --- boosting ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """A complete tree: nodes are numbered 1, 2-3, 4-7, ...; a node without a split sends all rows left."""

    features: list[int]
    cuts: list[int]
    leaves: list[float]

    def told(self) -> dict:
        return {"features": [at + 1 for at in self.features], "cuts": self.cuts, "leaves": self.leaves}


def _child(node: Column, bins: Column, features: Column, cuts: Column) -> Column:
    right = F.element_at(bins, F.element_at(features, node)) > F.element_at(cuts, node)
    return node * 2 + right.cast("int")


def _descended(state: DataFrame, features: list[int], cuts: list[int], levels: int) -> DataFrame:
    """Add ``node``, where each row is after so many levels of a tree that has been split that far."""
    state = state.withColumn("node", F.lit(1))
    for level in range(levels):
        known = 2 ** (level + 1) - 1
        step = _child(F.col("node"), F.col("bins"), F.lit([at + 1 for at in features[:known]]), F.lit(cuts[:known]))
        state = state.withColumn("node", step)
    return state


@dataclass(frozen=True)
class NewtonModel:
    """Trees over binned features; ``cuts`` holds the upper ends of each feature's bins."""

    base: float
    cuts: list[list[float]]
    trees: list[Tree]
    depth: int

    def margin(self, bins: Column) -> Column:
        kind = "array<struct<features:array<int>,cuts:array<int>,leaves:array<double>>>"
        trees = F.from_json(F.lit(json.dumps([tree.told() for tree in self.trees])), kind)
        levels = F.sequence(F.lit(1), F.lit(self.depth))

        def worth(tree: Column) -> Column:
            leaf = F.aggregate(levels, F.lit(1), lambda node, _: _child(node, bins, tree["features"], tree["cuts"]))
            return F.element_at(tree["leaves"], leaf - 2**self.depth + 1)

        return F.aggregate(trees, F.lit(self.base), lambda total, tree: total + worth(tree))

    def transform(self, frame: DataFrame) -> DataFrame:
        """Add ``probability`` (of both classes) and ``prediction`` to rows with a ``features`` vector."""
        binned = binned_features(frame, self.cuts) if self.trees else frame
        margin = self.margin(F.col("bins")) if self.trees else F.lit(self.base)
        scored = binned.withColumn("__p", 1 / (1 + F.exp(-margin)))
        return scored.withColumns(
            {"probability": array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))), "prediction": (F.col("__p") > 0.5).cast("double")}
        ).drop("__p", "bins")


def binned_features(frame: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``bins``: for each entry of ``features`` how many of its cuts lie below it."""
    values = vector_to_array("features")
    wide = frame.withColumns({f"__x{at}": values[at] for at in range(len(cuts))})
    # a bin takes its upper end, Bucketizer its lower one; it wants one cut at least
    ends = [[float(np.nextafter(cut, math.inf)) for cut in mine] or [sys.float_info.max] for mine in cuts]
    splits = [[-math.inf, *mine, math.inf] for mine in ends]
    inputs, outputs = [f"__x{at}" for at in range(len(cuts))], [f"__b{at}" for at in range(len(cuts))]
    placed = Bucketizer(splitsArray=splits, inputCols=inputs, outputCols=outputs).transform(wide)
    return placed.withColumn("bins", F.array(*[F.col(name).cast("int") for name in outputs])).drop(*inputs, *outputs)


@dataclass(frozen=True)
class NewtonBooster:
    """Boosted trees on log loss with second-order splits and leaves.

    ``penalty`` is added to every curvature sum, ``least_curvature`` is the least of it on both sides of a split, ``bins`` the most
    cuts of a feature plus one; a feature with fewer values is cut at every value.
    """

    weight_column: str
    rounds: int = 100
    depth: int = 5
    rate: float = 0.05
    penalty: float = 1.0
    least_curvature: float = 1.0
    bins: int = 256
    base: float = 0.0

    def cuts(self, rows: DataFrame, count: int) -> list[list[float]]:
        """Up to ``bins - 1`` values of each feature that part its rows about evenly."""
        values = vector_to_array("features")
        probs = [at / self.bins for at in range(1, self.bins)]
        asked = [F.percentile_approx(values[at], probs, 20 * self.bins).alias(f"c{at}") for at in range(count)]
        row = rows.agg(*asked, *[F.max(values[at]).alias(f"m{at}") for at in range(count)]).first()
        return [sorted({value for value in row[f"c{at}"] or [] if value < row[f"m{at}"]}) for at in range(count)]

    def fit(self, rows: DataFrame) -> NewtonModel:
        """``rows`` have a ``features`` vector, a ``label`` and the weight column."""
        first = rows.select(F.size(vector_to_array("features")).alias("size")).first()
        if first is None:
            return NewtonModel(self.base, [], [], self.depth)
        count = first["size"]
        cuts = self.cuts(rows, count)
        start = binned_features(rows, cuts).select("bins", "label", F.col(self.weight_column).alias("weight"), F.lit(self.base).alias("margin"))
        totals = start.agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weight")).first()
        # so few parts that each pass is worth its tasks; a single one needs no shuffle
        state = checkpointed(start.repartition(-(-totals["rows"] // ROWS_PER_PART)))
        # sums stay below 2^61
        scale = 2.0 ** (60 - math.ceil(math.log2((totals["weight"] or 0.0) + 1)))
        trees: list[Tree] = []
        for number in range(self.rounds):
            tree = self._grown(state, scale, count)
            trees.append(tree)
            leaf = F.element_at(F.lit(tree.leaves), F.col("node") - 2**self.depth + 1)
            state = _descended(state, tree.features, tree.cuts, self.depth).withColumn("margin", F.col("margin") + leaf).drop("node")
            if (number + 1) % STORE_EVERY == 0 and number + 1 < self.rounds:
                state = checkpointed(state)
        return NewtonModel(self.base, cuts, trees, self.depth)

    def _grown(self, state: DataFrame, scale: float, count: int) -> Tree:
        chance = 1 / (1 + F.exp(-F.col("margin")))
        moved = state.withColumn("p", chance).select(
            "bins",
            F.round(F.col("weight") * (F.col("p") - F.col("label")) * scale).cast("bigint").alias("g"),
            F.round(F.col("weight") * F.col("p") * (1 - F.col("p")) * scale).cast("bigint").alias("h"),
        )
        moved = moved.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._split(moved, scale, count)
        finally:
            moved.unpersist()

    def _sums(self, placed: DataFrame, count: int) -> dict[int, np.ndarray]:
        """Per node whole sums by (feature, bin, gradient or curvature)."""
        tall = placed.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
        found = tall.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        per_node: dict[int, np.ndarray] = defaultdict(lambda: np.zeros((count, self.bins, 2), dtype=np.int64))
        for node, feature, bin_, g, h in found:
            per_node[node][feature, bin_] = g, h
        return per_node

    def _split(self, moved: DataFrame, scale: float, count: int) -> Tree:
        features, cuts = [0] * (2**self.depth - 1), [NO_SPLIT] * (2**self.depth - 1)
        sums: dict[int, tuple[float, float]] = {}
        parents: dict[int, np.ndarray] = {}
        lighter = [1]
        for level in range(self.depth):
            placed = _descended(moved, features, cuts, level)
            # of two siblings the lighter is summed, the other one is the rest of their parent
            per_node = self._sums(placed.filter(F.array_contains(F.lit(lighter), F.col("node"))) if level else placed, count)
            for node in lighter if level else []:
                per_node[node ^ 1] = parents[node // 2] - per_node[node]
            lighter = []
            for node in sorted(per_node):
                histogram = per_node[node] / scale
                split = self._best(histogram)
                g, h = histogram[0].sum(axis=0)
                sums[node] = (g, h)
                if split is not None:
                    feature, cut, left = split
                    features[node - 1], cuts[node - 1] = feature, cut
                    sums[2 * node], sums[2 * node + 1] = left, (g - left[0], h - left[1])
                    lighter.append(2 * node if left[1] <= h - left[1] else 2 * node + 1)
            if not lighter:
                break
            parents = per_node
        leaves = []
        for leaf in range(2**self.depth, 2 ** (self.depth + 1)):
            node = leaf
            while node not in sums:
                node //= 2
            g, h = sums[node]
            leaves.append(float(-self.rate * g / (h + self.penalty)) if h + self.penalty else 0.0)
        return Tree(features, cuts, leaves)

    def _best(self, histogram: np.ndarray) -> tuple[int, int, tuple[float, float]] | None:
        """(feature, last bin on the left, (G, H) on the left) of the largest gain; None without one."""
        left = np.cumsum(histogram, axis=1)[:, :-1]
        whole = histogram[0].sum(axis=0)
        right = whole - left

        def worth(sums: np.ndarray) -> np.ndarray:
            return sums[..., 0] ** 2 / np.maximum(sums[..., 1] + self.penalty, 1e-300)

        gain = worth(left) + worth(right) - worth(whole)
        gain[(left[..., 1] < self.least_curvature) | (right[..., 1] < self.least_curvature)] = -np.inf
        if not gain.size or gain.max() <= 1e-9:
            return None
        # of gains that differ by rounding alone the first feature's first cut counts
        feature, cut = np.unravel_index(np.argmax(gain >= gain.max() * (1 - 1e-9)), gain.shape)
        return int(feature), int(cut), (float(left[feature, cut, 0]), float(left[feature, cut, 1]))
