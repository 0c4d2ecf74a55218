"""Exact quantiles, interpolated between neighbours, in two passes whatever the size of a group.

The first pass makes a KLL sketch per group and column. Sketches are ordinary binary columns of a small table that can be
stored and merged (:func:`merge_sketches`), so parts of a table may be sketched apart. A sketch gives, for every wanted quantile,
two values that enclose it. The second pass counts the rows below, between and above these brackets and keeps only the
distinct values inside them (about ``6 * rank_error`` of the rows for each quantile), from which the wanted ranks are read off.
No group is sorted in one task, and results do not depend on the sketch: a bracket that misses its rank is widened and
asked again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_GROUPS = 1000
#: items of the largest level of a sketch
SKETCH_SIZE = 4096

#: group, column, probability
Asked = tuple[str, str, float]


class Quantiles(dict):
    """``{(group, column, probability): value}``; ``rows`` holds the number of known values per (group, column)."""

    def __init__(self, rows: dict[tuple[str, str], int]) -> None:
        super().__init__()
        self.rows = rows


def rank_error(size: int) -> float:
    """Share of the rows by which a quantile of a sketch may be off, in 99 of 100 cases."""
    return 2.296 / size**0.9723


def _known(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: str | None = None, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per group (of all rows, ``"all"``): grp, and per column n_<column> and sketch_<column>.

    Nulls and NaN are not counted; rows without a group are left out.
    """
    group = F.col(by).cast("string") if by else F.lit("all")
    values = df.select(group.alias("grp"), *[_known(name).alias(name) for name in columns]).filter(F.col("grp").isNotNull())
    counts = [F.count(name).alias(f"n_{name}") for name in columns]
    sketches = [F.kll_sketch_agg_double(name, F.lit(size)).alias(f"sketch_{name}") for name in columns]
    return values.groupBy("grp").agg(*counts, *sketches)


def merge_sketches(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add up tables of :func:`quantile_sketches` that were made of disjoint rows."""
    counts = [F.sum(f"n_{name}").alias(f"n_{name}") for name in columns]
    sketches = [F.kll_merge_agg_double(f"sketch_{name}").alias(f"sketch_{name}") for name in columns]
    return parts.groupBy("grp").agg(*counts, *sketches)


@dataclass
class Brackets:
    """Disjoint value ranges of one group and column, and the quantiles to be read off each."""

    rows: int
    lows: list[float] = field(default_factory=list)
    highs: list[float] = field(default_factory=list)
    asked: list[list[float]] = field(default_factory=list)

    @classmethod
    def around(cls, rows: int, ranges: list[tuple[float, float, float]]) -> Brackets:
        """``ranges``: low, high and probability; those that meet become one."""
        found = cls(rows)
        for low, high, prob in sorted(ranges):
            if found.highs and low <= found.highs[-1]:
                found.highs[-1] = max(high, found.highs[-1])
                found.asked[-1].append(prob)
            else:
                found.lows.append(low)
                found.highs.append(high)
                found.asked.append([prob])
        return found


def _edges(sketches: DataFrame, columns: Sequence[str], probs: Sequence[float], margin: float) -> list:
    """(grp, feature, rows, edges): edges holds, per probability, a value below and one above by the margin."""
    ranks = F.array(*[F.lit(min(max(prob + shift, 0.0), 1.0)) for prob in probs for shift in (-margin, margin)])
    items = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"n_{name}").alias("rows"),
            # a sketch of nothing cannot be asked
            F.when(F.col(f"n_{name}") > 0, F.kll_sketch_get_quantile_double(f"sketch_{name}", ranks)).alias("edges"),
        )
        for name in columns
    ]
    rows = sketches.limit(MAX_GROUPS + 1).select("grp", F.inline(F.array(*items))).collect()
    if len(rows) > MAX_GROUPS * len(columns):
        raise ValueError(f"exact quantiles are meant for at most {MAX_GROUPS} groups")
    return [row for row in rows if row["rows"]]


def _enclose(found: list, asked: set[Asked] | None, probs: Sequence[float], margin: float) -> dict[tuple[str, str], Brackets]:
    brackets = {}
    for row in found:
        key = (row["grp"], row["feature"])
        ranges = [
            (
                -math.inf if prob - margin <= 0 else row["edges"][2 * at],
                math.inf if prob + margin >= 1 else row["edges"][2 * at + 1],
                float(prob),
            )
            for at, prob in enumerate(probs)
            if asked is None or (*key, float(prob)) in asked
        ]
        if ranges:
            brackets[key] = Brackets.around(row["rows"], ranges)
    return brackets


BRACKET_SCHEMA = "grp string, feature string, lows array<double>, highs array<double>"
WANTED_SCHEMA = "grp string, feature string, segment int, prob double, rank bigint, next_rank bigint, part double"


def _resolve(df: DataFrame, columns: Sequence[str], by: str | None, brackets: dict[tuple[str, str], Brackets]) -> list:
    """Read the wanted ranks off the values inside the brackets, in one pass over the rows; null where a bracket misses one."""
    spark = df.sparkSession
    ranges = spark.createDataFrame([(*key, one.lows, one.highs) for key, one in brackets.items()], BRACKET_SCHEMA)
    wanted = []
    for key, one in brackets.items():
        for index, probs in enumerate(one.asked):
            for prob in probs:
                position = (one.rows - 1) * prob
                rank = math.floor(position)
                wanted.append((*key, 2 * index + 1, prob, rank, min(rank + 1, one.rows - 1), position - rank))

    group = F.col(by).cast("string") if by else F.lit("all")
    items = F.array(*[F.struct(F.lit(name).alias("feature"), _known(name).alias("value")) for name in columns])
    tall = df.select(group.alias("grp"), F.inline(items)).filter(F.col("value").isNotNull())
    # segments alternate: 0 below the first bracket, 1 inside it, 2 between it and the second, ...
    passed = F.size(F.filter("highs", lambda high: high < F.col("value")))
    inside = F.coalesce(F.get("lows", F.col("passed")) <= F.col("value"), F.lit(False))
    placed = (
        tall.join(F.broadcast(ranges), ["grp", "feature"])
        .withColumn("passed", passed)
        .withColumn("inside", inside)
        .select(
            "grp",
            "feature",
            (2 * F.col("passed") + F.col("inside").cast("int")).alias("segment"),
            # rows outside collapse into one entry with a null value
            F.when(F.col("inside"), F.col("value")).alias("value"),
        )
    )
    # the few rows inside brackets are read twice, the table once
    counted = placed.groupBy("grp", "feature", "segment", "value").agg(F.count(F.lit(1)).alias("copies")).persist()
    earlier = W.partitionBy("grp", "feature").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        counted.groupBy("grp", "feature", "segment")
        .agg(F.sum("copies").alias("rows"))
        .select("grp", "feature", "segment", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    )
    upto = W.partitionBy("grp", "feature", "segment").orderBy("value")
    # a few rows per bracket
    ranked = counted.filter(F.col("segment") % 2 == 1).join(F.broadcast(starts), ["grp", "feature", "segment"])
    ranked = ranked.withColumn("upto", F.col("start") + F.sum("copies").over(upto))

    def value_at(rank: str) -> Column:
        reached = (F.col("upto") > F.col(rank)) & (F.col("start") <= F.col(rank))
        return F.min(F.when(reached, F.struct("upto", "value")))["value"]

    asked = F.broadcast(spark.createDataFrame(wanted, WANTED_SCHEMA))
    low, high = F.col("at_rank"), F.col("at_next")
    values = (
        ranked.join(asked, ["grp", "feature", "segment"])
        .groupBy("grp", "feature", "prob", "part")
        .agg(value_at("rank").alias("at_rank"), value_at("next_rank").alias("at_next"))
        .select("grp", "feature", "prob", (low + (high - low) * F.col("part")).alias("value"))
    )
    try:
        return values.collect()
    finally:
        counted.unpersist()


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: str | None = None,
    size: int = SKETCH_SIZE,
    sketches: DataFrame | None = None,
) -> Quantiles:
    """Quantiles with linear interpolation; nulls and NaN are skipped.

    ``group`` is the text of the ``by`` value, or ``"all"``. Columns without a value are absent. ``sketches`` are those of the
    same rows, if they have been made; they spare the first pass.
    """
    known = quantile_sketches(df, columns, by, size) if sketches is None else sketches
    margin = 3 * rank_error(size)
    edges = _edges(known, columns, probs, margin)
    found = Quantiles({(row["grp"], row["feature"]): row["rows"] for row in edges})
    missing: set[Asked] | None = None
    while brackets := _enclose(edges, missing, probs, margin):
        for row in _resolve(df, columns, by, brackets):
            if row["value"] is not None:
                found[row["grp"], row["feature"], row["prob"]] = row["value"]
        missing = {(*key, prob) for key, one in brackets.items() for probs_ in one.asked for prob in probs_} - found.keys()
        if not missing:
            break
        # the sketch's promise did not hold for these; ask again with wider brackets
        margin *= 8
        edges = _edges(known, columns, probs, margin)
    return found


def bucket_of(value: Column, edges: Sequence[float]) -> Column:
    """0 for values up to the first inner edge, one more for each edge passed."""
    steps = [F.when(value > F.lit(float(edge)), 1).otherwise(0) for edge in edges]
    return reduce(lambda a, b: a + b, steps, F.lit(0))
