"""Running totals over a whole table in the order of a number, without a one-task window.

Rows are cut into value ranges of about equal row count. Totals per range are few and give
each range its starting point; inside a range an ordinary window finishes the job.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_RANGES = 1000


def range_edges(df: DataFrame, column: str, ranges: int) -> list[float]:
    """Strictly increasing cut points that split the rows about evenly."""
    probs = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(column, probs, 10 * ranges).alias("cuts")).first()["cuts"]
    # a Bucketizer wants one cut at least; nothing lies beyond this one
    return [-math.inf, *(sorted({float(cut) for cut in cuts or []}) or [sys.float_info.max]), math.inf]


def with_neighbours(df: DataFrame, order: str, columns: Sequence[str], by: str, ranges: int = DEFAULT_RANGES) -> DataFrame:
    """Add ``previous_<name>`` and ``next_<name>``: the columns of the rows before and after in the order, null at the ends.

    Expects one row per (``by``, ``order``) value, like :func:`running_totals`. The first and last row of a range find
    their neighbours among the edge rows of the other ranges, of which there are few.
    """
    in_ranges = Bucketizer(splits=range_edges(df, order, ranges), inputCol=order, outputCol="range").transform(df)
    held = F.struct(order, *[F.col(name).alias(f"edge_{name}") for name in columns])
    edges = in_ranges.groupBy(by, "range").agg(F.min(held).alias("first"), F.max(held).alias("last"))
    across = W.partitionBy(by).orderBy("range")
    borders = edges.select(by, "range", F.lag("last").over(across).alias("before"), F.lead("first").over(across).alias("after"))
    inside = W.partitionBy(by, "range").orderBy(order)
    added = {}
    for name in columns:
        added[f"previous_{name}"] = F.coalesce(F.lag(name).over(inside), F.when(F.row_number().over(inside) == 1, F.col(f"before.edge_{name}")))
        last = F.lead(F.lit(1)).over(inside).isNull()
        added[f"next_{name}"] = F.coalesce(F.lead(name).over(inside), F.when(last, F.col(f"after.edge_{name}")))
    return in_ranges.join(F.broadcast(borders), [by, "range"]).withColumns(added).drop("range", "before", "after")


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: str,
    ranges: int = DEFAULT_RANGES,
) -> DataFrame:
    """Add ``<name>_before`` for each name in ``totals``: its sum over all smaller ``order`` values.

    Expects one row per (``by``, ``order``) value, so a value that many rows share is one row
    here. ``by`` must have few values (the models compared).
    """
    edges = range_edges(df, order, ranges)
    in_ranges = Bucketizer(splits=edges, inputCol=order, outputCol="range").transform(df)
    earlier_ranges = W.partitionBy(by).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        in_ranges.groupBy(by, "range")
        .agg(*[F.sum(name).alias(name) for name in totals])
        .select(
            by,
            "range",
            *[F.coalesce(F.sum(name).over(earlier_ranges), F.lit(0)).alias(f"{name}_start") for name in totals],
        )
    )
    earlier_here = W.partitionBy(by, "range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    # starts holds at most `ranges` rows per value of `by`
    added = in_ranges.join(F.broadcast(starts), [by, "range"]).withColumns(
        {
            f"{name}_before": F.col(f"{name}_start") + F.coalesce(F.sum(name).over(earlier_here), F.lit(0))
            for name in totals
        }
    )
    return added.drop("range", *[f"{name}_start" for name in totals])
