"""Equi-join against a side with one row per key, safe when one key holds a large share of rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# items a task's sketch may hold; the count it can miss is about 3.5 / SKETCH_ITEMS of the rows
SKETCH_ITEMS = 10_000
COUNTABLE = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


@dataclass(frozen=True)
class SkewPolicy:
    """A key is hot when it holds more than ``share`` of the rows and more than ``min_rows``.

    At most ``1 / share`` keys can be hot; that bounds everything that is broadcast. The session
    settings ``spark.winback.skew.share`` and ``spark.winback.skew.minRows`` override both.
    """

    share: float = 0.002
    min_rows: int = 1_000_000

    @classmethod
    def of(cls, spark: SparkSession) -> SkewPolicy:
        return cls(
            share=float(spark.conf.get("spark.winback.skew.share", str(cls.share))),
            min_rows=int(spark.conf.get("spark.winback.skew.minRows", str(cls.min_rows))),
        )

    @property
    def max_keys(self) -> int:
        return min(int(1 / self.share) + 1, 1000)


@dataclass(frozen=True)
class HotKeys:
    keys: tuple
    nulls: bool

    def __bool__(self) -> bool:
        return bool(self.keys) or self.nulls


def find_hot_keys(df: DataFrame, key: str) -> HotKeys:
    """Hot keys of one column, from one pass that keeps a frequent-items sketch per task.

    The sketch's error is far below ``share``, and a key it should miss only costs time: both
    ways of joining give the same rows.
    """
    if not isinstance(df.schema[key].dataType, COUNTABLE):
        return HotKeys((), False)
    policy = SkewPolicy.of(df.sparkSession)
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(key).alias("known"),
        F.expr(f"approx_top_k(`{key}`, {policy.max_keys}, {SKETCH_ITEMS})").alias("top"),
    ).first()
    limit = max(policy.share * row["rows"], policy.min_rows)
    keys = tuple(entry["item"] for entry in row["top"] or [] if entry["item"] is not None and entry["count"] > limit)
    return HotKeys(keys, row["rows"] - row["known"] > limit)


def join_to_unique(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``left`` joined to ``right``, which has at most one row per key (``how``: left or inner).

    Without hot keys this is an ordinary join. Otherwise rows of hot keys stay where they are
    and meet a broadcast of the right rows of just these keys, at most one each. Rows without
    a key can match nothing and skip the shuffle too.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    hot = find_hot_keys(left, key)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(list(hot.keys)) if hot.keys else F.lit(False)
    pieces = [left.filter(F.col(key).isNotNull() & ~is_hot).join(right, key, how)]
    if hot.keys:
        pieces.append(left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key, how))
    if how == "left":
        pieces.append(left.filter(F.col(key).isNull()))
    result = pieces[0]
    for piece in pieces[1:]:
        result = result.unionByName(piece, allowMissingColumns=True)
    return result
