"""Shards of nearly equal bytes by sampled splitters.

Rows are ordered by (hash of the text, doc_id, a stored number of the row), so copies of a text stand together. A size-weighted
sample of the keys gives quantile boundaries of many more ranges than shards. Then every range is
measured exactly; a range that holds much more than its share of bytes or rows is sampled again and
subdivided, until none is left that can be. Neighbouring ranges fill the shards up to equal bytes. A group
of copies is cut only where its range is overfull.

Defined cases: size is UTF-8 bytes plus one, so a null or empty text has size 1; a null doc_id sorts
first within its text; rows that repeat doc_id and text are told apart by their number, so a group of them is cut anywhere; an empty
table gives no rows; a single row is never cut, so one very long document may make its shard
larger; columns besides doc_id and text are carried by ``write_shards`` and never read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.common import LOWEST_LONG, bounds_at_or_below, long_array, stored, text_or_empty

#: ranges per shard, sampled keys per range: together they bound what the driver sees
RANGES_PER_SHARD = 64
KEYS_PER_RANGE = 16
#: a range is overfull with more than so many times its share
OVERFULL = 2.0

#: the key of a row: hash of its text, then doc_id, then its number
Key = tuple[int, int, int]
KEY = ("text_hash", "id_key", "row")


def text_key(text: str = "text") -> Column:
    return F.xxhash64(text_or_empty(text))


def id_key(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LOWEST_LONG))


def range_of(splitters: list[Key], *key: Column) -> Column:
    """Index of the range of a row: the number of splitters at or below its key."""
    arrays = [long_array([splitter[part] for splitter in splitters]) for part in range(len(KEY))]
    return bounds_at_or_below(arrays, key, len(splitters))


@dataclass(frozen=True)
class ShardPlan:
    """Sorted splitters and, for each range between them, its shard and the rows of the shard before it."""

    splitters: list[Key]
    shards: list[int]
    first_slots: list[int]

    def shard(self, *key: Column) -> Column:
        return F.element_at(long_array(self.shards), (range_of(self.splitters, *key) + 1).cast("int")).cast("int")


def measure(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """Narrow rows to plan with (stored): doc_id, size, text_crc32, text_hash, id_key, row.

    ``row`` is a column that numbers the rows; without it they are numbered here.
    """
    text = text_or_empty()
    return stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            text_key().alias("text_hash"),
            id_key().alias("id_key"),
            (F.monotonically_increasing_id() if row is None else row).alias("row"),
        ),
        "shard-sizes",
    )


def _sampled(rows: DataFrame, weight: Column, per_range: Column | float, round_: int) -> DataFrame:
    """Keys drawn with a chance in proportion to their weight; the draw is a hash, so it does not depend on partitions."""
    chance = weight * KEYS_PER_RANGE / per_range
    draw = F.xxhash64(*KEY, F.lit(round_)) / F.lit(2.0**64) + 0.5
    return rows.filter(draw < chance).select(*KEY, F.greatest(weight, F.lit(per_range) / KEYS_PER_RANGE).alias("weight"))


def _quantiles(keys: list[tuple[int, int, int, float]], parts: int, whole_texts: bool) -> list[Key]:
    """Keys at which the sampled weight passes each of ``parts`` equal shares."""
    keys.sort()
    total, passed, found = sum(key[-1] for key in keys), 0.0, set()
    for *key, weight in keys:
        before, passed = passed, passed + weight
        if int(before / total * parts) != int(passed / total * parts):
            found.add((key[0], LOWEST_LONG, LOWEST_LONG) if whole_texts else tuple(key))
    return sorted(found)


def plan_shards(rows: DataFrame, shards: int) -> ShardPlan:
    """Splitters from samples, checked against exact sizes of every range. ``rows`` is from ``measure``."""
    whole = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    if not whole["rows"]:
        return ShardPlan([], [0], [0])
    parts = shards * RANGES_PER_SHARD
    # half by bytes and half by rows, so that neither a few long nor very many short texts fill a range
    share = F.col("size") / F.lit(2.0 * whole["bytes"]) + F.lit(0.5 / whole["rows"])
    first = _sampled(rows, share, 1.0 / parts, 0).collect()
    splitters = _quantiles([tuple(row) for row in first], parts, whole_texts=True)
    tried: set[Key | None] = set()
    for round_ in range(1, 64):
        ranged = rows.withColumn("range", range_of(splitters, *map(F.col, KEY)))
        sums = ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(share).alias("share"),
            (F.min(F.struct(*KEY)) != F.max(F.struct(*KEY))).alias("divisible"),
        ).collect()
        starts = [None, *splitters]
        overfull = [
            row for row in sums if row["divisible"] and row["share"] > OVERFULL / parts and starts[row["range"]] not in tried
        ]
        if not overfull:
            break
        inside = ranged.filter(F.col("range").isin([row["range"] for row in overfull]))
        per_range = defaultdict(list)
        for row in _sampled(inside, share, 1.0 / parts, round_).collect():
            key = tuple(row[name] for name in KEY)
            per_range[bisect_right(splitters, key)].append((*key, row["weight"]))
        more: set[Key] = set()
        for row in overfull:
            found = _quantiles(per_range[row["range"]], max(2, round(row["share"] * parts)), whole_texts=False)
            fresh = set(found) - set(splitters)
            more |= fresh
            if not fresh:
                tried.add(starts[row["range"]])
        splitters = sorted(set(splitters) | more)
    sizes = {row["range"]: (row["bytes"], row["rows"]) for row in sums}
    target, passed, of_range, slots, used = whole["bytes"] / shards, 0, [], [], defaultdict(int)
    for index in range(len(splitters) + 1):
        bytes_, count = sizes.get(index, (0, 0))
        shard = min(shards - 1, int((passed + bytes_ / 2) / target))
        of_range.append(shard)
        slots.append(used[shard])
        used[shard] += count
        passed += bytes_
    return ShardPlan(splitters, of_range, slots)


def place(rows: DataFrame, plan: ShardPlan) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within the shard) of every row."""
    at = (F.col("range") + 1).cast("int")
    ranged = rows.withColumn("range", range_of(plan.splitters, *map(F.col, KEY)))
    order = Window.partitionBy("range").orderBy(*KEY)
    return ranged.withColumn("place", F.row_number().over(order)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.element_at(long_array(plan.shards), at).cast("int").alias("shard"),
        (F.element_at(long_array(plan.first_slots), at) + F.col("place") - 1).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    rows = measure(docs)
    return place(rows, plan_shards(rows, shards))


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> ShardPlan:
    """Write whole documents in folders shard=0, shard=1, ..., rows of a shard in key order, each file one piece of it."""
    kept = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    row = F.col("__row")
    plan = plan_shards(measure(kept, row), shards)
    text_hash, id_ = text_key(), id_key()
    marked = kept.withColumns({"shard": plan.shard(text_hash, id_, row), "__hash": text_hash, "__id": id_})
    order = ["shard", "__hash", "__id", "__row"]
    pieces = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces.drop("__hash", "__id", "__row").write.partitionBy("shard").parquet(path)
    return plan
