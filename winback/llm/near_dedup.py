"""Near-duplicate groups by MinHash bands and sequential Bayesian verification.

1. Every text gives the set of its word shingles (64-bit hashes), a signature of minimum hashes, and an id of the set. Texts with
   equal sets form a class with one representative; only classes go on.
2. Signatures are cut into bands; classes with an equal band share a bucket. Bands and rows are chosen so that a
   pair at the limit shares no bucket with a chance of at most MISS.
3. A bucket is not expanded into pairs. One pivot, the member with most company in all its buckets, is compared with the
   others, which puts copies of one text into one group at once. Where a bucket then still holds several groups, the
   members outside its largest group are the queries against all its members, in blocks: a task compares one block of
   queries with one block of members and returns only links. So at the end every two members of a bucket are
   in one group or have been compared, and no cap is needed.
4. A comparison reads the signatures in batches and stops as soon as the posterior chance of a similarity at the limit, after
   m of n equal hashes and a uniform prior, is below MISS. Survivors are confirmed on their full
   sets, from the texts.
5. Groups are the connected components of the confirmed links, by alternating large and small stars.

Classes have numbers of their own (``rep``), so doc_ids need not be unique or present. A group is told by its smallest doc_id, and
its row with the smallest (doc_id, hash of the text), ids before none, is kept.

Defined cases: a null text or one without words has an empty set, is linked with nothing and kept; different texts with one doc_id
are searched each by itself, and their groups may bear the same component_id; a text with fewer words than a shingle has all
its words as its only shingle; repeated rows are one class; rows without doc_id are searched like others, and their group's
component_id is null if none of it has an id; columns besides doc_id and text are carried by ``keep_one`` and never read; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.arrow import sliced_by_bytes, tidied
from winback.llm.common import id_and_text, join_groups, stored, text_or_empty
from winback.llm.words import word_hashes

HASHES = 120
BATCH = 20
#: chance of losing a pair at the limit, for the bands and for each look at the signatures
MISS = 1e-6
TEXT_BYTES = 8_000_000
#: queries and members of a block
QUERIES_EACH = 256
MEMBERS_EACH = 1024


@dataclass(frozen=True)
class Rule:
    """Shingles of ``width`` words, linked where 100 * intersection >= percent * union."""

    width: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Most rows a band can have."""
        return max(rows for rows in range(1, 13) if (1 - (self.percent / 100) ** rows) ** (HASHES // rows) <= MISS)


# --- sets and signatures --------------------------------------------------------------------


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts)
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    mixed = words.copy()
    for step in range(1, width):
        mixed[:-step or None] = (mixed[: -step or None] ^ (mixed[: -step or None] >> np.uint64(29))) * multiplier + words[step:]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * multiplier
    mixed ^= mixed >> np.uint64(29)
    sets, end = [], 0
    for count in counts.tolist():
        start, end = end, end + count
        if count >= width:
            sets.append(np.unique(mixed[start : end - width + 1]))
        elif count:
            value = np.uint64(count)
            for word in words[start:end]:  # fewer words than a shingle: the whole sequence
                value = (value ^ (value >> np.uint64(29))) * multiplier + word
            sets.append(np.array([value], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**31, (HASHES, 1), np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, (HASHES, 1), np.uint32)


MULTIPLY, ADD = _permutations()


def signature(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(values), block):
        np.minimum(least, (values[at : at + block] * MULTIPLY + ADD).min(axis=1), out=least)
    return least


SKETCH = "doc_id bigint, text_key bigint, n_shingles bigint, set_id binary, signature binary"


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_id (null: empty set) and signature of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            with np.errstate(over="ignore"):
                sets = shingle_sets(batch.column("text"), width)
                signatures = [signature(mine).tobytes() if len(mine) else None for mine in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([xxhash.xxh128_digest(mine.tobytes()) if len(mine) else None for mine in sets], pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "set_id", "signature"],
            )

    return docs.select(*id_and_text()).withColumn("text_key", F.xxhash64("text")).mapInArrow(tidied(run), SKETCH)


# --- comparisons ----------------------------------------------------------------------------


def least_matches(seen: int, limit: float, miss: float = MISS) -> int:
    """Fewest equal hashes of ``seen`` at which the posterior chance of a similarity >= limit is at least ``miss``.

    With a uniform prior that chance after m matches is P(Binomial(seen + 1, limit) <= m).
    """
    total = 0.0
    for matches in range(seen + 1):
        total += comb(seen + 1, matches) * limit**matches * (1 - limit) ** (seen + 1 - matches)
        if total >= miss:
            return matches
    return seen


def plausible(left: np.ndarray, right: np.ndarray, limit: float) -> np.ndarray:
    """Which pairs of signatures (rows) survive every batch."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for seen in range(BATCH, HASHES + 1, BATCH):
        part = slice(seen - BATCH, seen)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least_matches(seen, limit)]
    found = np.zeros(len(left), bool)
    found[alive] = True
    return found


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def survivors(pairs: DataFrame, classes: DataFrame, limit: float) -> DataFrame:
    """Pairs (a, b) whose signatures do not rule the limit out."""
    sides = [classes.select(F.col("rep").alias(side), F.col("signature").alias(f"signature_{side}")) for side in ("a", "b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = plausible(_signatures(batch.column("signature_a")), _signatures(batch.column("signature_b")), limit)
            yield batch.select(["a", "b"]).filter(pa.array(found))

    joined = pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "signature_a", "signature_b")
    return joined.mapInArrow(tidied(run), "a bigint, b bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    sides = [texts.select(F.col("rep").alias(side), F.col("text").alias(f"text_{side}")) for side in ("a", "b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced_by_bytes(iter([whole]), "text_b", TEXT_BYTES // 2):
                # pairs of one task share pivots: each text of a slice is taken apart once
                ids = pc.unique(pa.chunked_array([batch.column("a"), batch.column("b")]))
                first = {}
                for side in ("a", "b"):
                    for at, rep in enumerate(batch.column(side).to_pylist()):
                        first.setdefault(rep, (side, at))
                chosen = [batch.column(f"text_{first[rep][0]}")[first[rep][1]].as_py() for rep in ids.to_pylist()]
                with np.errstate(over="ignore"):
                    sets = dict(zip(ids.to_pylist(), shingle_sets(pa.array(chosen, pa.large_string()), rule.width), strict=True))
                linked = []
                for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    linked.append(100 * both >= rule.percent * (len(sets[a]) + len(sets[b]) - both))
                yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(tidied(run), "a bigint, b bigint")


# --- groups ---------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(rep, component): the smallest node reachable, for every node of the links (a, b)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    while True:
        # large star: each node hands its larger neighbours to its smallest neighbour (or itself)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: each node hands its smaller neighbours and itself to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u != v").distinct(), "edges")
        # at the end every node hangs on one smallest node, which hangs on none
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 and up > 0").isEmpty():
            return edges.select(F.col("u").alias("rep"), F.col("v").alias("component"))


def merged_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` after further links (a, b): only the links between groups are searched again."""
    ends = [groups.select(F.col("rep").alias(side), F.col("component").alias(f"of_{side}")) for side in ("a", "b")]
    between = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    joined = components(between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    renamed = joined.select(F.col("rep").alias("component"), F.col("component").alias("new"))
    return groups.join(renamed, "component", "left").select("rep", F.coalesce("new", "component").alias("component")).unionByName(joined)


def buckets(classes: DataFrame, rows: int) -> DataFrame:
    """(bucket, band, rep, company) of every band that several classes share; company counts members over all buckets."""
    hashes = [F.xxhash64(F.lit(band), F.substring("signature", 4 * rows * band + 1, 4 * rows)) for band in range(HASHES // rows)]
    members = classes.select("rep", F.posexplode(F.array(*hashes)).alias("band", "bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(members.join(sizes, "bucket"), "buckets")
    company = shared.groupBy("rep").agg(F.sum("size").alias("company"))
    return stored(shared.select("bucket", "band", "rep").join(company, "rep"), "members")


def pivot_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivots (bucket, rep): the member with most company; pairs (a, b): the pivot with each other member."""
    best = members.groupBy("bucket").agg(F.max(F.struct("company", F.col("rep"))).alias("best"))
    pivots = stored(best.select("bucket", F.col("best.rep").alias("rep")), "pivots")
    named = pivots.select(F.col("bucket").alias("pivot_bucket"), F.col("rep").alias("pivot"))
    pairs = members.join(named, (F.col("bucket") == F.col("pivot_bucket")) & (F.col("rep") != F.col("pivot")))
    return pivots, pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def open_members(members: DataFrame, pivots: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (without pivots) of buckets that still hold several groups: bucket, band, rep, component,
    is_query, x_blocks, y_blocks.

    Queries are the members outside the largest group of their bucket.
    """
    left = members.select("bucket", "band", "rep").join(pivots, ["bucket", "rep"], "left_anti")
    grouped = left.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sizes = grouped.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    totals = sizes.groupBy("bucket").agg(F.max(F.struct("size", F.col("component"))).alias("main"), F.sum("size").alias("all"))
    several = totals.filter(F.col("all") > F.col("main.size")).select(
        "bucket",
        F.col("main.component").alias("main"),
        F.ceil((F.col("all") - F.col("main.size")) / QUERIES_EACH).cast("int").alias("x_blocks"),
        F.ceil(F.col("all") / MEMBERS_EACH).cast("int").alias("y_blocks"),
    )
    return grouped.join(several, "bucket").withColumn("is_query", F.col("component") != F.col("main")).drop("main")


def block_links(members: DataFrame, active: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between groups, from the members of ``open_members``."""
    dealt = members.withColumn("draw", F.xxhash64("rep"))
    own_x, own_y = F.pmod("draw", "x_blocks"), F.pmod("draw", "y_blocks")
    asked = dealt.filter("is_query").select("bucket", "band", "rep", "component", F.lit(True).alias("asks"), own_x.alias("x"), F.explode(F.sequence(F.lit(0), F.col("y_blocks") - 1)).alias("y"))
    met = dealt.select("bucket", "band", "rep", "component", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("x_blocks") - 1)).alias("x"), own_y.alias("y"))
    units = asked.unionByName(met).join(active, "rep")
    limit, rows = rule.percent / 100, rule.rows

    def compare(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        asks = unit.column("asks").to_numpy()
        reps, groups = unit.column("rep").to_numpy(), unit.column("component").to_numpy()
        band = unit.column("band")[0].as_py()
        signatures = _signatures(unit.column("signature"))
        with np.errstate(over="ignore"):
            sets = shingle_sets(pa.array(unit.column("text").to_pylist(), pa.large_string()), rule.width)
        others = np.flatnonzero(~asks)
        found = []
        for query in np.flatnonzero(asks):
            mine = others[groups[others] != groups[query]]
            equal = signatures[mine] == signatures[query]
            # a pair that shares an earlier band is compared in that band's bucket
            earlier = equal[:, : band * rows].reshape(len(mine), band, rows).all(axis=2).any(axis=1) if band else np.zeros(len(mine), bool)
            mine, equal = mine[~earlier], equal[~earlier]
            likely = plausible(signatures[mine], np.broadcast_to(signatures[query], (len(mine), HASHES)), limit)
            mine, agreement = mine[likely], equal[likely].sum(axis=1)
            linked = set()
            for other in mine[np.argsort(-agreement, kind="stable")].tolist():
                if groups[other] in linked:
                    continue  # one link joins two groups
                both = len(np.intersect1d(sets[query], sets[other], assume_unique=True))
                if 100 * both >= rule.percent * (len(sets[query]) + len(sets[other]) - both):
                    linked.add(groups[other])
                    found.append((int(reps[query]), int(reps[other])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return units.groupBy("bucket", "x", "y").applyInArrow(compare, "a bigint, b bigint")


def link_classes(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(rep, component) of all classes that are linked with another; classes: rep, doc_id, text_key, signature, rows."""
    limit = rule.percent / 100
    members = buckets(classes, rule.rows)
    wanted = classes.join(members.select("rep").distinct(), "rep", "left_semi")
    wanted = wanted.select("rep", "rows", "signature", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
    texts = docs.select(*id_and_text()).withColumn("text_key", F.xxhash64("text"))
    own = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    # rows of a large class may all repeat one doc_id and text; there are fewer than 1000 such classes
    large = F.col("rows") > max(wanted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] // 1000, 1)
    found = texts.join(F.broadcast(wanted.filter(large)), own).unionByName(texts.join(wanted.filter(~large), own))
    active = stored(found.dropDuplicates(["rep"]).select("rep", "signature", "text"), "active")

    pivots, pairs = pivot_pairs(members)
    links = stored(confirmed(survivors(pairs, active, limit), active, rule), "links")
    groups = components(links)
    rest = stored(open_members(members, pivots, groups), "open")
    if rest.isEmpty():
        return groups
    more = stored(block_links(rest, active, rule), "links")
    return groups if more.isEmpty() else merged_groups(groups, more)


def judged(docs: DataFrame, rule: Rule) -> DataFrame:
    """``near_groups`` with text_key, a hash of the text."""
    sketched = stored(sketches(docs, rule.width), "sketches")
    whole = sketched.filter("set_id is not null")
    # one signature per class; a number of its own, which lasts as it is stored
    own = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "signature")).alias("own")
    numbered = whole.groupBy("set_id").agg(F.count(F.lit(1)).alias("rows"), own).withColumn("rep", F.monotonically_increasing_id())
    classes = stored(numbered.select("rep", "set_id", "rows", "own.no_id", "own.doc_id", "own.text_key", "own.signature"), "classes")
    groups = link_classes(docs, classes, rule)
    grouped = classes.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    grouped = stored(grouped.select("set_id", "rows", "component", F.struct("no_id", "doc_id", "text_key").alias("own")), "grouped")
    firsts = grouped.groupBy("component").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("classes"))
    verdicts = join_groups(grouped.select("set_id", "rows", "component"), firsts, "component", "classes").select("set_id", "rows", "first")
    linked = join_groups(whole.select("doc_id", "text_key", "n_shingles", "set_id"), verdicts, "set_id", "rows")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    linked = linked.select("doc_id", "text_key", "n_shingles", F.col("first.doc_id").alias("component_id"), kept.alias("kept"))
    alone = sketched.filter("set_id is null").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def near_groups(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the group) and kept of every document."""
    return judged(docs, rule or Rule()).drop("text_key")


def keep_one(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """One document of each group, with all its columns; of rows that repeat a kept doc_id and text one."""
    stay = judged(docs, rule or Rule()).filter("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_key").alias("__kept_key"))
    known = docs.withColumn("__text_key", F.xxhash64(text_or_empty()))
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.col("__text_key") == F.col("__kept_key"))
    return known.join(stay, same, "left_semi").dropDuplicates(["doc_id", "__text_key"]).drop("__text_key")
