"""N-gram Jaccard join: a blocked sparse product of documents by n-grams.

Two texts link where their sets of word n-grams meet 100 * intersection >= percent * union. Nothing is lost: every bound below
follows from the sizes of the two sets.

1. Every text gives its sorted set of n-gram hashes (64 bits). Texts with equal sets form a class; only classes go on.
2. Which rows of the document by n-gram matrix can share a block follows from sizes. Linked sets x and y differ in at most
   D = (|x| + |y|) (100 - percent) / (100 + percent) n-grams. The range of hashes is cut into more than D parts, a number
   fixed per level of sizes, so some part holds the same n-grams in both. A class is a member of the block of each of its
   parts' contents, at its own level and at those of the sizes it may link with. Passages that many
   texts share fill few parts wholly, so their texts do not meet. (A part that is empty in both counts only where so many parts of a
   set are empty that the filled ones might all differ; see ``part_keys``.) Blocks with equal members are one.
3. Blocks whose pivot, the member of most blocks, is the same make a unit. A unit is not expanded into pairs. Its pivot is multiplied
   with the others. Where the unit then still holds several groups, the members outside its largest group are multiplied
   with all its members; a unit beyond COLUMNS members or TILE_GRAMS n-grams does so in tiles, each a task of its own that returns only
   links. So at the end every two members of a block are in one group or have been compared, and no cap is needed.
4. A product runs over the n-grams in column blocks and accumulates overlap counts. After each column block the pairs go whose
   count plus what both sets still hold cannot reach the overlap their sizes ask for.
5. Groups are the connected components of the links. ``similar_classes`` gives all links themselves, from tiles
   that cover every two members of a unit.

Classes have numbers of their own (``rep``), so doc_ids need not be unique or present. A group is told by its smallest doc_id.

Defined cases: a null text or one without words has an empty set and links with nothing, its component_id is its doc_id; a text with fewer
words than an n-gram has all its words as its only n-gram; repeated rows are one class; different texts with one doc_id are
joined each by itself; a group without any doc_id has a null component_id; an empty table gives no rows; columns besides doc_id and
text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.arrow import sliced_by_bytes, small_batches
from winback.llm.common import id_and_text, join_groups, release, stored
from winback.llm.near_dedup import components, merged_groups
from winback.llm.words import word_hashes

TEXT_BYTES = 8_000_000
#: rows (queries) and columns (members) of a tile
ROWS = 256
COLUMNS = 1024
#: n-grams of the rows, and of the columns, of a tile, about (one set at least)
TILE_GRAMS = 4_000_000
#: the hashes of n-grams are multiplied in 2^SHIFT column blocks
SHIFT = 3
#: sizes of one level are within this factor; a smaller one means fewer parts and more levels per set
GROWTH = 1.6
#: a part with more than 1/HOT_SHARE of all memberships is settled apart; so there are fewer than HOT_SHARE
HOT_SHARE = 1000
FREQUENT_ITEMS = 10_000


@dataclass(frozen=True)
class Threshold:
    """n-grams of ``width`` words, linked where 100 * intersection >= percent * union."""

    width: int = 5
    percent: int = 80

    def least_overlap(self, sizes: np.ndarray) -> np.ndarray:
        """N-grams that two sets with so many in sum must share."""
        return -(-self.percent * sizes // (100 + self.percent))

    def most_difference(self, size: np.ndarray) -> np.ndarray:
        """N-grams in only one of two linked sets, if one of them has this size."""
        return size * (100 - self.percent) // self.percent

    @property
    def levels(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest size of each level, the most that linked sets of it differ in, and its number of parts."""
        sizes = [8]
        while sizes[-1] < 2**40:
            sizes.append(int(sizes[-1] * GROWTH) + 1)
        largest = np.array(sizes, np.int64)
        differ = 2 * largest * (100 - self.percent) // (100 + self.percent)
        # some parts may be empty: a few more than needed
        return largest, differ, differ + 3 + differ // 32


# --- sets and parts -------------------------------------------------------------------------


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def ngram_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words, counts = word_hashes(texts)
    words = mixed(words)
    factor = np.uint64(0x9E3779B97F4A7C15)
    grams = words.copy()
    for step in range(1, width):
        grams[:-step] = mixed(grams[:-step] * factor + words[step:])
    sets, end = [], 0
    for count in counts.tolist():
        start, end = end, end + count
        if count >= width:
            sets.append(np.unique(grams[start : end - width + 1]))
            continue
        whole = np.full(1, count, np.uint64)
        for word in words[start:end]:  # fewer words than an n-gram: the whole sequence
            whole = mixed(whole * factor + word)
        sets.append(whole if count else np.zeros(0, np.uint64))
    return sets


def part_keys(sets: list[np.ndarray], threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """(key, owner) of the contents of every set's parts, owners ascending.

    Two different linked sets have a key in common: of the more than D parts of the level of the larger one at most D
    differ. If a set has more than D filled parts, a filled one is equal in both. Only otherwise are its empty parts keys, and then
    the same is true of the other set.
    """
    largest, differ, parts = threshold.levels
    sizes = np.array([len(mine) for mine in sets], np.int64)
    most = threshold.most_difference(sizes)
    flat, owners = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
    own = np.searchsorted(largest, sizes)
    last = np.searchsorted(largest, sizes * 100 // threshold.percent)
    keys, of = [], []
    for step in range(int((last - own).max(initial=0)) + 1):
        level = own + step
        chosen = (most > 0) & (level <= last)
        level = np.minimum(level, len(largest) - 1)
        member = chosen[owners]
        grams, mine = flat[member], owners[member]
        if not len(mine):
            continue
        part = ((grams >> np.uint64(32)) * parts[level][mine].astype(np.uint64)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, (mine[1:] != mine[:-1]) | (part[1:] != part[:-1])))
        filled_by, filled = mine[starts], part[starts]
        names = mixed((level[filled_by].astype(np.uint64) << np.uint64(48)) + filled + np.uint64(1))
        keys.append(mixed(np.add.reduceat(mixed(grams), starts) ^ names))
        of.append(filled_by)
        # the rare sets with too few filled parts
        few = chosen & (np.bincount(filled_by, minlength=len(sets)) <= np.minimum(most, differ[level]))
        for owner in np.flatnonzero(few).tolist():
            empty = np.setdiff1d(np.arange(parts[level[owner]], dtype=np.uint64), filled[filled_by == owner])
            keys.append(mixed((np.uint64(level[owner]) << np.uint64(48)) + empty + np.uint64(1)))
            of.append(np.full(len(empty), owner))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, owner = np.concatenate(keys), np.concatenate(of)
    order = np.argsort(owner, kind="stable")
    return key[order], owner[order]


SKETCH = "doc_id bigint, text_key bigint, n_shingles bigint, set_id binary, set_key bigint, parts array<bigint>"


def sketches(docs: DataFrame, threshold: Threshold) -> DataFrame:
    """Of every document: the size of its set, set_id (128 bits; null: empty), set_key (its first 64) and its part keys.

    Of equal sets that a task meets together one carries the parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            with np.errstate(over="ignore"):
                sets = ngram_sets(batch.column("text"), threshold.width)
                ids = [xxhash.xxh128_digest(mine.tobytes()) if len(mine) else None for mine in sets]
                first = {set_id: at for at, set_id in reversed(list(enumerate(ids)))}
                nothing = np.zeros(0, np.uint64)
                keys, owners = part_keys([mine if first[set_id] == at else nothing for at, (mine, set_id) in enumerate(zip(sets, ids, strict=True))], threshold)
            offsets = np.searchsorted(owners, np.arange(len(sets) + 1)).astype(np.int32)
            columns = [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(map(len, sets), pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array([int.from_bytes(set_id[:8], "little", signed=True) if set_id else None for set_id in ids], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "set_id", "set_key", "parts"])

    return small_batches(docs).select(*id_and_text()).withColumn("text_key", F.xxhash64("text")).mapInArrow(run, SKETCH)


# --- products -------------------------------------------------------------------------------


def products(rows: list[np.ndarray], columns: list[np.ndarray], threshold: Threshold) -> Iterator[tuple[int, np.ndarray]]:
    """For each row (a sorted set) the columns (sorted sets) that link with it."""
    sizes = np.array([len(mine) for mine in columns], np.int64)
    flat, owners = np.concatenate(columns), np.repeat(np.arange(len(columns)), sizes)
    order = np.argsort(flat, kind="stable")
    grams, holders = flat[order], owners[order]
    shift, blocks = np.uint64(64 - SHIFT), 1 << SHIFT
    in_block = np.bincount(owners * blocks + (flat >> shift).astype(np.int64), minlength=len(columns) * blocks)
    # n-grams of each column set after each column block
    rest = sizes[:, None] - np.cumsum(in_block.reshape(-1, blocks), axis=1)
    for at, mine in enumerate(rows):
        need = threshold.least_overlap(sizes + len(mine))
        alive = need <= np.minimum(sizes, len(mine))
        counts = np.zeros(len(columns), np.int64)
        limits = np.searchsorted(mine >> shift, np.arange(blocks + 1, dtype=np.uint64))
        for block in range(blocks):
            if not alive.any():
                break
            part = mine[limits[block] : limits[block + 1]]
            low = np.searchsorted(grams, part, side="left")
            many = np.searchsorted(grams, part, side="right") - low
            before = np.cumsum(many)
            held = np.repeat(low - before + many, many) + np.arange(before[-1] if len(before) else 0)
            counts += np.bincount(holders[held], minlength=len(columns))
            alive &= counts + np.minimum(rest[:, block], len(mine) - limits[block + 1]) >= need
        yield at, np.flatnonzero(alive)


def _sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(value, np.uint64) for value in column.to_pylist()]


def pivot_links(members: DataFrame, threshold: Threshold) -> DataFrame:
    """The links (a, b) of each unit's pivot with its other members (unit, rep, grams); members a task meets together are one product."""
    pivots = members.filter("rep = unit").select("unit", F.col("grams").alias("pivot_grams"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, first, of = np.unique(batch.column("a").to_numpy(), return_index=True, return_inverse=True)
            pivots = _sets(batch.column("pivot_grams").take(pa.array(first)))
            others = _sets(batch.column("grams"))
            found = []
            for row in range(len(rows)):
                mine = np.flatnonzero(of == row)
                for _, linked in products([pivots[row]], [others[at] for at in mine.tolist()], threshold):
                    found.append(mine[linked])
            yield batch.select(["a", "b"]).take(pa.array(np.concatenate(found)))

    joined = members.filter("rep != unit").join(pivots, "unit").select(F.col("unit").alias("a"), F.col("rep").alias("b"), "grams", "pivot_grams")
    return joined.mapInArrow(run, "a bigint, b bigint")


def tile_links(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Links (a, b) between a row and a column of one unit that are in different groups.

    ``members``: unit, rep, grams, component, is_row, row_tiles, column_tiles. Of each other group a row links with, one link is returned.
    """
    dealt = members.withColumn("draw", F.xxhash64("rep"))

    def side(rows: DataFrame, is_row: bool, own: str, other: str) -> DataFrame:
        mine = F.pmod("draw", own).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return rows.select("unit", "rep", "grams", "component", F.lit(is_row).alias("is_row"), mine, every)

    rows = side(dealt.filter("is_row"), True, "row_tiles", "column_tiles")
    columns = side(dealt, False, "column_tiles", "row_tiles")
    tiles = rows.unionByName(columns)

    def multiply(tile: pa.Table) -> pa.Table:
        is_row = tile.column("is_row").to_numpy()
        reps, groups = tile.column("rep").to_numpy(), tile.column("component").to_numpy()
        sets = _sets(tile.column("grams"))
        row_at, column_at = np.flatnonzero(is_row), np.flatnonzero(~is_row)
        found = [np.zeros((0, 2), np.int64)]
        if len(row_at) and len(column_at):
            for at, linked in products([sets[row] for row in row_at], [sets[column] for column in column_at], threshold):
                row, linked = row_at[at], column_at[linked]
                linked = linked[groups[linked] != groups[row]]
                linked = linked[np.unique(groups[linked], return_index=True)[1]]
                found.append(np.stack([np.full(len(linked), reps[row]), reps[linked]], axis=1))
        pairs = np.concatenate(found)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return tiles.groupBy("unit", "row_tiles", "column_tiles").applyInArrow(multiply, "a bigint, b bigint")


# --- blocks ---------------------------------------------------------------------------------


def tiles_for(count: Column, grams: Column, most: int) -> Column:
    """How many tiles so many sets with so many n-grams fill."""
    return F.greatest(F.ceil(count / most), F.ceil(grams / TILE_GRAMS), F.lit(1)).cast("int")


def shared_parts(sketched: DataFrame) -> DataFrame:
    """(part, set_key) of the parts that several different sets have, each once.

    Memberships are dealt by part once. Parts with very many are known from a frequent-items sketch; theirs are dealt by
    set instead.
    """
    keys = sketched.filter(F.size("parts") > 0).select("set_key", F.explode("parts").alias("part"))
    seen = keys.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(part, {HOT_SHARE}, {FREQUENT_ITEMS})").alias("top")).first()
    hot = [item["item"] for item in seen["top"] or [] if item["count"] > max(seen["rows"] // HOT_SHARE, COLUMNS)]
    cold = keys if not hot else keys.filter(~F.col("part").isin(hot))
    same_part = Window.partitionBy("part")
    sides = cold.withColumns({"least": F.min("set_key").over(same_part), "most": F.max("set_key").over(same_part)})
    found = sides.filter("least < most").select("part", "set_key").distinct()
    if hot:
        distinct = keys.filter(F.col("part").isin(hot)).distinct()
        several = distinct.groupBy("part").agg(F.min("set_key").alias("least"), F.max("set_key").alias("most")).filter("least < most")
        found = found.unionByName(distinct.join(F.broadcast(several.select("part")), "part", "left_semi"))
    return stored(found, "shared-parts")


def sets_and_parts(docs: DataFrame, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """The sketches without their parts, and the shared parts; both stored."""
    whole = stored(sketches(docs, threshold), "sketches")
    narrow = stored(whole.drop("parts"), "set-ids")
    shared = shared_parts(whole)
    release(whole)
    return narrow, shared


def blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(part, rep, size) of the members of all blocks, one block of those with equal members; from ``shared_parts``."""
    prints = members.groupBy("part").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor("set_key").alias("one"), F.bit_xor(F.xxhash64("set_key")).alias("two")
    )
    chosen = prints.groupBy("members", "one", "two").agg(F.min("part").alias("part")).select("part")
    named = classes.select("set_key", "rep", F.col("n_shingles").alias("size"))
    return stored(members.join(chosen, "part").join(named, "set_key").select("part", "rep", "size"), "blocks")


def units_of(members: DataFrame) -> DataFrame:
    """(unit, rep, size): a unit is named by a pivot, the member of most blocks in its blocks, and has the members of all of them.

    Each once, so a set that shares many parts with another travels once and not once per part. Stored.
    """
    degrees = members.groupBy("rep").agg(F.count(F.lit(1)).alias("degree"))
    pivots = members.join(degrees, "rep").groupBy("part").agg(F.max(F.struct("degree", "rep")).alias("best"))
    named = members.join(pivots, "part").select(F.col("best.rep").alias("unit"), "rep", "size").distinct()
    return stored(named, "units")


def unit_sets(docs: DataFrame, classes: DataFrame, units: DataFrame, threshold: Threshold) -> DataFrame:
    """(unit, rep, size, grams) of the members of units; the sets are made again from one text of each class.

    Texts and classes are joined by sorting at every size, so that plans and figures are the same for small tables.
    """
    members = units.groupBy("rep").agg(F.collect_set("unit").alias("units"))
    own_row = classes.select("rep", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "copies")
    wanted = stored(members.join(own_row, "rep"), "active").hint("merge")
    texts = docs.select(*id_and_text()).withColumn("text_key", F.xxhash64("text"))
    own = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    found = texts.join(wanted.filter("copies = 1"), own).select("rep", "units", "text")
    repeated = wanted.filter("copies > 1")
    if not repeated.isEmpty():
        found = found.unionByName(texts.join(repeated, own).select("rep", "units", "text").dropDuplicates(["rep"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            with np.errstate(over="ignore"):
                sets = ngram_sets(batch.column("text"), threshold.width)
            lists = batch.column("units")
            at = pa.array(np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy()))
            columns = [lists.flatten(), batch.column("rep").take(at)]
            columns += [pa.array(values).take(at) for values in ([len(mine) for mine in sets], [mine.tobytes() for mine in sets])]
            yield pa.RecordBatch.from_arrays([column.cast(kind) for column, kind in zip(columns, (*[pa.int64()] * 3, pa.binary()), strict=True)], names=["unit", "rep", "size", "grams"])

    return found.mapInArrow(run, "unit bigint, rep bigint, size bigint, grams binary")


def unit_links(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Links (a, b) that join the members (unit, rep, grams) of each unit into their groups; for units of one tile."""

    def resolve(unit: pa.Table) -> pa.Table:
        reps = unit.column("rep").to_numpy()
        sets = _sets(unit.column("grams"))
        group = np.arange(len(reps))
        found = []

        def link(at: int, linked: np.ndarray) -> None:
            for other in linked.tolist():
                if group[other] != group[at]:
                    found.append((reps[at], reps[other]))
                    group[group == group[other]] = group[at]

        pivot = int(np.flatnonzero(reps == unit.column("unit")[0].as_py())[0])
        for _, linked in products([sets[pivot]], sets, threshold):
            link(pivot, linked)
        # then the members outside the largest group; the pivot has met all
        main = np.bincount(group).argmax()
        rows = np.flatnonzero((group != main) & (np.arange(len(reps)) != pivot)).tolist()
        for at, linked in products([sets[row] for row in rows], sets, threshold):
            link(rows[at], linked)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return members.select("unit", "rep", "grams").groupBy("unit").applyInArrow(resolve, "a bigint, b bigint")


def open_members(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (without pivots) of units that still hold several groups, as ``tile_links`` takes them.

    Rows of the tiles are the members outside the largest group of their unit.
    """
    left = members.filter("rep != unit")
    grouped = left.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sums = grouped.groupBy("unit", "component").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("grams"))
    main = F.max(F.struct("sets", "grams", "component")).alias("main")
    totals = sums.groupBy("unit").agg(main, F.sum("sets").alias("sets"), F.sum("grams").alias("grams"))
    several = totals.filter(F.col("sets") > F.col("main.sets")).select(
        "unit",
        F.col("main.component").alias("main"),
        tiles_for(F.col("sets") - F.col("main.sets"), F.col("grams") - F.col("main.grams"), ROWS).alias("row_tiles"),
        tiles_for(F.col("sets"), F.col("grams"), COLUMNS).alias("column_tiles"),
    )
    return grouped.join(several, "unit").withColumn("is_row", F.col("component") != F.col("main")).drop("main", "size")


def link_groups(docs: DataFrame, shared: DataFrame, classes: DataFrame, threshold: Threshold) -> DataFrame:
    """(rep, component) of all classes that link with another."""
    members = blocks(shared, classes)
    units = units_of(members)
    release(shared, members)
    counts = units.groupBy("unit").agg(tiles_for(F.count(F.lit(1)), F.sum("size"), COLUMNS).alias("tiles"))
    sized = stored(units.join(counts, "unit"), "sized-units")
    release(units)
    links = stored(unit_links(unit_sets(docs, classes, sized.filter("tiles = 1"), threshold), threshold), "links")
    release()
    large = sized.filter("tiles > 1")
    if large.isEmpty():
        return components(links)
    # a unit that fills several tasks: its pivot first, then tiles of what the pivot did not bring together
    members = stored(unit_sets(docs, classes, large, threshold), "large-units")
    links = stored(links.unionByName(pivot_links(members, threshold)), "links")
    groups = components(links)
    rest = stored(open_members(members, groups), "open")
    if rest.isEmpty():
        return groups
    more = stored(tile_links(rest, threshold), "links")
    return groups if more.isEmpty() else merged_groups(groups, more)


# --- results --------------------------------------------------------------------------------


def set_classes(sketched: DataFrame) -> DataFrame:
    """One row per different set, stored: rep, set_id, set_key, n_shingles, rows, and the no_id, doc_id, text_key and copies of one of
    its rows, that with the smallest doc_id; copies counts the rows equal to that one."""
    whole = sketched.filter("set_id is not null").withColumn("no_id", F.col("doc_id").isNull())
    alike = whole.groupBy("set_id", "set_key", "n_shingles", "no_id", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    own = F.min(F.struct("no_id", "doc_id", "text_key", "copies")).alias("own")
    numbered = alike.groupBy("set_id", "set_key", "n_shingles").agg(F.sum("copies").alias("rows"), own)
    return stored(numbered.withColumn("rep", F.monotonically_increasing_id()).select("rep", "set_id", "set_key", "n_shingles", "rows", "own.*"), "classes")


def similar_groups(docs: DataFrame, threshold: Threshold | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links lead to) of every document."""
    threshold = threshold or Threshold()
    sketched, shared = sets_and_parts(docs, threshold)
    classes = set_classes(sketched)
    groups = link_groups(docs, shared, classes, threshold)
    grouped = classes.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    grouped = stored(grouped.select("set_id", "rows", "component", F.struct("no_id", "doc_id").alias("own")), "grouped")
    firsts = grouped.groupBy("component").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("classes"))
    named = join_groups(grouped.select("set_id", "rows", "component"), firsts, "component", "classes")
    verdicts = named.select("set_id", "rows", F.col("first.doc_id").alias("component_id"))
    linked = join_groups(sketched.filter("set_id is not null").select("doc_id", "n_shingles", "set_id"), verdicts, "set_id", "rows")
    alone = sketched.filter("set_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)


def similar_classes(docs: DataFrame, threshold: Threshold | None = None) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links (a, b) between classes, a < b, and the membership (doc_id, n_shingles, rep) of every document.

    Every two members of a unit are multiplied, tile by tile, so the work follows the squares of the units' sizes, as
    the number of links may. Documents without words have no rep.
    """
    threshold = threshold or Threshold()
    sketched, shared = sets_and_parts(docs, threshold)
    classes = set_classes(sketched)
    units = units_of(blocks(shared, classes))
    members = unit_sets(docs, classes, units, threshold)
    tiles = [tiles_for(F.count(F.lit(1)), F.sum("size"), most).alias(name) for name, most in (("row_tiles", ROWS), ("column_tiles", COLUMNS))]
    counts = units.groupBy("unit").agg(*tiles)
    every = members.join(counts, "unit").withColumns({"component": F.col("rep"), "is_row": F.lit(True)})
    links = tile_links(every, threshold).filter("a < b").distinct()
    whole = sketched.filter("set_id is not null").select("doc_id", "n_shingles", "set_id")
    membership = join_groups(whole, classes.select("set_id", "rep", "rows"), "set_id", "rows").select("doc_id", "n_shingles", "rep")
    alone = sketched.filter("set_id is null").select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("rep"))
    return links, membership.unionByName(alone)
