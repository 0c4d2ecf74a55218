"""Periodic runs of words by maximal-pair enumeration.

A run is a stretch of words with smallest period q whose length is at least max(6, 4 q) and that no neighbouring word
extends. Words q apart in it are equal, so its beginnings at s and s + q share exactly length - q words and have
different words to their left: a maximal pair. The other way round, a maximal pair at distance p that shares at least
max(6 - p, 3 p) words is a whole run of period p. So runs are read off the pairs and never extended.

1. The suffixes of each text's words are sorted by prefix doubling, many texts at once; only suffixes that still
   share a prefix are sorted again. Common lengths of neighbours follow from the ranks of every doubling.
2. The intervals of equal common length form a tree. Bottom-up, a node holds its word numbers in lists by the word to
   their left (class lists). When a child joins a node of common length c, its members are paired with those of other
   classes at most c / 3 words away; the smaller side asks. All occurrences that close to each other lie a period
   apart, so all but the first have one class, and one look at the nearest member tells whether a list is read. The
   pairs read are the pairs wanted.
3. A run of period q is also found with periods 2 q, 3 q, ... where it is long enough; the smallest is kept.

Suffixes that share fewer than five words with another of their text belong to no wanted pair and form no node; nor do
intervals whose members all lie too far apart.

Defined cases: a null or empty text has no words and no run; repeated rows are handled one by one; a null doc_id is
passed on; words are compared as they are, upper and lower case differ; a text of n words takes about 8 n log2(n) bytes
while it is handled; an empty table gives no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from winback.llm.arrow import sliced_by_bytes, small_batches
from winback.llm.common import id_and_text

#: a run has at least so many words, and at least so many periods
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: words that the beginnings of a run share at least, reached with period 1
LEAST_SHARED = LEAST_WORDS - 1
#: bytes of text that a task handles at a time (one text at least)
TEXT_BYTES = 2_000_000

SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

#: start, length and period of runs
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def farthest(shared: int) -> int:
    """The largest period of a run whose beginnings share so many words."""
    return max(shared // (LEAST_PERIODS - 1), min(1, shared // LEAST_SHARED)) if shared >= LEAST_SHARED else 0


# --- suffixes -------------------------------------------------------------------------------


class Suffixes:
    """Sorted suffixes of several sequences laid end to end; only those of one sequence are compared."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray) -> None:
        """``codes``: the word at each place, different in different sequences; ``ends``: the end of its sequence."""
        self.size = len(codes)
        order = np.argsort(codes, kind="stable")
        new = np.ones(self.size, bool)
        new[1:] = codes[order[1:]] != codes[order[:-1]]
        starts = np.flatnonzero(new)
        rank = np.full(self.size + 1, -1, np.int64)
        rank[order] = np.repeat(starts, np.diff(np.append(starts, self.size)))
        #: ranks[k]: order by the first 2^k words, equal where these are equal; one entry more for the end
        self.ranks = [rank]
        places = order[np.repeat(np.diff(np.append(starts, self.size)) > 1, np.diff(np.append(starts, self.size)))]
        while len(places):
            places = self._doubled(places, ends)

    def _doubled(self, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Order by twice as many words; ``places`` are those that share their first words with another."""
        old, width = self.ranks[-1], 1 << (len(self.ranks) - 1)
        ahead = places + width
        second = np.where(ahead < ends[places], old[np.minimum(ahead, self.size)], -1)
        keys = old[places] * (self.size + 1) + second + 1
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        groups = old[places]
        at = np.arange(len(places))
        # a group keeps its first rank, its parts follow in order
        group_start = np.maximum.accumulate(np.where(np.append(True, groups[1:] != groups[:-1]), at, 0))
        new = np.append(True, keys[1:] != keys[:-1])
        part_start = np.maximum.accumulate(np.where(new, at, 0))
        rank = old.copy()
        rank[places] = groups + part_start - group_start
        self.ranks.append(rank)
        alone = new & np.append(new[1:], True)
        return places[~alone]

    def shared(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``left`` and ``right`` share, pair by pair."""
        left, right = left.copy(), right.copy()
        total = np.zeros(len(left), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            step = (rank[np.minimum(left, self.size)] == rank[np.minimum(right, self.size)]).astype(np.int64) << level
            total += step
            left += step
            right += step
        return total

    def intervals(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in suffix order, words each shares with the one before) of the largest intervals that may hold runs."""
        level = LEAST_SHARED.bit_length() - 1
        if len(self.ranks) <= level:
            return
        start = self.ranks[level][: self.size]
        places = np.argsort(self.ranks[-1][: self.size], kind="stable")
        same = start[places[1:]] == start[places[:-1]]
        member = np.append(same, False) | np.append(False, same)
        places = places[member]
        if not len(places):
            return
        shared = np.zeros(len(places), np.int64)
        pair = np.flatnonzero(start[places[1:]] == start[places[:-1]])
        shared[pair + 1] = self.shared(places[pair], places[pair + 1])
        number = np.cumsum(shared < LEAST_SHARED) - 1
        # the nearest two members of an interval against the most that any two share
        by_place = np.lexsort((places, number))
        gaps = np.full(number[-1] + 1, self.size, np.int64)
        inside = number[by_place[1:]] == number[by_place[:-1]]
        np.minimum.at(gaps, number[by_place[1:]][inside], np.diff(places[by_place])[inside])
        most = np.zeros(len(gaps), np.int64)
        np.maximum.at(most, number, shared)
        reach = np.where(most >= LEAST_SHARED, np.maximum(most // (LEAST_PERIODS - 1), 1), 0)
        starts = np.append(np.flatnonzero(shared < LEAST_SHARED), len(places))
        for index in np.flatnonzero(gaps <= reach).tolist():
            part = slice(starts[index], starts[index + 1])
            yield places[part], shared[part]


# --- maximal pairs --------------------------------------------------------------------------


class Node:
    """Members of an interval: all in order, and in lists by the word to their left."""

    __slots__ = ("members", "classes")

    def __init__(self, place: int, left: int) -> None:
        self.members = [place]
        self.classes = {left: [place]}

    def add(self, other: Node) -> None:
        for place in other.members:
            insort(self.members, place)
        for left, places in other.classes.items():
            mine = self.classes.setdefault(left, places)
            if mine is not places:
                for place in places:
                    insort(mine, place)


def pairs_between(node: Node, asking: Node, reach: int, lefts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (first, second) of a member of each node with different words to their left, at most ``reach`` apart."""
    members = node.members
    for left, places in asking.classes.items():
        for place in places:
            at = bisect_left(members, place - reach)
            if at == len(members):
                continue
            before = members[at]
            if before < place:
                # any later member before this place lies a period after the first, as this place does: same class
                if lefts[before] != left:
                    yield before, place
                at = bisect_right(members, place, at)
                if at == len(members):
                    continue
            after = members[at]
            if after <= place + reach:
                other = int(lefts[after])
                if other != left:
                    found = node.classes[other]
                    for second in found[bisect_left(found, after) : bisect_right(found, place + reach)]:
                        yield place, second


def maximal_pairs(places: np.ndarray, shared: np.ndarray, lefts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, second, words shared) of the maximal pairs of an interval that are runs, bottom-up."""
    stack: list[tuple[int, Node]] = []

    def joined(node: Node, child: Node, common: int) -> Iterator[tuple[int, int, int]]:
        large, small = (node, child) if len(node.members) >= len(child.members) else (child, node)
        for first, second in pairs_between(large, small, farthest(common), lefts):
            yield first, second, common
        large.add(small)
        stack.append((common, large))

    place_list, shared_list = places.tolist(), shared.tolist()
    child = Node(place_list[0], int(lefts[place_list[0]]))
    for place, common in zip(place_list[1:] + [-1], shared_list[1:] + [0], strict=True):
        while stack and stack[-1][0] > common:
            above, node = stack.pop()
            yield from joined(node, child, above)
            child = stack.pop()[1]
        if place < 0:
            return
        if stack and stack[-1][0] == common:
            yield from joined(stack.pop()[1], child, common)
        else:
            stack.append((common, child))
        child = Node(place, int(lefts[place]))


def find(codes: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> Runs:
    """All runs of sequences laid end to end, by place: start, length and smallest period.

    ``firsts`` and ``ends`` hold, for each place, where its sequence begins and ends.
    """
    at = np.arange(len(codes))
    lefts = np.where(at > firsts, codes[at - 1], -1) if len(codes) else codes
    runs: dict[tuple[int, int], int] = {}
    for places, shared in Suffixes(codes, ends).intervals():
        for first, second, common in maximal_pairs(places, shared, lefts):
            period = second - first
            key = (first, period + common)
            runs[key] = min(period, runs.get(key, period))
    rows = np.array(sorted((start, period, length) for (start, length), period in runs.items()), np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 2], rows[:, 1]


# --- texts ----------------------------------------------------------------------------------


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words one after the other, and how many each text has."""
    # a copy of its own, for slices
    texts = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    owners = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    filled = np.flatnonzero(pc.binary_length(words).to_numpy())  # white space at an end gives an empty word
    return words.take(pa.array(filled)), np.bincount(owners[filled], minlength=len(texts)).astype(np.int64)


def collapsed(words: pa.Array, counts: np.ndarray, runs: Runs) -> pa.Array:
    """The texts of the words without what repeats in a run after its first period, joined by single spaces."""
    starts, lengths, periods = runs
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    kept = np.cumsum(change[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(kept)])
    offsets = before[np.concatenate([[0], np.cumsum(counts)])]
    left = words.filter(pa.array(kept, pa.bool_())) if len(words) else words
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), left), pa.scalar(" ", pa.large_string()))


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every document."""
    struct = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            words, counts = words_of(batch.column("text"))
            coded = words.dictionary_encode()
            owners = np.repeat(np.arange(len(counts)), counts)
            limits = np.concatenate([[0], np.cumsum(counts)])
            codes = owners * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
            starts, lengths, periods = runs = find(codes, limits[owners], limits[owners + 1])
            of = owners[starts]
            offsets = np.searchsorted(of, np.arange(len(counts) + 1))
            rows = pa.StructArray.from_arrays([pa.array(part) for part in (starts - limits[of], lengths, periods)], names=["start", "length", "period"])
            columns = [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows), collapsed(words, counts, runs)]
            yield pa.RecordBatch.from_arrays([column.cast(field.type) for column, field in zip(columns, arrow, strict=True)], schema=arrow)

    return small_batches(docs).select(*id_and_text()).mapInArrow(run, struct)
