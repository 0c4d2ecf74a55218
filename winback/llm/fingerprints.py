"""Document fingerprints from prefix polynomial hashes.

A text has two prefix arrays, sums of (code point + 1) * base^position modulo 2^31 - 1. Two array entries give the
hash of any span, so any two spans can be compared in constant time, and the longest common extension of two
positions is found by binary search on its length. A fingerprint is a thinned copy of the
arrays: length and hash of the whole text, hashes of the beginnings and of the endings of
geometric lengths, and the smallest hashes among spans of SPAN code points that start where
the text says. The likeness of two fingerprints is
the larger of (longest common beginning + longest common ending) / longer length, both found by binary search,
and the resemblance of the sampled spans.

Defined cases: a null text counts as empty; two empty texts have likeness 1, an empty and another text 0; a text
shorter than SPAN has itself as only span; null doc_ids come first, rows of equal doc_id are ordered by a hash of
their text; the only document is its own next; an empty table gives no rows; columns
besides doc_id and text are not read. A text of n code points takes about 100 n bytes while it is handled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from winback.llm.arrow import sliced
from winback.llm.common import LOWEST_LONG, bounds_at_or_below, id_and_text, long_array

PRIME = np.uint64(2**31 - 1)
BASES = (1_103_515_245, 1_812_433_253)
SHIFT = np.uint64(31)
#: beginnings and endings per doubling of the length, kept bits of their hashes as hex digits
PER_DOUBLING = 8
DIGITS = 6
#: code points of a sampled span, sampled spans of a fingerprint
SPAN = 16
SAMPLED = 64
#: keys sampled per range of documents
KEYS_PER_RANGE = 16


def reduced(values: np.ndarray) -> np.ndarray:
    """Values below 2^64 modulo the prime."""
    values = (values & PRIME) + (values >> SHIFT)
    values = (values & PRIME) + (values >> SHIFT)
    return np.where(values >= PRIME, values - PRIME, values)


class Powers:
    """Powers of a base and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.inverse = pow(base, -1, int(PRIME))
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, count: int) -> None:
        while len(self.up) < count:
            held = len(self.up)
            self.up = np.concatenate([self.up, reduced(self.up * np.uint64(pow(self.base, held, int(PRIME))))])
            self.down = np.concatenate([self.down, reduced(self.down * np.uint64(pow(self.inverse, held, int(PRIME))))])


POWERS = [Powers(base) for base in BASES]


@dataclass(frozen=True)
class PrefixHash:
    """Prefix arrays of one text, one per base; entry i belongs to the first i code points."""

    points: np.ndarray
    sums: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, text: str) -> PrefixHash:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32) + np.uint32(1)
        sums = []
        for powers in POWERS:
            powers.reach(len(points) + 1)
            terms = reduced(points.astype(np.uint64) * powers.up[: len(points)])
            # fewer than 2^33 terms below 2^31 cannot overflow
            sums.append(np.concatenate([np.zeros(1, np.uint64), reduced(np.cumsum(terms, dtype=np.uint64))]))
        return cls(points, (sums[0], sums[1]))

    def __len__(self) -> int:
        return len(self.sums[0]) - 1

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """62-bit hashes of spans; equal spans have equal hashes wherever they lie."""
        parts = [
            reduced(reduced(sums[ends] + PRIME - sums[starts]) * powers.down[starts])
            for sums, powers in zip(self.sums, POWERS, strict=True)
        ]
        return (parts[0] << SHIFT) | parts[1]

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def followed_by(self, other: PrefixHash, mine: int, others: int) -> PrefixHash:
        """The first ``mine`` code points, then the other's first ``others``, without reading a text again."""
        joined = []
        for sums, more, powers in zip(self.sums, other.sums, POWERS, strict=True):
            powers.reach(mine + others + 1)
            tail = reduced(more[1 : others + 1] * powers.up[mine])
            joined.append(np.concatenate([sums[: mine + 1], reduced(tail + sums[mine])]))
        return PrefixHash(np.concatenate([self.points[:mine], other.points[:others]]), (joined[0], joined[1]))


def common_extension(a: PrefixHash, at: int, b: PrefixHash, bt: int) -> int:
    """Length of the longest equal spans that start at ``at`` in a and ``bt`` in b."""
    low, high = 0, min(len(a) - at, len(b) - bt)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(at, at + middle) == b.span(bt, bt + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _lengths_up_to(limit: int) -> np.ndarray:
    steps = np.arange(0, PER_DOUBLING * max(limit, 1).bit_length() + 1)
    lengths = np.unique(np.floor(2.0 ** (steps / PER_DOUBLING)).astype(np.int64))
    return lengths[lengths <= limit]


GRID = _lengths_up_to(2**40)


def anchor_lengths(length: int) -> np.ndarray:
    """1, 2, 3, ... growing by a fixed factor, not above the length; the same grid for every text."""
    return GRID[: np.searchsorted(GRID, length, side="right")]


def _hex(values: np.ndarray, digits: int) -> str:
    """The low ``digits`` (an even number up to 8) of each value."""
    return values.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - digits // 2 :].tobytes().hex()


def span_starts(points: np.ndarray, last: int) -> np.ndarray:
    """About every eighth position up to ``last``, chosen by the two code points there; all if none is chosen."""
    pairs = points[: last + 1] * np.uint32(31)
    pairs[: len(points) - 1] += points[1 : last + 2]
    chosen = np.flatnonzero((pairs & np.uint32(7)) == 0)
    return chosen if len(chosen) else np.arange(last + 1)


def fingerprint(hashed: PrefixHash) -> str:
    """``length:whole:beginnings:endings:spans`` in hex."""
    length = len(hashed)
    lengths = anchor_lengths(length)
    nothing = np.zeros(len(lengths), np.int64)
    heads = hashed.spans(nothing, lengths)
    tails = hashed.spans(length - lengths, np.full(len(lengths), length))
    width = min(SPAN, length)
    starts = span_starts(hashed.points, length - width) if length else np.zeros(0, np.int64)
    # an odd multiplier spreads the hashes before the smallest are taken
    mixed = (hashed.spans(starts, starts + width) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    sampled = np.unique(mixed)[:SAMPLED]
    return f"{length:x}:{hashed.span(0, length):016x}:{_hex(heads, DIGITS)}:{_hex(tails, DIGITS)}:{_hex(sampled, 8)}"


def _common_anchor(a: str, b: str) -> int:
    """Longest grid length at which two anchor lists agree; equality at a length means equality below it."""
    low, high = 0, min(len(a), len(b)) // DIGITS
    while low < high:
        middle = (low + high + 1) // 2
        if a[(middle - 1) * DIGITS : middle * DIGITS] == b[(middle - 1) * DIGITS : middle * DIGITS]:
            low = middle
        else:
            high = middle - 1
    return int(GRID[low - 1]) if low else 0


def likeness(a: str, b: str) -> float:
    """0 (nothing in common) to 1 (equal), from two fingerprints alone."""
    if a == b:
        return 1.0
    (long_a, _, heads_a, tails_a, spans_a), (long_b, _, heads_b, tails_b, spans_b) = a.split(":"), b.split(":")
    shorter, longer = sorted((int(long_a, 16), int(long_b, 16)))
    if not shorter:
        return 0.0
    ends = min(shorter, _common_anchor(heads_a, heads_b) + _common_anchor(tails_a, tails_b)) / longer
    set_a, set_b = ({text[at : at + 8] for at in range(0, len(text), 8)} for text in (spans_a, spans_b))
    least = sorted(set_a | set_b)[:SAMPLED]
    return max(ends, sum(value in set_a and value in set_b for value in least) / len(least))


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_next(docs: DataFrame) -> DataFrame:
    """range, is_next, id_key, text_hash, doc_id, text; each range holds the first row after it too.

    Ranges of (doc_id, hash of the text, number of the row) hold about equal bytes by sampled splitters. The first row of each range is
    added to the range before it, the very first to the last, so texts are dealt once and
    no task needs its neighbour. The driver sees some keys per range, no text.
    """
    id_key = F.coalesce(F.col("doc_id"), F.lit(LOWEST_LONG))
    # the row's number only serves to cut a group of equal rows, whose order does not matter
    numbered = {"id_key": id_key, "text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    rows = docs.select(*id_and_text()).withColumns(numbered)
    key = [F.col("id_key"), F.col("text_hash"), F.col("row")]
    keys = rows.select(*key, (F.octet_length("text") + 1).alias("size"))
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = keys.agg(F.sum("size")).first()[0] or 1
    draw = F.xxhash64(*key, F.lit(3)) / F.lit(2.0**64) + 0.5
    picked = sorted(map(tuple, keys.filter(draw < F.col("size") * (KEYS_PER_RANGE * parts / total)).select(*key).collect()))
    splitters = sorted({picked[len(picked) * at // parts] for at in range(1, parts)}) if picked else []
    arrays = [long_array([split[part] for split in splitters]) for part in range(len(key))]
    own = rows.withColumns({"range": bounds_at_or_below(arrays, key, len(splitters)), "is_next": F.lit(0)})

    starts = own.drop("text").groupBy("range").agg(F.min(F.struct(*key)).alias("first")).orderBy("range").collect()
    if not starts:
        return own
    # one row per range: which text comes after its last
    after = [(*row["first"][:2], starts[at - 1]["range"]) for at, row in enumerate(starts)]
    firsts = F.broadcast(docs.sparkSession.createDataFrame(after, "id_key bigint, text_hash bigint, range int"))
    one = rows.join(firsts, ["id_key", "text_hash"], "left_semi").dropDuplicates(["id_key", "text_hash"])
    added = one.join(firsts, ["id_key", "text_hash"]).withColumn("is_next", F.lit(1))
    return own.unionByName(added.select(*own.columns))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and the text that has its second half replaced from the next document."""
    struct = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(struct)

    def row_of(doc_id, text: str, mine: PrefixHash, print_: str, next_text: str, other: PrefixHash, next_print: str) -> tuple:
        half = len(text) // 2
        taken = min(half, len(next_text))
        edited = text[: len(text) - half] + next_text[:taken]
        edited_print = fingerprint(mine.followed_by(other, len(text) - half, taken))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return doc_id, len(text), digest, print_, edited_print, likeness(print_, edited_print), likeness(print_, next_print)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # range, doc_id, text, prefix arrays and fingerprint of the row whose next is awaited
        for batch in sliced(batches, 200):
            done = []
            columns = [batch.column(name).to_pylist() for name in ("range", "is_next", "doc_id", "text")]
            for part, is_next, doc_id, text in zip(*columns, strict=True):
                hashed = PrefixHash.of(text)
                print_ = fingerprint(hashed)
                if last is not None and last[0] == part:
                    done.append(row_of(*last[1:], text, hashed, print_))
                last = None if is_next else (part, doc_id, text, hashed, print_)
            columns = zip(*done, strict=True) if done else [()] * len(arrow)
            arrays = [pa.array(column, field.type) for column, field in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    dealt = with_next(docs).repartition("range").sortWithinPartitions("range", "is_next", "id_key", "text_hash", "row")
    return dealt.select("range", "is_next", "doc_id", "text").mapInArrow(run, struct)
