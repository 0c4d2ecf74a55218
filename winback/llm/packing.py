"""Best-fit-decreasing packing of tokenised documents into sequences of fixed capacity.

Documents are tokenised by Spark tasks and cut into pieces only where they are longer than a sequence. What the
packing needs of the corpus is how many pieces there are of each length, at most ``capacity`` numbers.
From these the plan is made on the driver: lengths in falling order, each piece into the tightest open
sequence that holds it, found in a segment tree over remaining capacities. Pieces of equal length are
interchangeable, and so are sequences of equal remaining capacity. So a run of equal placements is one step
and the plan's size is bounded by the capacity and does not follow the corpus. Pieces get their number within their length
by counting in buckets, and from it their sequence and offset.

Defined cases: a null or empty text is a piece with the end id alone; repeated rows are packed one by one; null
doc_ids are packed like others; an empty table gives no rows; a special token's name in a text is ordinary
text; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from winback.llm.arrow import kept_by_worker, return_freed, sliced, sliced_by_bytes, small_batches, tidied
from winback.llm.common import id_and_text, stored

CAPACITY = 1024
END_ID = 2
#: bytes of text that a task handles at a time (one text at least)
TEXT_BYTES = 2_000_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


# --- tokens and pieces ----------------------------------------------------------------------


#: white space other than single blanks and line feeds between words, as regular expressions of Arrow's engine
ODD_SPACE = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \n][ \n]|\A[ \n]|[ \n]\z"
)


#: sets the digests of words after a blank apart
AFTER_BLANK = np.uint64(0x9E3779B97F4A7C15)


#: marks that a word often ends in, and the letters of two bytes that all begin with LATIN
MARKS, LATIN, NO_LETTERS = np.frombuffer(b".,;:!?", np.uint8), 0xC3, np.array([0x97, 0xB7], np.uint8)


def marked(words: pa.LargeBinaryArray) -> np.ndarray:
    """Which words are a letter, or more that ends in one, and one mark after it.

    The pre-tokeniser always cuts between the two. Letters are those of ASCII and Latin-1 here; other words stay whole.
    """
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    text = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    lengths, ends = np.diff(ends), ends[1:]
    found = np.flatnonzero(lengths > 1)
    found = found[np.isin(text[ends[found] - 1], MARKS)]
    last = text[ends[found] - 2]
    letter = ((last | 0x20) >= ord("a")) & ((last | 0x20) <= ord("z"))
    long_ = lengths[found] > 2
    latin = (text[ends[found] - 2 - long_] == LATIN) & long_ & ~np.isin(last, NO_LETTERS) & (last >= 0x80)
    result = np.zeros(len(words), bool)
    result[found[letter | latin]] = True
    return result


def digests(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of words, as their high and low halves."""
    from xxhash import xxh3_128_digest

    high, low = np.frombuffer(b"".join(map(xxh3_128_digest, words)), ">u8").astype(np.uint64).reshape(-1, 2).T
    return high, low


class Encoder:
    """Ids of whole texts, each distinct word encoded once.

    In a byte-level pre-tokeniser of this kind a blank belongs to the word after it, and a single line feed between two
    words is a token of its own. So a text whose white space is only single blanks and line
    feeds can be taken apart there and its ids are those of its words. Words are encoded many at a time, joined by
    line feeds, and told apart by the line feed's id. Any other text is encoded as a whole.

    A mark after a word, such as a comma, is a word of its own, so that the word is the same with and without it.

    What is remembered lies in flat arrays, without an object per word: the ids of all words one after the other, where
    each word's begin, and the words' 128-bit digests in order. The line feed is the word numbered 0. New words are put
    into one array after the other, so that at no time all arrays are there twice. When too many are remembered, those
    stay that were met again.
    """

    JOINED = 1000
    #: characters from which on whole texts go to the tokenizer
    ENCODED = 100_000
    #: words and ids remembered, 29 bytes a word and 4 an id; beyond either those not met again are forgotten
    REMEMBERED = 1_000_000
    REMEMBERED_IDS = 6_000_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        (self.feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.ids = np.array([self.feed], np.uint32)
        self.starts, self.counts = np.zeros(1, np.int32), np.ones(1, np.int32)
        # digests in order, and the number of the word each belongs to
        self.high, self.low = digests([b"\n"])
        self.numbers = np.zeros(1, np.int32)
        self.again = np.zeros(1, bool)  # by number: met in a later slice of texts than the one that brought it

    def forget_rare(self) -> None:
        """Forget the words that were not met again, and all if that leaves more than half of what may be remembered."""
        self.again[0] = True
        kept = np.flatnonzero(self.again)
        if len(kept) > self.REMEMBERED // 2 or self.counts[kept].sum() > self.REMEMBERED_IDS // 2:
            self.forget()
            return
        self.ids = gathered(self.ids, self.starts, self.counts, kept)
        self.counts = self.counts[kept]
        self.starts = (np.cumsum(self.counts) - self.counts).astype(np.int32)
        stays = self.again[self.numbers]
        self.high, self.low = self.high[stays], self.low[stays]
        self.numbers = (np.cumsum(self.again) - 1).astype(np.int32)[self.numbers[stays]]
        self.again = np.zeros(len(kept), bool)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text.

        The tokenizer holds over a hundred bytes a token until they are read, so it gets few texts at a time.
        """
        parts, held, size = [np.zeros(0, np.uint32)], [], 0
        for at, text in enumerate(texts):
            held.append(text)
            size += len(text)
            if size >= self.ENCODED or at == len(texts) - 1:
                parts += [np.array(encoded.ids, np.uint32) for encoded in self.tokenizer.encode_batch_fast(held, add_special_tokens=False)]
                held, size = [], 0
        return np.concatenate(parts), np.array([len(part) for part in parts[1:]], np.int64)

    def _find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The numbers of known words, -1 for others."""
        at = np.minimum(np.searchsorted(self.high, high), len(self.high) - 1)
        return np.where((self.high[at] == high) & (self.low[at] == low), self.numbers[at], -1)

    def _learn(self, words: list[bytes], high: np.ndarray, low: np.ndarray, lead: bytes) -> None:
        """Encode new words, each given once; ``lead`` stands before each."""
        parts, counts = [self.ids], []
        for at in range(0, len(words), self.JOINED):
            part = words[at : at + self.JOINED]
            joined = (lead + (b"\n" + lead).join(part) + b"\n").decode()
            (encoded,) = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
            ids = np.array(encoded.ids, np.uint32)
            ends = np.flatnonzero(ids == self.feed)
            counts.append(np.diff(ends, prepend=-1) - 1)
            parts.append(ids[ids != self.feed])
        number, counts = len(self.counts), np.concatenate(counts)
        self.starts = np.concatenate([self.starts, (len(self.ids) + np.cumsum(counts) - counts).astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        self.ids = np.concatenate(parts)
        order = np.argsort(high, kind="stable")
        at = np.searchsorted(self.high, high[order])
        self.high, self.low = np.insert(self.high, at, high[order]), np.insert(self.low, at, low[order])
        self.numbers = np.insert(self.numbers, at, (number + order).astype(np.int32))
        self.again = np.concatenate([self.again, np.zeros(len(words), bool)])

    def words(self, words: list[bytes], after_blank: bool) -> np.ndarray:
        """The numbers of words without white space, as they stand or with a blank before them."""
        high, low = digests(words)
        # a seed for the form would not do: short words differ by it as little as by a letter
        high = high ^ (AFTER_BLANK if after_blank else np.uint64(0))
        found = self._find(high, low)
        new = np.flatnonzero(found < 0)
        self.again[found[found >= 0]] = True
        if len(new):
            once, first, back = np.unique(np.stack([high[new], low[new]]), axis=1, return_index=True, return_inverse=True)
            number = len(self.counts)
            self._learn([words[at] for at in new[first].tolist()], *once, b" " if after_blank else b"")
            found[new] = number + back.ravel()
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of any texts one after the other, and how many each has."""
        odd = pc.or_(pc.match_substring_regex(texts, ODD_SPACE), pc.equal(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)
        ids, counts = self._by_words(texts.filter(pa.array(~odd)))
        if not odd.any():
            return ids, counts
        odd_ids, odd_counts = self.whole(texts.filter(pa.array(odd)).to_pylist())
        order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        counts = np.concatenate([counts, odd_counts])
        return gathered(np.concatenate([ids, odd_ids]), np.cumsum(counts) - counts, counts, order), counts[order]

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.counts) > self.REMEMBERED or len(self.ids) > self.REMEMBERED_IDS:
            self.forget_rare()
        lines = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " \n"), " ")
        coded = lines.values.dictionary_encode()
        offsets = lines.offsets.to_numpy() - lines.offsets[0].as_py()
        used = coded.indices.to_numpy()
        heads = offsets[:-1]
        # each distinct word in two forms: as it stands, and after a blank
        fed = pc.starts_with(coded.dictionary, "\n").to_numpy(zero_copy_only=False)
        plain = fed.copy()
        plain[used[heads]] = True
        bare = pc.utf8_ltrim(coded.dictionary, "\n").cast(pa.large_binary())
        has_mark = marked(bare)
        marks = pc.binary_slice(bare.filter(pa.array(has_mark)), -1).to_pylist()
        mark = np.zeros(len(fed), np.int32)
        mark[has_mark] = self.words(marks, False)
        stems = pc.if_else(pa.array(has_mark), pc.binary_slice(bare, 0, -1), bare).dictionary_encode()
        stem = stems.indices.to_numpy()
        form = np.zeros((2, len(stems.dictionary)), np.int32)
        for kind, asked in enumerate((plain, ~fed)):
            chosen = np.zeros(form.shape[1], bool)
            chosen[stem[asked]] = True
            form[kind, chosen] = self.words(stems.dictionary.filter(pa.array(chosen)).to_pylist(), bool(kind))
        first = np.zeros(len(used), bool)
        first[heads] = True
        after_feed, before_mark = fed[used], has_mark[used]
        forms = np.where(first | after_feed, form[0][stem][used], form[1][stem][used])
        # a line feed, number 0, stands before each word that follows one, a mark after its word
        ends = np.cumsum(1 + after_feed.astype(np.int32) + before_mark)
        sequence = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        sequence[ends - 1 - before_mark] = forms
        marks = mark[used[before_mark]]
        sequence[ends[before_mark] - 1] = marks
        taken = self.counts[forms] + after_feed
        taken[before_mark] += self.counts[marks]
        totals = np.concatenate([[0], np.cumsum(taken)])
        return gathered(self.ids, self.starts, self.counts, sequence), np.diff(totals[offsets])


def gathered(values: np.ndarray, starts: np.ndarray, counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Runs of ``values`` (run i begins at ``starts[i]`` and has ``counts[i]`` of them) in the given order."""
    taken = counts[order]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(len(values), total) < 2**31 else np.int64  # of the largest arrays here
    at = np.repeat((starts[order] - (ends - taken)).astype(kind), taken)
    at += np.arange(total, dtype=kind)
    return values[at]


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of the pieces of documents: all are full but a document's first."""
    pieces = -(-lengths // capacity)
    document = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = ((lengths - 1) % capacity + 1)[document]
    start = np.where(number > 0, first + (number - 1) * capacity, 0)
    return document, number, start, np.where(number > 0, capacity, first)


def tokenise(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves if asked for."""
    schema = StructType.fromDDL(PIECES + (", ids array<bigint>" if with_ids else ""))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        encoder = kept_by_worker(("encoder", tokenizer), lambda: Encoder(tokenizer))
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            ids, counts = encoder.texts(batch.column("text"))
            # arrays that grew were copied; their old places would stay with the worker
            return_freed()
            flat = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            document, number, start, length = cut(counts + 1, capacity)
            # pieces lie one after the other
            ends = np.cumsum(length)
            view = memoryview(flat).cast("B")
            sums = [zlib.crc32(view[4 * begin : 4 * end]) for begin, end in zip((ends - length).tolist(), ends.tolist(), strict=True)]
            columns = [batch.column("doc_id").take(pa.array(document)), *map(pa.array, (number, start, length, sums))]
            if with_ids:
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64))))
            yield pa.RecordBatch.from_arrays([column.cast(field.type) for column, field in zip(columns, arrow, strict=True)], schema=arrow)

    return small_batches(docs).select(*id_and_text()).mapInArrow(tidied(run), schema)


# --- the plan -------------------------------------------------------------------------------


class CapacityTree:
    """Which remaining capacities some open sequence has: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, remaining: int, count: int) -> None:
        at = self.leaves + remaining
        while at:
            self.counts[at] += count
            at //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need``."""
        at = self.leaves + need
        if self.counts[at]:
            return need
        while at > 1 and (at % 2 or not self.counts[at + 1]):  # up, until a right neighbour holds something
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        return at - self.leaves


@dataclass
class Plan:
    """Runs of equal placements.

    The pieces of ``length`` numbered from ``rank`` on go ``each`` to a sequence, from sequence ``first`` on,
    starting at offset ``offset``.
    """

    sequences: int = 0
    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)

    def add(self, length: int, rank: int, each: int, first: int, offset: int) -> None:
        for column, value in zip((self.length, self.rank, self.each, self.first, self.offset), (length, rank, each, first, offset), strict=True):
            column.append(value)


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Place every piece of each length (``counts``) into the tightest open sequence, longest first."""
    plan, tree = Plan(), CapacityTree(capacity)
    open_: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # remaining -> (first sequence, how many)

    def put(remaining: int, first: int, count: int) -> None:
        if count:
            open_[remaining].append((first, count))
            tree.add(remaining, count)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                fresh = -(-left // (capacity // length))
                put(capacity, plan.sequences, fresh)
                plan.sequences += fresh
                continue
            # a sequence that took one piece is the tightest for the next as long as it fits
            each = remaining // length
            first, count = open_[remaining].popleft()
            tree.add(remaining, -count)
            full = min(count, left // each)
            if full:
                plan.add(length, rank, each, first, capacity - remaining)
                put(remaining - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            used = full
            if left and used < count:  # fewer than ``each`` are left: they share one sequence
                plan.add(length, rank, each, first + used, capacity - remaining)
                put(remaining - left * length, first + used, 1)
                rank, left, used = rank + left, 0, used + 1
            put(remaining, first + used, count - used)
    return plan


# --- placing --------------------------------------------------------------------------------


def numbered(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0, without gaps, as ``rank``.

    ``pieces`` have a stored number each, ``row``. A length that very many pieces have, equal or not, is spread over buckets by
    it; each bucket numbers its own from the count of those before it.
    """
    buckets = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    starts = counts.select("length", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_rank"))
    own = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = dealt.withColumn("place", F.row_number().over(own) - 1).join(starts, ["length", "bucket"])
    return ranked.withColumn("rank", F.col("first_rank") + F.col("place")).drop("first_rank", "place", "bucket", "row")


def place(pieces: DataFrame, plan: Plan, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to numbered pieces."""
    length, rank, each, first, offset = (np.array(column, np.int64) for column in (plan.length, plan.rank, plan.each, plan.first, plan.offset))
    order = np.lexsort((rank, length))
    length, rank, each, first, offset = length[order], rank[order], each[order], first[order], offset[order]
    begins = np.searchsorted(length, np.arange(capacity + 2))  # runs of length n are begins[n]:begins[n + 1]
    schema = StructType.fromDDL(PACKED)
    names = [field.name for field in StructType.fromDDL(PIECES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 100_000):
            mine, number = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.empty(len(mine), np.int64)
            for value in np.unique(mine):
                own, low, high = mine == value, begins[value], begins[value + 1]
                at[own] = low + np.searchsorted(rank[low:high], number[own], side="right") - 1
            past = number - rank[at]
            columns = [batch.column(name) for name in names]
            columns += [pa.array(first[at] + past // each[at]), pa.array(offset[at] + past % each[at] * mine)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pieces.select(*names, "rank").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(tokenise(docs, tokenizer, capacity, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    return place(numbered(pieces), best_fit_decreasing(counts, capacity), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (at most ``capacity``) and doc_ids in order.

    Texts are tokenised a second time instead of being kept beside their pieces.
    """
    packed = pack(docs, tokenizer, capacity, end_id)
    ids = tokenise(docs, tokenizer, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids_crc32", "ids")
    # of repeated rows any copy of the ids serves
    once = ids.dropDuplicates(["doc_id", "piece", "ids_crc32"])
    key = [packed["doc_id"].eqNullSafe(once["doc_id"]), packed["piece"] == once["piece"], packed["ids_crc32"] == once["ids_crc32"]]
    parts = packed.join(once, key).select("sequence_id", F.struct("offset", packed["doc_id"], "ids").alias("part"))
    ordered = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return ordered.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
