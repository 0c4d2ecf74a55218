"""Ranked lexical search by presence-mask grouping.

For each item of a query table the best-scoring documents are found, with integer scores: a term of weight
w = floor(1000 ln((2 N + 2) / (2 df + 1))) adds w * ((10^9 tf) div (1000 tf + 8 m)) for each time the item holds it, where m
grows with the document's length (``Scale``).

1. One pass over the texts keeps, per document, its number of terms and the counts of the terms that some item holds.
   Corpus counts (N, L, df) are sums over these narrow rows.
2. A task takes its documents in blocks. For an item, every matching document gets a bitmap with one bit per distinct
   term of the item, set term by term over the block. Documents with equal bitmaps form a group. The highest score a group
   can reach is the sum over its bits of the item's weight times the largest part of that term in the block.
3. Groups are evaluated in falling order of that bound, a few at a time, until the next bound is below the k-th
   score found so far in the task; a group with an equal bound may still win by its doc_id and is evaluated. What a task
   keeps from block to block is k rows per item, and these meet in one ranking per item.

Items are handled in blocks of at most ITEMS_BYTES of text (one item at least), each with a pass of its own, so that what
the driver and the tasks hold of the items is bounded.

Defined cases: a null or empty text has no terms; a document without terms counts neither for N nor L; items without terms
have no rows; items that repeat an item_id, and items without one, are ranked each by itself; repeated documents are
ranked one by one; equal scores are ordered by doc_id, nulls last; empty tables give no rows; columns besides doc_id, item_id
and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.arrow import sliced, sliced_by_bytes, small_batches
from winback.llm.common import id_and_text, stored, text_or_empty

#: bytes of text that a task handles at a time (one text at least)
TEXT_BYTES = 8_000_000
#: bytes of item text that are searched in one pass
ITEMS_BYTES = 4_000_000
#: documents whose bitmaps are grouped together
BLOCK = 8192
#: rows of one task that are ranked first among themselves
RANKED_TOGETHER = 64

#: ASCII other than letters and digits parts terms; A-Z are lowered; bytes of other characters stay
SEPARATORS = [at for at in range(128) if not chr(at).isalnum()]
TRANSLATE = bytes(32 if at in SEPARATORS else at + 32 if 65 <= at <= 90 else at for at in range(256))


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms one after the other, and how many each text has."""
    # a copy of its own: buffers of a slice hold its neighbours too
    texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    cleaned = pa.py_buffer((data.to_pybytes() if data else b"").translate(TRANSLATE))
    split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), offsets, cleaned))
    terms = split.flatten()
    owners = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    filled = np.flatnonzero(pc.binary_length(terms).to_numpy())
    return terms.take(pa.array(filled)), np.bincount(owners[filled], minlength=len(texts)).astype(np.int64)


@dataclass(frozen=True)
class Scale:
    """Corpus counts: documents with a term, all their terms."""

    docs: int
    terms: int

    def m(self, lengths: np.ndarray) -> np.ndarray:
        """The length factor of documents with so many terms, in integers."""
        if 75 * self.docs * int(lengths.max(initial=0)) < 2**63:
            return 25 + (75 * lengths * self.docs) // max(self.terms, 1)
        return np.array([25 + (75 * length * self.docs) // max(self.terms, 1) for length in lengths.tolist()], np.int64)

    def weight(self, document_frequency: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * document_frequency + 1)))


@dataclass(frozen=True)
class Items:
    """A block of items: row, item_id, and the numbers of their distinct terms with repeats."""

    rows: list[int]
    ids: list[int | None]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: pa.Array

    @classmethod
    def of(cls, rows: list[tuple[int, int | None, str]]) -> Items:
        terms, counts = terms_of(pa.array([text for _, _, text in rows], pa.large_string()))
        coded = terms.dictionary_encode()
        codes, at, found = coded.indices.to_numpy(), 0, []
        for count in counts.tolist():
            found.append(np.unique(codes[at : at + count], return_counts=True))
            at += count
        return cls([row[0] for row in rows], [row[1] for row in rows], [f[0] for f in found], [f[1] for f in found], coded.dictionary)


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """Items in blocks of bounded size; the driver holds one block at a time."""
    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("bigint").alias("item_id"), text_or_empty().alias("text"))
    block, held = [], 0
    for row in stored(rows, "items").toLocalIterator():
        size = len(row["text"].encode()) + 1
        if block and held + size > ITEMS_BYTES:
            yield Items.of(block)
            block, held = [], 0
        block.append(tuple(row))
        held += size
    if block:
        yield Items.of(block)


POSTINGS = "doc_id bigint, n_terms bigint, terms binary, counts binary"


def postings(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Per document: doc_id, n_terms, and the vocabulary's terms it holds (numbers, ascending) with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            terms, lengths = terms_of(batch.column("text"))
            coded = terms.dictionary_encode()
            known = pc.fill_null(pc.index_in(coded.dictionary, value_set=vocabulary), -1).to_numpy().astype(np.int64)
            codes = known[coded.indices.to_numpy()] if len(coded.dictionary) else np.zeros(0, np.int64)
            owners = np.repeat(np.arange(len(lengths)), lengths)
            wanted = codes >= 0
            width = max(len(vocabulary), 1)
            keys, counts = np.unique(owners[wanted] * width + codes[wanted], return_counts=True)
            limits = np.searchsorted(keys, np.arange(len(lengths) + 1) * width).tolist()
            numbers, counts = (keys % width).astype(np.uint32), counts.astype(np.uint32)
            parts = [slice(a, b) for a, b in zip(limits[:-1], limits[1:], strict=True)]
            columns = [batch.column("doc_id"), pa.array(lengths)]
            columns += [pa.array([values[part].tobytes() for part in parts], pa.binary()) for values in (numbers, counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_terms", "terms", "counts"])

    return small_batches(docs).select(*id_and_text()).mapInArrow(run, POSTINGS)


def document_frequencies(held: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is; added up in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "docs"])

    counted = held.select("terms").mapInArrow(run, "term bigint, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
    found = np.zeros(size, np.int64)
    for row in counted.collect():  # one row per term of a block of items at most
        found[row["term"]] = row["docs"]
    return found


class Block:
    """Documents of a task: their terms by document and by term, with the part of the score that hangs on the document."""

    def __init__(self, batch: pa.RecordBatch, scale: Scale) -> None:
        self.doc_ids = batch.column("doc_id").to_pylist()
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint32).astype(np.int64)
        self.terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.uint32).astype(np.int64)
        sizes = pc.binary_length(batch.column("terms")).to_numpy() // 4
        self.limits = np.concatenate([[0], np.cumsum(sizes)])
        owners = np.repeat(np.arange(len(sizes)), sizes)
        self.parts = (1_000_000_000 * counts) // (1000 * counts + 8 * scale.m(batch.column("n_terms").to_numpy())[owners])
        order = np.argsort(self.terms, kind="stable")
        self.by_term = owners[order]
        self.present, starts = np.unique(self.terms[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.most = np.maximum.reduceat(self.parts[order], starts) if len(order) else np.zeros(0, np.int64)

    def groups(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents ordered by group, where groups begin, and the groups' bounds; highest bound first.

        The bitmap of a document has one bit for each of ``terms``.
        """
        at = np.searchsorted(self.present, terms)
        at[at == len(self.present)] = 0
        held = self.present[at] == terms if len(self.present) else np.zeros(len(terms), bool)
        at, most = at[held], weights[held]
        lanes = max(1, -(-len(at) // 64))
        masks = np.zeros((lanes, len(self.doc_ids)), np.uint64)
        for bit, index in enumerate(at.tolist()):
            masks[bit // 64][self.by_term[self.starts[index] : self.starts[index + 1]]] |= np.uint64(1 << (bit % 64))
        docs = np.flatnonzero(masks.any(axis=0))
        order = docs[np.lexsort(masks[:, docs])]
        ordered = np.ascontiguousarray(masks[:, order].T)
        new = np.ones(len(order), bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        bits = np.unpackbits(ordered[starts].view(np.uint8), axis=1, bitorder="little")[:, : len(at)]
        bounds = bits.astype(np.int64) @ (most * self.most[at])
        falling = np.argsort(-bounds, kind="stable")
        sizes = np.diff(np.append(starts, len(order)))
        lists = np.split(order, starts[1:]) if len(starts) else []
        docs = np.concatenate([lists[index] for index in falling.tolist()]) if lists else order
        return docs, np.concatenate([[0], np.cumsum(sizes[falling])]), bounds[falling]

    def scores(self, docs: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of documents that hold a term each."""
        starts, ends = self.limits[docs], self.limits[docs + 1]
        sizes = ends - starts
        before = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])
        return np.add.reduceat(weight_of[self.terms[at]] * self.parts[at], before[:-1])


def _best(found: list[tuple[int, int | None]], keep: int) -> list[tuple[int, int | None]]:
    """The ``keep`` best of (score, doc_id)."""
    return sorted(found, key=lambda row: (-row[0], row[1] is None, row[1] or 0))[:keep]


def search_block(block: Block, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, best: list[tuple[int, int | None]], keep: int) -> list:
    """``best`` (score, doc_id) after the documents of a block; ``weight_of`` holds ``weights`` by term number."""
    docs, limits, bounds = block.groups(terms, weights)
    at, step = 0, 2 * keep
    while at < len(bounds):
        least = best[-1][0] if len(best) == keep else 1
        if bounds[at] < least:
            break  # no later group reaches the k-th score
        # groups that may still matter, until some more documents are in hand
        stop = min(max(at + 1, int(np.searchsorted(limits, limits[at] + step))), int(np.searchsorted(-bounds, -least, side="right")))
        chosen = docs[limits[at] : limits[stop]]
        scored = zip(block.scores(chosen, weight_of).tolist(), chosen.tolist(), strict=True)
        best = _best(best + [(score, block.doc_ids[doc]) for score, doc in scored if score >= least], keep)
        at, step = stop, 2 * step
    return best


def search_items(docs: DataFrame, items: Items, keep: int) -> DataFrame:
    """item_row, item_id, doc_id and score of the best of each task."""
    size = len(items.vocabulary)
    held = stored(postings(docs, items.vocabulary), "postings")
    totals = held.agg(F.count_if(F.col("n_terms") > 0).alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
    scale = Scale(totals["docs"], totals["terms"])
    weights = np.array([scale.weight(count) for count in document_frequencies(held, size).tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in items.rows]
        weight_of = np.zeros(size, np.int64)
        for batch in sliced(batches, BLOCK):
            block = Block(batch, scale)
            for at, (terms, repeats) in enumerate(zip(items.terms, items.repeats, strict=True)):
                mine = weights[terms] * repeats
                weight_of[terms] = mine
                best[at] = search_block(block, terms, mine, weight_of, best[at], keep)
                weight_of[terms] = 0
        rows = [(items.rows[at], items.ids[at], doc_id, score) for at, found in enumerate(best) for score, doc_id in found]
        columns = [pa.array([row[part] for row in rows], pa.int64()) for part in range(4)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_row", "item_id", "doc_id", "score"])

    return held.filter("octet_length(terms) > 0").mapInArrow(run, "item_row bigint, item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, keep: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the ``keep`` best documents of each item, scores above 0 only."""
    found = [stored(search_items(docs, block, keep), "found") for block in item_blocks(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = F.desc("score"), F.asc_nulls_last("doc_id")
    # an item has k rows per task; they are ranked in groups of tasks before they meet
    together = rows.withColumn("part", F.floor(F.spark_partition_id() / RANKED_TOGETHER))
    first = Window.partitionBy("item_row", "part").orderBy(*order)
    left = together.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= keep).drop("rank", "part")
    last = Window.partitionBy("item_row").orderBy(*order)
    ranked = left.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= keep)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
