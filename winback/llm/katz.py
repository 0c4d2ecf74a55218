"""A bigram language model with Katz backoff over an open vocabulary.

Tokens are words and one end per text. Training counts all of them over all training texts, and every training word has its own
pairs. A text starts after BEGIN_HASH. Words are told apart by 64-bit hashes, pairs by two of them. Tables:

* ``order=1``: each word's count, its Good-Turing discounted chance, and the backoff weight alpha of what follows it. What the
  discounts leave is the chance of an unknown word.
* ``order=2``: each pair's count, and in ``rare`` the counts of its words that are not broadcast, both bucketed by the place of its context. A context has one place, or several, among which its words
  are dealt, if it has more than 1/SPREAD of all tokens; so no bucket holds a busy context, and all that is known of a context
  meets its pairs without moving them. A pair's gain, by how much the logarithm of its discounted chance exceeds that of backing
  off, is made when it is read.
* ``contexts``: each context's alpha, and what its discounted counts are divided by. What the discounts of a context leave
  is shared by the words not seen after it, in proportion to their unigram chance; alpha follows from the exact
  sums, so chances add up to one.

Chances are evaluated recursively: pair, else alpha(context) times the word's chance. A word that no training text has is
followed by anything at its unigram chance. Words with at least CACHED of all tokens, a bounded number, are broadcast to the tasks
that count pairs, which write the word's count beside the pair; pairs of other words get it through a join by word, once.

Scoring needs for each word and pair its row of the tables. Those with at least CACHED of all tokens are
broadcast. All others are asked for: in one pass over the texts a task emits what it knows of each text, and a row (text, place,
word, times) for each question; these go to the buckets of the pairs, are answered there and summed by text. No key that is asked
for has more than CACHED of the tokens, so this join has no hot keys. Texts are told apart by a number of their row. A question
for a word alone has a place made from the word.

Questions take more room than texts, so they are asked in several parts, one after the other, each with the files of its own
questions only: a part is a range of places, and all places of a context lie in the range of the context itself. Texts are read
once for each part; the sums of the parts meet by doc_id and a hash of the text, so a table need not give its rows in the same order again.

Defined cases: a null text counts as empty and is an end alone; with no training text every word is unknown, and it and
the end have chance 1; discounts that the counts of counts do not support (too few texts) are (r - 0.5) / r; a context whose discounts leave
nothing gives its count one more, unseen, event; repeated rows are scored one by one; a null doc_id is an id
like others; columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm.arrow import sliced_by_bytes, small_batches, tidied
from winback.llm.common import id_and_text, release, releasing, shared_path, stored
from winback.llm.words import coded_words

#: least share of all training tokens of a word or pair that is broadcast for scoring
CACHED = 2.5e-7
#: counts up to this are discounted
DISCOUNTED = 5
TEXT_BYTES = 8_000_000
#: distinct keys a task holds before it hands its counts on
HELD = 2_000_000
#: rows that a task hands on at a time
TOLD_ROWS = 200_000
#: a context with more than 1/SPREAD of the tokens has several places
SPREAD = 5000
#: tokens of a bucket of pairs, and the most buckets Spark allows
BUCKET_TOKENS, MOST_BUCKETS = 2_000_000, 100_000

#: hash of the end token; no word is a line feed
END_HASH = 0x9C0A5F1E3D7B2846
#: hash of the context of a text's first token
BEGIN_HASH = 0x2B7E151628AED2A6
#: from a word's hash to the place where it is asked for alone
ALONE = 0x3C6EF372FE94F82B
#: from one place of a context to the next; SPREAD + 1 of them stay below 2 ** 63
STEP = 0x9E3779B97F4A
#: the least place of each part of the questions, multiples of 2 ** 61 (steps change no bit from 2 ** 60 on)
PARTS = (-(2**63), 0)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words and of the end, which of them all tokens are, and the number of tokens of each text."""
    words, codes, counts = coded_words(texts)
    keys = np.append(words, np.uint64(END_HASH)).view(np.int64)
    return keys, np.insert(codes, np.cumsum(counts), len(words)), counts + 1


def part_of(places: np.ndarray) -> np.ndarray:
    """The part of the questions that places, or contexts, belong to."""
    return np.searchsorted(np.array(PARTS), places, side="right") - 1


def in_part(place: Column, part: int) -> Column:
    above = place >= F.lit(PARTS[part])
    return above & (place < F.lit(PARTS[part + 1])) if part + 1 < len(PARTS) else above


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all words, combined within the task."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "count"])

    for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
        new, tokens, _ = tokens_of(batch.column("text"))
        times = np.bincount(tokens, minlength=len(new))
        new, times = new[times > 0], times[times > 0]
        merged, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, times]), len(merged)).astype(np.int64)
        keys = merged
        if len(keys) > HELD:
            yield told()
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys):
        yield told()


def discounts(counts_of_counts: dict[int, int]) -> np.ndarray:
    """Factor for the counts 0..DISCOUNTED + 1: Good-Turing as Katz scales it, for counts up to DISCOUNTED."""
    n = [counts_of_counts.get(r, 0) for r in range(DISCOUNTED + 2)]
    factors = np.array([0.0] + [(r - 0.5) / r for r in range(1, DISCOUNTED + 1)] + [1.0])
    if all(n[1:]):
        left = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
        turing = [((r + 1) * n[r + 1] / (r * n[r]) - left) / (1 - left) if left != 1 else 0 for r in range(1, DISCOUNTED + 1)]
        if left < 1 and all(0 < factor < 1 for factor in turing):
            factors[1 : DISCOUNTED + 1] = turing
    return factors


def _counts_of_counts(table: DataFrame) -> dict[int, int]:
    rows = table.filter(F.col("count") <= DISCOUNTED + 1).groupBy("count").agg(F.count(F.lit(1)).alias("n")).collect()
    return {row["count"]: row["n"] for row in rows}


def _numbers(frame: DataFrame) -> list[np.ndarray]:
    """Columns of a table of bounded size, sorted by the first."""
    table = frame.toArrow()
    columns = [table.column(name).to_numpy() for name in frame.columns]
    order = np.argsort(columns[0], kind="stable")
    return [column[order] for column in columns]


def looked_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each wanted key in the sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool))


@dataclass(frozen=True)
class Places:
    """The places of contexts: one, the context itself, or several for the busy ones."""

    contexts: np.ndarray  # sorted, those with several places
    numbers: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, counts: np.ndarray, tokens: int) -> Places:
        """From the counts of all words with more than 1/SPREAD of the tokens, sorted by word."""
        contexts = np.where(words == np.uint64(END_HASH).astype(np.int64), BEGIN_HASH, words)  # as many begins as ends
        numbers = counts * SPREAD // max(tokens, 1) + 1
        order = np.argsort(contexts, kind="stable")
        order = order[numbers[order] > 1]
        return cls(contexts[order], numbers[order])

    def find(self, keys: np.ndarray, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The place of each pair; contexts and words are numbers of ``keys``."""
        at, several = looked_up(self.contexts, keys)
        numbers = np.ones(len(keys), np.uint64)
        numbers[several] = self.numbers[at[several]]
        places = keys[contexts]
        busy = np.flatnonzero(several[contexts])
        places[busy] ^= (keys[words[busy]].view(np.uint64) % numbers[contexts[busy]]).astype(np.int64) * STEP
        return places

    def table(self, spark: SparkSession) -> DataFrame:
        """context and place of the busy ones; at most 2 * SPREAD rows."""
        found = zip(self.contexts.tolist(), self.numbers.tolist(), strict=True)
        rows = [(context, context ^ part * STEP) for context, number in found for part in range(number)]
        contexts, places = zip(*rows, strict=True) if rows else ((), ())
        # rows given as Python objects would start workers of another kind on the executors
        return F.broadcast(spark.createDataFrame(pa.table({"context": pa.array(contexts, pa.int64()), "place": pa.array(places, pa.int64())})))


@dataclass(frozen=True)
class Katz:
    """A trained model: totals, bounded arrays of the broadcast rows (sorted by key), and where its tables are."""

    path: str
    pairs: str  # name of the table of pairs
    buckets: int
    places: Places
    tokens: int
    distinct: int
    total: float  # what discounted counts of words are divided by
    unknown: float
    begin_alpha: float
    least: float  # counts from here on are broadcast
    word_factors: np.ndarray
    pair_factors: np.ndarray
    word_keys: np.ndarray
    word_counts: np.ndarray
    word_chances: np.ndarray
    word_alphas: np.ndarray
    pair_keys: np.ndarray  # places and words mixed
    pair_places: np.ndarray
    pair_words: np.ndarray
    pair_gains: np.ndarray

    def drop(self, spark: SparkSession) -> None:
        """Remove the tables and their files."""
        _drop(spark, self.pairs, self.path)


def rare_of(pairs: str) -> str:
    """The table of counts of the words that are not broadcast, for each pair that ends in one."""
    return pairs + "_rare"


def _drop(spark: SparkSession, pairs: str, path: str) -> None:
    for name in (pairs, rare_of(pairs)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def pairs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of distinct tokens and BEGIN_HASH, which of them all tokens and their contexts are, and the tokens of each text."""
    keys, tokens, counts = tokens_of(texts)
    contexts = np.roll(tokens, 1)
    contexts[np.cumsum(counts) - counts] = len(keys)
    return np.append(keys, BEGIN_HASH), tokens, contexts, counts


def mixed(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One number for a pair; only a place to look at, both parts are compared."""
    with np.errstate(over="ignore"):
        value = places.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((value ^ (value >> np.uint64(29))) + words.view(np.uint64)).view(np.int64)


def _tallied(**columns: np.ndarray) -> pa.Table:
    """Distinct rows and their number, ``count``."""
    names = list(columns)
    return pa.table(columns).group_by(names, use_threads=False).aggregate([([], "count_all")]).select([*names, "count_all"]).rename_columns([*names, "count"])


def by_place(table: pa.Table) -> Iterator[pa.Table]:
    """The rows in order of ``place``, some at a time; a shuffle packs rows closer when their places repeat."""
    table = table.combine_chunks()
    order = np.argsort(table.column("place").to_numpy(), kind="stable")
    for start in range(0, len(order), TOLD_ROWS):
        yield table.take(pa.array(order[start : start + TOLD_ROWS]))


@contextmanager
def joined_in_place(spark: SparkSession) -> Iterator[None]:
    """Meanwhile joins by place and word take sides that are dealt by place alone as they are, without a shuffle."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# what most rows have alike stands at the end, next to the place of the row after it: a shuffle packs that closer
PAIRS = "place bigint, word bigint, seen bigint, count bigint"
RARE = "place bigint, word bigint, seen bigint"


def _count_pairs(cached) -> object:
    """A mapInArrow function: PAIRS, combined within the task; ``seen`` is the word's count, 0 if it is not broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, keys, counts = cached.value

        def told(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for part in by_place(table):
                at, here = looked_up(keys, part.column("word").to_numpy())
                seen = np.zeros(len(at), np.int64)
                seen[here] = counts[at[here]]
                yield from part.add_column(2, "seen", pa.array(seen)).to_batches()

        held, rows = [], 0
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            distinct, tokens, contexts, _ = pairs_of(batch.column("text"))
            held.append(_tallied(place=places.find(distinct, contexts, tokens), word=distinct[tokens]))
            rows += held[-1].num_rows
            if rows > HELD:
                held = [pa.concat_tables(held).group_by(["place", "word"], use_threads=False).aggregate([("count", "sum")]).rename_columns(["place", "word", "count"])]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from told(held[0])
                    held, rows = [], 0
        if held:
            merged = pa.concat_tables(held).group_by(["place", "word"], use_threads=False).aggregate([("count", "sum")])
            held = []
            yield from told(merged.rename_columns(["place", "word", "count"]))

    return tidied(run)


def discounted(count: Column, factors: np.ndarray) -> Column:
    return count * F.element_at(F.array(*[F.lit(float(f)) for f in factors[1:]]), F.least(count, F.lit(DISCOUNTED + 1)).cast("int"))


def _bucketed(spark: SparkSession, name: str, schema: str, buckets: int, path: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (place) SORTED BY (place) INTO {buckets} BUCKETS LOCATION '{path}'")


def _with_chances(pairs: DataFrame, rare: DataFrame, factors: np.ndarray, total: float) -> DataFrame:
    """``pairs`` with the chance of their word; ``rare`` has the counts of words that are not broadcast, by pair."""
    met = pairs.join(rare.withColumnRenamed("seen", "seldom").hint("shuffle_hash"), ["place", "word"], "left")
    seen = F.greatest(F.coalesce("seldom", "seen"), F.lit(1))
    return met.withColumn("chance", discounted(seen, factors) / F.lit(total or 1.0)).drop("seldom")


def gained(spark: SparkSession, model: Katz, which: Column, part: int | None = None, seldom: bool = True) -> DataFrame:
    """place, word and gain of some pairs, of one part or all, dealt as the pairs are; not ``seldom``: none ends in a word that is not broadcast."""
    tables = spark.table(model.pairs).filter(which), spark.table(rare_of(model.pairs)), spark.read.parquet(f"{model.path}/contexts")
    # the place or the context comes first in each
    pairs, rare, contexts = tables if part is None else (table.filter(in_part(F.col(table.columns[0]), part)) for table in tables)
    found = _with_chances(pairs, rare.filter(F.lit(seldom)), model.word_factors, model.total)
    several = model.places.table(spark).groupBy("context").agg(F.collect_list("place").alias("places"))
    contexts = contexts.join(F.broadcast(several), "context", "left")
    contexts = contexts.select(F.explode(F.coalesce("places", F.array("context"))).alias("place"), "scale", "alpha")
    found = found.join(contexts.repartition(model.buckets, "place").hint("shuffle_hash"), "place")
    mass = discounted(F.col("count"), model.pair_factors)
    return found.select("place", "word", (_log10(mass / F.col("scale")) - _log10(F.col("alpha")) - _log10(F.col("chance"))).alias("gain"))


def train(docs: DataFrame) -> Katz:
    """Count words and pairs of all texts, and derive chances and backoff weights."""
    with joined_in_place(docs.sparkSession), releasing(docs.sparkSession):
        return _train(docs)


def _train(docs: DataFrame) -> Katz:
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "katz")
    texts = small_batches(docs).select(*id_and_text())
    # order 1: counts, then chances from the counts of counts
    raw = texts.mapInArrow(tidied(_count_words), "key bigint, count bigint").groupBy("key").agg(F.sum("count").alias("count"))
    raw.write.parquet(f"{path}/counts")
    words = spark.read.parquet(f"{path}/counts")
    tokens, distinct = words.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    word_factors = discounts(_counts_of_counts(words))
    mass = words.agg(F.coalesce(F.sum(discounted(F.col("count"), word_factors)), F.lit(0.0))).first()[0]
    total = float(tokens) if mass < tokens - 1e-9 else float(tokens + 1)
    unknown = 1 - mass / total if tokens else 1.0
    words = words.withColumn("chance", discounted(F.col("count"), word_factors) / F.lit(total or 1.0))

    # order 2
    least = max(CACHED * tokens, 1)
    keys, counts = _numbers(words.filter(F.col("count") >= min(least, max(tokens / SPREAD, 1))).select("key", "count"))
    places = Places.of(keys, counts, tokens)
    kept = counts >= least
    buckets = min(max(tokens // BUCKET_TOKENS, int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_BUCKETS)
    cached = spark.sparkContext.broadcast((places, keys[kept], counts[kept]))
    told = texts.mapInArrow(_count_pairs(cached), PAIRS).repartition(buckets, "place")
    name = "katz_pairs_" + path.rsplit("-", 1)[1]
    _bucketed(spark, name, PAIRS, buckets, f"{path}/order=2")
    told.groupBy("place", "word").agg(F.max("seen").alias("seen"), F.sum("count").alias("count")).write.insertInto(name)
    release()
    cached.destroy()
    pairs = spark.table(name)
    pair_factors = discounts(_counts_of_counts(pairs))
    rare = words.filter(F.col("count") < least).select(F.col("key").alias("word"), F.col("count").alias("seen"))
    rare = pairs.filter(F.col("seen") == 0).select("place", "word").join(rare, "word").select("place", "word", "seen")
    _bucketed(spark, rare_of(name), RARE, buckets, f"{path}/rare")
    rare.repartition(buckets, "place").write.insertInto(rare_of(name))
    release()

    # what the discounts of a context leave is shared by the words not seen after it
    sums = _with_chances(pairs, spark.table(rare_of(name)), word_factors, total).withColumn("mass", discounted(F.col("count"), pair_factors)).groupBy("place")
    sums = sums.agg(F.sum("count").alias("times"), F.sum("mass").alias("mass"), F.sum("chance").alias("lower"))
    sums = sums.join(places.table(spark), "place", "left").groupBy(F.coalesce("context", "place").alias("context"))
    sums = sums.agg(*[F.sum(name).alias(name) for name in ("times", "mass", "lower")])
    divide = F.when(F.col("times") - F.col("mass") > 1e-9, F.col("times")).otherwise(F.col("times") + 1).cast("double")
    unseen = 1 - F.col("lower")
    full = unseen <= 1e-12  # every word was seen: nothing to share
    sums.select(
        "context",
        F.when(full, F.col("mass")).otherwise(divide).alias("scale"),
        F.when(full, 0.0).otherwise((divide - F.col("mass")) / divide / unseen).alias("alpha"),
    ).write.parquet(f"{path}/contexts")
    release()
    alphas = spark.read.parquet(f"{path}/contexts").select(F.col("context").alias("key"), "alpha")
    words.join(alphas, "key", "left").select("key", "count", "chance", F.coalesce("alpha", F.lit(1.0)).alias("alpha")).write.parquet(f"{path}/order=1")
    release(spark.read.parquet(f"{path}/counts"))

    hot_words = _numbers(spark.read.parquet(f"{path}/order=1").filter(F.col("count") >= least))
    begin = alphas.filter(F.col("key") == BEGIN_HASH).first()
    begin_alpha = begin["alpha"] if begin else 1.0
    nothing = [np.zeros(0, np.int64)] * 4
    model = Katz(path, name, buckets, places, int(tokens), int(distinct), total, unknown, begin_alpha, least, word_factors, pair_factors, *hot_words, *nothing)
    place, word, gains = _numbers(gained(spark, model, F.col("count") >= least, seldom=False))
    release()
    mix = mixed(place, word)
    order = np.argsort(mix, kind="stable")
    return replace(model, pair_keys=mix[order], pair_places=place[order], pair_words=word[order], pair_gains=gains[order])


def _log10(value: Column) -> Column:
    return F.log10(F.greatest(value, F.lit(1e-300)))


def _logs(values: np.ndarray) -> np.ndarray:
    """Logarithm with a floor for chances of 0, which only stand where a pair's own chance replaces them."""
    return np.log10(np.maximum(values, 1e-300))


OWN = "doc_id bigint, mark bigint, n_tokens bigint, n_known double, told_base double, score double"
TOLD = f"place bigint, word bigint, row bigint, times bigint, own struct<{OWN.replace(' ', ':')}>".replace(",:", ", ")


def _ask(model, part: int) -> object:
    """A mapInArrow function: a row of what is known of each text, and rows of words and pairs to be asked for, of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Katz = model.value
        names = ["place", "word", "row", "times", "own"]
        own_names = [field.split()[0] for field in OWN.split(", ")]
        own_type = pa.struct(list(zip(own_names, [pa.int64()] * 3 + [pa.float64()] * 3, strict=True)))
        word_logs = _logs(kept.word_chances) + _logs(kept.word_alphas)
        count_logs = np.log10(kept.word_counts + 1.0)
        begin_log, unknown_log = _logs(np.array([kept.begin_alpha, kept.unknown]))
        for batch in sliced_by_bytes(batches, "text", TEXT_BYTES):
            keys, tokens, contexts, counts = pairs_of(batch.column("text"))
            owner = np.repeat(np.arange(len(counts)), counts)
            # words, by the place where they are asked for alone
            mine = (part_of(keys ^ ALONE) == part)[tokens]
            words, whose = tokens[mine], owner[mine]
            at, cached = looked_up(kept.word_keys, keys)
            score, base = np.full(len(keys), unknown_log), np.zeros(len(keys))
            score[cached], base[cached] = word_logs[at[cached]], count_logs[at[cached]]
            # of no numbers at all the sums would be integers
            sums = [np.bincount(whose, values[words], len(counts)).astype(float) for values in (cached, base, score)]
            alone = ~cached[words]
            whose, alone = whose[alone], keys[words[alone]]
            # pairs, by their context
            mine = (part_of(keys) == part)[contexts]
            tokens, contexts, owner = tokens[mine], contexts[mine], owner[mine]
            places, words = kept.places.find(keys, contexts, tokens), keys[tokens]
            at, hot = looked_up(kept.pair_keys, mixed(places, words))
            hot[hot] = (kept.pair_places[at[hot]] == places[hot]) & (kept.pair_words[at[hot]] == words[hot])
            sums[2] += np.bincount(owner[hot], kept.pair_gains[at[hot]], len(counts))
            if part == 0:
                sums[2] += begin_log
            # a text's own row asks nothing; its number as key spreads these rows, and no table holds such a pair
            row = batch.column("row")
            own = pa.StructArray.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(counts), *map(pa.array, sums)], names=own_names)
            yield pa.RecordBatch.from_arrays([row, row, row, pa.array(np.zeros(len(row), np.int64)), own], names=names)
            # what is asked for, once per text with its number of times
            asked = _tallied(
                whose=np.concatenate([owner[~hot], whose]),
                place=np.concatenate([places[~hot], alone ^ ALONE]),
                word=np.concatenate([words[~hot], alone]),
            )
            for told in by_place(asked):
                place, word, times, whose = (told.column(name).combine_chunks() for name in ("place", "word", "count", "whose"))
                yield pa.RecordBatch.from_arrays([place, word, row.take(whose), times, pa.nulls(len(whose), own_type)], names=names)

    return tidied(run)


def words_alone(spark: SparkSession, model: Katz) -> DataFrame:
    """place, word and what the words that are not broadcast add: base and more of score."""
    rare = spark.read.parquet(f"{model.path}/order=1").filter(F.col("count") < model.least)
    # a word that is not broadcast was scored as unknown
    more = _log10(F.col("chance")) + _log10(F.col("alpha")) - _log10(F.lit(float(model.unknown)))
    return rare.select(F.col("key").bitwiseXOR(F.lit(ALONE)).alias("place"), F.col("key").alias("word"), F.log10(F.col("count") + 1).alias("base"), more.alias("more"))


SUMS = ("n_known", "told_base", "score")


def _summed(rows: DataFrame, model: Katz, shared, part: int) -> DataFrame:
    """doc_id, mark, n_tokens and SUMS of every text over one part of the questions, stored."""
    spark = rows.sparkSession
    asked = rows.mapInArrow(_ask(shared, part), TOLD).repartition(model.buckets, "place")
    found = asked.join(gained(spark, model, F.col("count") < model.least, part).hint("shuffle_hash"), ["place", "word"], "left")
    alone = words_alone(spark, model).filter(in_part(F.col("place"), part))
    found = found.join(alone.repartition(model.buckets, "place").hint("shuffle_hash"), ["place", "word"], "left")

    def total(own: str, answered: Column):
        return F.sum(F.coalesce(f"own.{own}", F.lit(0.0)) + F.col("times") * answered).alias(own)

    base, gain, more = (F.coalesce(name, F.lit(0.0)) for name in ("base", "gain", "more"))
    known = F.col("base").isNotNull().cast("double")
    totals = [total(name, answered) for name, answered in zip(SUMS, (known, base, gain + more), strict=True)]
    own = [F.max(f"own.{name}").alias(name) for name in ("doc_id", "mark", "n_tokens")]
    with joined_in_place(spark):
        return stored(found.groupBy("row").agg(*own, *totals).drop("row"), "katz-sums")


def score(docs: DataFrame, model: Katz) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 chances) of every document, stored."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(*id_and_text())
    rows = rows.select("*", F.xxhash64("doc_id", "text").alias("mark"), F.monotonically_increasing_id().alias("row"))
    shared = spark.sparkContext.broadcast(model)
    with releasing(spark):
        parts = [_summed(rows, model, shared, part) for part in range(len(PARTS))]
    shared.destroy()
    sums = parts[0]
    for other in parts[1:]:
        # rows with the same id and text have the same sums
        once = other.groupBy("doc_id", "mark").agg(*[F.max(name).alias(f"other_{name}") for name in SUMS])
        once = once.withColumnsRenamed({"doc_id": "other_id", "mark": "other_mark"})
        sums = sums.join(once, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("mark") == F.col("other_mark")))
        sums = sums.select("doc_id", "mark", "n_tokens", *[(F.col(name) + F.col(f"other_{name}")).alias(name) for name in SUMS])
    below = np.log10(model.tokens + model.distinct + 1)
    scores = sums.select(
        "doc_id",
        "n_tokens",
        F.round("n_known").cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("told_base") - F.col("n_tokens") * F.lit(float(below))).alias("base_score"),
        "score",
    )
    scores = stored(scores, "katz-scores")
    release(*parts)
    return scores
