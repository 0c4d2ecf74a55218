"""Mixing to target weights by soft membership.

A classifier fitted on the labelled table gives each document a posterior over domains (high quality, low quality, toxic).
Documents get nonnegative rates w such that the expected token shares sum_i w_i t_i p_ik / sum_i t_i match the targets T_k.
The rates are the least-squares solution |shares - T|^2 / 2 with NEAREST times the token-weighted squared distance of the rates from 1
beside it, so that of all rates that meet the targets those nearest to 1 are found. Projected gradient steps on the documents'
rates all lead to rates of one form, w_i = max(0, 1 - p_i . s) with one number per domain in s, and the best s is where the gradient of

    D(s) = sum_i t_i max(0, 1 - p_i . s)^2 / (2 sum_i t_i) + s . T + NEAREST |s|^2 / 2

is zero: T - shares + NEAREST s. A step takes the gradient scaled by the second moments of the documents whose rate is above 0, at the
length of LENGTHS that lessens D most. One pass over the narrow table of tokens and posteriors adds up D, shares and moments for all
lengths at once; the driver sees only these sums.

Defined cases: a null text counts as empty and has no tokens; a text without tokens keeps the rate that its posterior
gives and adds nothing; without labels of two classes every document has the labels' shares as posterior (equal
shares without any label); targets that no rates can reach are met as nearly as can be; of different labelled texts with one
doc_id the classifier learns from that with the smallest hash; repeated
rows count and draw one by one; an empty table gives no rows; columns besides doc_id and text are only carried.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.arrow import give_back_memory, kept_by_worker, map_texts, take_rows
from winback.llm.common import id_and_text, stored
from winback.llm.lexicon import distinct_texts, per_text, sample_labelled, telling_buckets, telling_features, texts_with_features

DOMAINS = ("high", "low", "toxic")
#: shares of all tokens that the mixture should expect of each domain
TARGETS = (0.90, 0.09, 0.01)
#: sampled rows of each domain for fitting the classifier
PER_CLASS = 1500
#: what a rate's distance from 1 counts beside the shares' distance from the targets
NEAREST = 1e-9
#: passes at most, and the gradient at which no more are made
PASSES = 200
CLOSE = 1e-10
#: step lengths tried in one pass
LENGTHS = 2.0 ** np.arange(2, -22, -1)
REMEMBERED = 200_000
#: not part of a word at its ends
AROUND = ".,!?|;:\"'()[]{}<>*_-\u201c\u201d\u2018\u2019\u00ab\u00bb\u2026"
NUMBER = "__mixing_row"
MEMBERSHIP = "doc_id bigint, n_tokens bigint, " + ", ".join(f"p_{name} double" for name in DOMAINS)


# --- posteriors -----------------------------------------------------------------------------

CLASSES_OF_BYTES = np.zeros(256, np.int64)
for _at, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t", b".,;:'\"-()", b"!?", b"|#*$%&@=<>{}[]/\\_~^+`"), 1):
    CLASSES_OF_BYTES[list(_chars)] = _at


def bare(word: str) -> str:
    """A word as it can tell a class, in fitting and in scoring."""
    return word.strip(AROUND)


def told_words(text: str) -> set[str]:
    return set(map(bare, set(text.split())))


def inputs(text: str, words: list[str], distinct: set[str], toxic: int, low: int) -> list[float]:
    """Numbers that describe a text: kinds of characters, repetition, length, and its words that tell a class."""
    data = text.encode()
    kinds = np.bincount(CLASSES_OF_BYTES, np.bincount(np.frombuffer(data, np.uint8), minlength=256), 8)
    lines = data.split(b"\n")
    count, size = max(len(words), 1), max(len(data), 1)
    return [
        1.0,
        np.log1p(len(words)),
        len(data) / count,
        len(distinct) / count,
        len(set(lines)) / len(lines),
        *np.sqrt(kinds[1:] / size),
        np.log1p(toxic),
        float(toxic > 0),
        np.log1p(low),
    ]


INPUTS = len(inputs("", [], set(), 0, 0))


@dataclass(frozen=True)
class Classifier:
    """Softmax over the domains; ``telling`` are the feature buckets of toxic and of low-quality words."""

    telling: tuple[np.ndarray, np.ndarray]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def described(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words (white space apart) and inputs of each text."""
        # words as they stand in texts: those looked at, and the bare word and mark (1 toxic, 2 low quality) of those that tell
        seen, told = kept_by_worker(("mixing-words", *(np.packbits(table).tobytes() for table in self.telling)), lambda: (set(), {}))
        if len(seen) > REMEMBERED:
            seen.clear()
            told.clear()
        marks: dict[int, int] = {}
        for at, table in enumerate(self.telling):
            for bucket in np.flatnonzero(table).tolist():
                marks[bucket] = marks.get(bucket, 0) | 1 << at
        rows, tokens = [], []
        for text in texts:
            words = text.split()
            distinct = set(words)
            for word in distinct.difference(seen):
                mark = 0
                for bucket in telling_buckets(bare(word)):
                    mark |= marks.get(bucket, 0)
                if mark:
                    told[word] = bare(word), mark
                seen.add(word)
            found = {told[word] for word in distinct & told.keys()} if told else ()
            rows.append(inputs(text, words, distinct, sum(mark & 1 for _, mark in found), sum(mark >> 1 for _, mark in found)))
            tokens.append(len(words))
        return np.array(tokens, np.int64), np.array(rows, float).reshape(-1, INPUTS)

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words and posteriors of each text."""
        tokens, x = self.described(texts)
        return tokens, softmax((x - self.centre) / self.scale @ self.weights)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf))
    return scores / scores.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on a bounded sample of labelled rows: doc_id, quality and toxic (0/1)."""
    size = len(DOMAINS)
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    coded = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain.alias("label")).dropna()
    coded = coded.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi")
    shares = {row["label"]: row["count"] for row in coded.groupBy("label").count().collect()}
    counts = np.array([shares.get(k, 0) for k in range(size)], float)
    sample = distinct_texts(sample_labelled(docs, coded, range(size), PER_CLASS), str.split)
    seen, texts = texts_with_features(sample, told_words, size)
    telling = tuple(telling_features(seen, texts, of) for of in (2, 1))
    blank = Classifier(telling, np.zeros(INPUTS), np.ones(INPUTS), np.zeros((INPUTS, size)))
    if (texts > 0).sum() < 2:
        blank.weights[0] = np.log((counts + 1e-9) / (counts + 1e-9).sum()) if counts.sum() else np.zeros(size)
        return blank

    def described(_: list, given: list, bodies: list) -> dict[str, list]:
        return {"label": given, "x": blank.described(bodies)[1].tolist()}

    rows = sorted(tuple(row) for row in per_text(sample, "label int, x array<double>", described).collect())
    given, x = np.array([row[0] for row in rows]), np.array([row[1] for row in rows])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    centre[0], scale[0] = 0, 1
    x = (x - centre) / scale
    target = np.eye(size)[given]
    # the sample is balanced, the corpus is not
    prior = np.log(counts + 0.5) - np.log(texts + 0.5)
    weights = np.zeros((INPUTS, size))
    step = 1 / (0.5 * np.linalg.eigvalsh(x.T @ x / len(x)).max() + 1e-3)
    momentum = weights
    for round_ in range(800):
        ahead = weights + round_ / (round_ + 3) * (weights - momentum)
        slope = x.T @ (softmax(x @ ahead) - target) / len(x) + 1e-3 * ahead
        momentum, weights = weights, ahead - step * slope
    weights = weights.copy()
    weights[0] += prior
    give_back_memory()
    return Classifier(telling, centre, scale, weights)


def membership(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, n_tokens and p_<domain> of every document."""

    def work(_: list, texts: list[str]) -> dict[str, list]:
        tokens, chances = classifier.posteriors(texts)
        return {"doc_id": _, "n_tokens": tokens} | {f"p_{name}": chances[:, k] for k, name in enumerate(DOMAINS)}

    return map_texts(docs, MEMBERSHIP, work)


# --- rates ----------------------------------------------------------------------------------


def rates_after(chances: np.ndarray, steps: Sequence[np.ndarray]) -> np.ndarray:
    """The rates that the steps lead to from 1, for rows of posteriors; the projection comes after all of them."""
    return np.maximum(0, 1 - chances @ np.sum([np.zeros(chances.shape[1]), *steps], axis=0))


@dataclass(frozen=True)
class Sums:
    """For one s: half the token-weighted mean of the squared rates, shares, and second moments where the rate is above 0."""

    half: float
    shares: np.ndarray
    moments: np.ndarray

    def value(self, s: np.ndarray, wanted: np.ndarray) -> float:
        return self.half + s @ wanted + NEAREST * (s @ s) / 2

    def gradient(self, s: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        return wanted - self.shares + NEAREST * s


def _sums(members: DataFrame, candidates: Sequence[np.ndarray], tokens: float) -> list[Sums]:
    """The sums of several s, from one pass."""
    names = [f"p_{name}" for name in DOMAINS]
    size = len(DOMAINS)
    width = 1 + size + size * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(candidates), width))
        for batch in batches:
            chances = np.stack([batch.column(name).to_numpy() for name in names], axis=1)
            weight = batch.column("n_tokens").to_numpy().astype(float)
            for row, s in zip(total, candidates, strict=True):
                rate = rates_after(chances, [s])
                active = chances * (weight * (rate > 0))[:, None]
                row += [weight @ rate**2 / 2, *(weight * rate) @ chances, *(active.T @ chances).ravel()]
        at = np.arange(len(candidates))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(total[:, column]) for column in range(width)]], names=["at", *sums])

    sums = [f"s{at}" for at in range(width)]
    parts = members.select("n_tokens", *names).mapInArrow(run, ", ".join(["at bigint", *[f"{name} double" for name in sums]]))
    # a row per candidate
    found = np.zeros((len(candidates), width))
    for row in parts.groupBy("at").agg(*[F.sum(name).alias(name) for name in sums]).collect():
        found[row["at"]] = row[1:]
    found /= tokens
    return [Sums(row[0], row[1 : 1 + size], row[1 + size :].reshape(size, size)) for row in found]


def fit_rates(members: DataFrame, targets: Sequence[float | None] = TARGETS) -> list[np.ndarray]:
    """Steps whose rates bring the expected domain totals as near to ``targets`` (shares of the present tokens) as can be.

    A domain with None keeps its present share; the others divide the rest by their targets.
    """
    tokens = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    if not tokens:
        return []
    s = np.zeros(len(DOMAINS))
    (now,) = _sums(members, [s], tokens)
    free = np.array([share is None for share in targets])
    wanted = np.where(free, now.shares, [share or 0.0 for share in targets])
    wanted[~free] *= (1 - wanted[free].sum()) / max(wanted[~free].sum(), 1e-300)
    steps: list[np.ndarray] = []
    for _ in range(PASSES):
        gradient = now.gradient(s, wanted)
        if np.abs(gradient).max() <= CLOSE:
            break
        scaled = np.linalg.solve(now.moments + NEAREST * np.eye(len(s)), -gradient)
        tried = [*(scaled * length for length in LENGTHS), *(-gradient * length for length in LENGTHS)]
        found = _sums(members, [s + step for step in tried], tokens)
        values = [sums.value(s + step, wanted) for step, sums in zip(tried, found, strict=True)]
        best = int(np.argmin(values))
        if not values[best] < now.value(s, wanted):
            break  # nearer than doubles can tell
        s, now = s + tried[best], found[best]
        steps.append(tried[best])
    return steps


def document_rates(members: DataFrame, steps: Sequence[np.ndarray]) -> DataFrame:
    """``members`` with the rate of each document."""
    names = [f"p_{name}" for name in DOMAINS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances = np.stack([batch.column(name).to_numpy() for name in names], axis=1)
            yield batch.append_column("rate", pa.array(rates_after(chances, steps)))

    return members.mapInArrow(run, MEMBERSHIP + ", rate double")


def mix(docs: DataFrame, labels: DataFrame, targets: Sequence[float | None] = TARGETS) -> DataFrame:
    """doc_id, n_tokens, posteriors and rate of every document."""
    members = stored(membership(docs, fit(docs, labels)), "membership")
    return document_rates(members, fit_rates(members, targets))


def copies(doc_ids: list, rates: np.ndarray, texts: list[str] | None = None, numbers: list[int] | None = None) -> np.ndarray:
    """How often each document is taken: its rate rounded up or down, up with the fraction's chance by a hash of id, text and number."""
    import xxhash

    def draw(*parts: object) -> float:
        return xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass")) / 2**64

    parts = [column for column in (doc_ids, texts, numbers) if column is not None]
    return np.floor(rates + np.array([draw(*row) for row in zip(*parts, strict=True)])).astype(np.int64)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs``; where rows repeat doc_id and text, stored with a number of each row in NUMBER, so that each draws by itself."""
    keys = docs.select(*id_and_text()).select("doc_id", F.xxhash64("text").alias("text_key"))
    if keys.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty():
        return docs
    return stored(docs.withColumn(NUMBER, F.monotonically_increasing_id()), "numbered")


def resample(docs: DataFrame, labels: DataFrame, targets: Sequence[float | None] = TARGETS) -> DataFrame:
    """The documents at their rates: rows are left out or repeated, with all their columns."""
    classifier = fit(docs, labels)
    members = stored(membership(docs, classifier), "membership")
    steps = fit_rates(members, targets)

    def choose(doc_ids: list, texts: list[str], numbers: list[int] | None = None) -> np.ndarray:
        _, chances = classifier.posteriors(texts)
        return np.repeat(np.arange(len(texts)), copies(doc_ids, rates_after(chances, steps), texts, numbers))

    rows = numbered(docs)
    return take_rows(rows, choose, NUMBER if NUMBER in rows.columns else None).select(*[f"`{name}`" for name in docs.columns])
