"""Toxic spans by a linear-chain conditional random field.

Labels are given per text. Words of toxic training texts that have a feature which tells the class (see
``lexicon``) are labelled toxic, all others not, and these labelled words train the field: two tags, hashed word
features, transitions. Of a whole text, forward-backward gives each word's marginal chance of being
toxic; the marginals add up to the text's score by a calibrated logistic function, and runs of words
above one half are the offending spans. The model is fitted on a bounded sample of rows (PER_CLASS whole texts of each
class) and travels to the tasks as one array of fixed size. Which features tell the class, and how scores are calibrated, is
counted over the whole sampled texts on the executors. The field learns from windows of WINDOW words: of each text at most
TAGGED_WINDOWS that hold a toxic word and PLAIN_WINDOWS others, drawn by a hash from all of its windows.

Forward and backward quantities are kept as ratios toxic : not toxic, so they need no scaling however long a
text is, and all texts of a slice step forward together.

Defined cases: a null text counts as empty; a text without words gets the score of no evidence; labels without
an id, value or document are left out, of repeated labels the larger counts, of different training texts with one doc_id that
with the smallest hash; without training texts of
both classes every score is the share of toxic labels (0 without any); repeated rows are scored one by one; other
columns are never inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.arrow import give_back_memory, kept_by_worker, map_texts, take_rows
from winback.llm.lexicon import (
    BUCKETS,
    FEATURES,
    WORD,
    distinct_texts,
    features,
    per_text,
    sample_labelled,
    tells,
    telling_features,
    texts_with_features,
)

#: sampled rows of each class
PER_CLASS = 2000
#: words of a training sequence; sequences of a text with and without a toxic word that the field learns from
WINDOW = 128
TAGGED_WINDOWS = 16
PLAIN_WINDOWS = 2
#: training sequences handled at a time
SEQUENCES = 2000
ROUNDS = 60
STEP = 0.15
PENALTY = 1e-4
THRESHOLD = 0.3
FLOOR = 0.1
#: emission scores remembered by a worker
REMEMBERED = 200_000
SCHEMA = "doc_id bigint, score double, predicted int, spans array<struct<start:bigint,end:bigint,chance:double>>"


def ratios(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward ratios toxic : not toxic of each word, and exp(score).

    ``scores``: emission scores of all sequences one after the other; ``trans``: log weights of not->toxic, toxic->not,
    toxic->toxic (not->not is 0) and of starting toxic.
    """
    weight = np.exp(np.clip(scores, -30, 30))
    to_toxic, to_plain, stay, start = np.exp(trans)
    forward, backward = np.empty(len(scores)), np.ones(len(scores))
    order = np.argsort(-lengths, kind="stable")
    firsts = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    most = int(sorted_lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-sorted_lengths, -np.arange(most), side="left")  # sequences longer than step t
    lasts = firsts + sorted_lengths - 1
    for step in range(most):
        at = firsts[: active[step]] + step
        if step:
            before = forward[at - 1]
            forward[at] = weight[at] * (to_toxic + stay * before) / (1 + to_plain * before)
        else:
            forward[at] = weight[at] * start
    for step in range(1, most):
        at = lasts[: active[step]] - step
        after = weight[at + 1] * backward[at + 1]
        backward[at] = (to_plain + stay * after) / (1 + to_toxic * after)
    return forward, backward, weight


def marginals(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    forward, backward, _ = ratios(scores, lengths, trans)
    odds = forward * backward
    return odds / (1 + odds)


@dataclass(frozen=True)
class Model:
    """Feature weights, transitions and the calibration of scores."""

    weights: np.ndarray
    trans: np.ndarray
    calibration: np.ndarray  # for 1, log(1 + expected toxic words), largest marginal

    def emission(self, word: str) -> float:
        return float(self.weights[features(word)].sum())

    def score(self, expected: np.ndarray, largest: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence(expected, largest) @ self.calibration, -30, 30)))


def evidence(expected: np.ndarray, largest: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(expected)), np.log1p(expected), largest], axis=1)


def totals(chances: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and largest of each sequence's marginals (0 for an empty one).

    Marginals below FLOOR are left out of the sum: in a very long text they would add up to evidence.
    """
    chances = np.where(chances < FLOOR, 0, chances)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    largest = np.zeros(len(lengths))
    np.maximum.at(largest, owner, chances)
    return np.bincount(owner, chances, len(lengths)), largest


def train_field(words: np.ndarray, tags: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximise the penalised likelihood of the tags by gradient ascent with adaptive steps.

    ``words``: index of each word into ``table`` (features of the distinct words).
    """
    params = np.concatenate([np.zeros(BUCKETS), [-3.0, 0.0, 0.0, -3.0]])
    first, second = np.zeros(BUCKETS + 4), np.zeros(BUCKETS + 4)
    ends = np.cumsum(lengths)
    parts = []  # a slice of the words and its sequences' lengths, so that what a round works on stays small
    for at in range(0, len(lengths), SEQUENCES):
        own = lengths[at : at + SEQUENCES]
        stop = int(ends[at + len(own) - 1])
        parts.append((slice(stop - int(own.sum()), stop), own))
    for round_ in range(1, ROUNDS + 1):
        scores = params[:BUCKETS][table].sum(axis=1)
        slope, by_word = np.zeros(BUCKETS + 4), np.zeros(len(table))
        for part, own in parts:
            gain, slope_of_trans = part_slope(scores[words[part]], tags[part], own, params[BUCKETS:])
            by_word += np.bincount(words[part], gain, len(table))
            slope[BUCKETS:] += slope_of_trans
        for column in range(FEATURES):
            slope[:BUCKETS] += np.bincount(table[:, column], by_word, BUCKETS)
        slope[:BUCKETS] -= PENALTY * len(lengths) * params[:BUCKETS]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        params = params + STEP * (first / (1 - 0.9**round_)) / (np.sqrt(second / (1 - 0.99**round_)) + 1e-8)
    return params[:BUCKETS], params[BUCKETS:]


def part_slope(scores: np.ndarray, tags: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the tags' likelihood for some sequences: by each word's emission score, and by ``trans``."""
    starts = np.cumsum(lengths) - lengths
    follows = np.ones(len(scores), bool)
    follows[starts[lengths > 0]] = False
    now = np.flatnonzero(follows)
    pair = 2 * tags[now - 1] + tags[now]
    seen = np.array([(pair == kind).sum() for kind in (1, 2, 3)] + [tags[~follows].sum()], float)
    forward, backward, weight = ratios(scores, lengths, trans)
    odds = forward * backward
    chance = odds / (1 + odds)
    before, here = forward[now - 1], weight[now] * backward[now]
    to_toxic, to_plain, stay, _ = np.exp(trans)
    joint = np.stack([to_toxic * here, to_plain * before, stay * before * here])
    joint /= 1 + joint.sum(axis=0)
    return tags - chance, seen - [*joint.sum(axis=1), chance[~follows].sum()]


def logistic(inputs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    beta = np.zeros(inputs.shape[1])
    ridge = np.diag([1e-6] + [0.05] * (inputs.shape[1] - 1))
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        hessian = (inputs * (chance * (1 - chance) + 1e-9)[:, None]).T @ inputs + ridge
        beta = beta + np.linalg.solve(hessian, inputs.T @ (labels - chance) - ridge @ beta)
    return beta


def training_windows(doc_id: int, words: list[str], tagged: list[bool]) -> list[tuple[list[str], list[bool]]]:
    """Windows of one text to learn from, drawn by a hash from all over it."""
    kinds: tuple[list, list] = ([], [])
    for at in range(0, len(words), WINDOW):
        part = slice(at, at + WINDOW)
        kinds[any(tagged[part])].append((zlib.crc32(f"{doc_id}:{at}".encode()), at))
    chosen = [at for windows, most in zip(kinds, (PLAIN_WINDOWS, TAGGED_WINDOWS), strict=True) for _, at in sorted(windows)[:most]]
    return [(words[at : at + WINDOW], tagged[at : at + WINDOW]) for at in sorted(chosen)]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of the labelled rows; ``labels`` holds doc_id and toxic."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).dropna()
    shares = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    sample = distinct_texts(sample_labelled(docs, known, (0, 1), PER_CLASS), WORD.findall)
    seen, texts = texts_with_features(sample, WORD.findall, 2)
    if not texts.all():
        share = shares.get(1, 0) / max(1, sum(shares.values()))
        base = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(BUCKETS), np.zeros(4), np.array([base, 0.0, 0.0]))
    telling = telling_features(seen, texts, 1)

    def windows_of(doc_ids: list, given: list, bodies: list) -> dict[str, list]:
        rows, known_words = [], {}
        for doc_id, label, text in zip(doc_ids, given, bodies, strict=True):
            words = WORD.findall(text)
            for word in set(words).difference(known_words):
                known_words[word] = tells(telling, word)
            tagged = [bool(label) and known_words[word] for word in words]
            if label and not any(tagged):
                continue  # toxic, but it is not known where
            rows += [(doc_id, *window) for window in training_windows(doc_id, words, tagged)]
        return {name: [row[at] for row in rows] for at, name in enumerate(("doc_id", "words", "tagged"))}

    # at most PER_CLASS texts of each class, with a bounded number of windows each
    windows = per_text(sample, "doc_id bigint, words array<string>, tagged array<boolean>", windows_of).orderBy("doc_id", "words").collect()
    index: dict[str, int] = {}
    coded = [np.array([index.setdefault(word, len(index)) for word in row["words"]], np.int64) for row in windows]
    tags = [np.array(row["tagged"], np.int8) for row in windows]
    if not coded:
        coded, tags, index = [np.zeros(1, np.int64)], [np.zeros(1, np.int8)], {"": 0}
    del windows
    table = np.array([features(word) for word in index]).reshape(-1, FEATURES)
    weights, trans = train_field(np.concatenate(coded), np.concatenate(tags), np.array([len(part) for part in coded]), table)
    del coded, tags, index, table
    field = Model(weights, trans, np.zeros(3))

    def evidence_of(_: list, given: list, bodies: list) -> dict[str, list]:
        expected, largest = totals(*text_marginals(field, bodies)[:2])
        return {"label": given, "expected": expected.tolist(), "largest": largest.tolist()}

    rows = per_text(sample, "label int, expected double, largest double", evidence_of).collect()
    told = np.array(sorted(tuple(row) for row in rows))
    beta = logistic(evidence(told[:, 1], told[:, 2]), told[:, 0])
    # the sample is balanced, the corpus is not
    beta[0] += np.log((shares.get(1, 0) + 0.5) / (shares.get(0, 0) + 0.5)) - np.log(texts[1] / texts[0])
    give_back_memory()
    return Model(weights, trans, beta)


def text_marginals(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Each word's chance of being toxic, the number of words of each text, and the words."""
    known = kept_by_worker(("toxic-emissions", model.weights.tobytes()[:4096], model.trans.tobytes()), dict)
    if len(known) > REMEMBERED:
        known.clear()
    found = [WORD.findall(text) for text in texts]
    for words in found:
        for word in set(words).difference(known):
            known[word] = model.emission(word)
    lengths = np.array([len(words) for words in found], np.int64)
    scores = np.fromiter((known[word] for words in found for word in words), float, int(lengths.sum()))
    return marginals(scores, lengths, model.trans), lengths, found


def judge_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores, and the spans of toxic words with their largest marginal."""
    chances, lengths, _ = text_marginals(model, texts)
    ends = np.cumsum(lengths)
    spans = [list(offending(text, chances[end - length : end])) for text, end, length in zip(texts, ends, lengths, strict=True)]
    return model.score(*totals(chances, lengths)), spans


def offending(text: str, chances: np.ndarray) -> Iterator[dict]:
    """Runs of words above one half; offsets count code points, ends are exclusive."""
    if not (chances > 0.5).any():
        return
    span = None
    for match, chance in zip(WORD.finditer(text), chances.tolist(), strict=True):
        if chance <= 0.5:
            if span:
                yield span
            span = None
        elif span:
            span = {"start": span["start"], "end": match.end(), "chance": max(chance, span["chance"])}
        else:
            span = {"start": match.start(), "end": match.end(), "chance": chance}
    if span:
        yield span


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted (1 if score >= threshold) and spans (start, end, chance) of every document."""

    def work(doc_ids: list, texts: list[str]) -> dict[str, list]:
        scores, spans = judge_texts(model, texts)
        return {"doc_id": doc_ids, "score": scores.tolist(), "predicted": (scores >= threshold).astype(int).tolist(), "spans": spans}

    return map_texts(docs, SCHEMA, work)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score below the threshold, with all their columns."""
    return take_rows(docs, lambda _, texts: np.flatnonzero(judge_texts(model, texts)[0] < threshold))
