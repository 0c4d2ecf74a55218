"""Mixing: targets met in expectation, nonnegative rates, copies."""

from __future__ import annotations

import random

import numpy as np
import pytest

from winback.llm import mixing
from winback.llm.queries import QUERIES

MEMBERS = mixing.MEMBERSHIP


def members_of(spark, rows):
    return spark.createDataFrame(rows, MEMBERS)


def random_members(count, seed):
    rng = np.random.default_rng(seed)
    chances = rng.dirichlet([2, 0.5, 0.3], count)
    return [(i, int(rng.integers(0, 500)), *map(float, row)) for i, row in enumerate(chances)]


@pytest.mark.parametrize("targets", [(0.9, 0.09, 0.01), (0.3, 0.4, 0.3), (0.5, 0.5, None)])
def test_rates_meet_the_targets(spark, targets):
    rows = random_members(500, 1)
    members = members_of(spark, rows)
    steps = mixing.fit_rates(members, targets)
    got = mixing.document_rates(members, steps).collect()
    tokens, chances = np.array([row[1] for row in rows], float), np.array([row[2:] for row in rows])
    assert all(row["rate"] >= 0 for row in got)
    rate = np.array([row["rate"] for row in sorted(got)])
    shares = (chances * (tokens * rate)[:, None]).sum(axis=0) / tokens.sum()
    present = (chances * tokens[:, None]).sum(axis=0) / tokens.sum()
    if targets[2] is None:
        targets = ((1 - present[2]) / 2, (1 - present[2]) / 2, present[2])
    assert shares == pytest.approx(targets, abs=2e-6)


def test_targets_out_of_reach_are_met_as_nearly_as_can_be(spark):
    members = members_of(spark, [(1, 100, 0.5, 0.5, 0.0), (2, 100, 0.5, 0.5, 0.0)])
    rates = [row["rate"] for row in mixing.document_rates(members, mixing.fit_rates(members, (1.0, 0.0, 0.0))).collect()]
    # least squares over w: (w/2 - 1)^2 + (w/2)^2 has its least value at w = 1
    assert rates == pytest.approx([1, 1], abs=1e-3)
    assert mixing.fit_rates(members_of(spark, []), mixing.TARGETS) == []


def least_squares(rows, targets, rounds=40_000):
    """Smallest squared residual that nonnegative rates reach, by projected gradient with momentum on the rates themselves."""
    tokens, chances = np.array([row[1] for row in rows], float), np.array([row[2:] for row in rows])
    a = (chances * tokens[:, None]).T / tokens.sum()
    step = 1 / np.linalg.eigvalsh(a @ a.T).max()
    rate = before = np.ones(len(rows))
    best = np.inf
    for round_ in range(rounds):
        ahead = rate + round_ / (round_ + 3) * (rate - before)
        before, rate = rate, np.maximum(0, ahead - step * a.T @ (a @ ahead - targets))
        best = min(best, float(((a @ rate - targets) ** 2).sum()))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_residual_is_that_of_the_least_squares_solution(spark, seed):
    rng = np.random.default_rng(seed)
    alike = rng.dirichlet([[2, 0.5, 0.3], [9, 9, 9], [40, 30, 20], [60, 1, 1]][seed], 60)
    rows = [(i, int(rng.integers(1, 500)), *map(float, row)) for i, row in enumerate(alike)]
    members = members_of(spark, rows)
    tokens, chances = np.array([row[1] for row in rows], float), alike
    # in reach and out of it
    for targets in ((0.9, 0.09, 0.01), (0.05, 0.05, 0.9), (0.0, 1.0, 0.0)):
        rate = mixing.rates_after(chances, mixing.fit_rates(members, targets))
        shares = (chances * (tokens * rate)[:, None]).sum(axis=0) / tokens.sum()
        residual = ((shares - np.array(targets)) ** 2).sum()
        assert residual == pytest.approx(least_squares(rows, np.array(targets)), abs=1e-5)


def test_words_are_told_alike_in_fitting_and_scoring():
    text = 'He said "grubword"; (spitea) [grubword]: grubword, \u00abspiteb\u00bb... grubword! *spitec*'
    assert mixing.told_words(text) == {"He", "said", "grubword", "spitea", "spiteb", "spitec"}


def test_copies_follow_the_rates():
    counts = mixing.copies(list(range(20_000)) + [None], np.array([1.3] * 20_000 + [2.0]))
    assert set(counts.tolist()) <= {1, 2} and counts[-1] == 2 and abs(counts[:-1].mean() - 1.3) < 0.02
    assert mixing.copies([5], np.array([0.0])).tolist() == [0]


def corpus():
    random.seed(3)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(random.choices("abcdeilnorst", k=random.randint(2, 8))) for _ in range(random.randint(20, 80))]
        domain = i % 8
        if domain == 0:
            words[5:8] = ["grubword", "spitea", "spiteb"]
        if domain == 1:
            words = [word + "!!!" for word in words[:3] * 12]
        rows.append((i, " ".join(words)))
        labels.append((i, int(domain != 1), int(domain == 0)))
    return rows, labels


def test_resample_keeps_columns_and_moves_shares(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*row, "x", 0.5) for row in [*rows, (None, None), (900, "")]], "doc_id bigint, text string, rate string, n_tokens double").repartition(3)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    mixed = mixing.resample(docs, known, (0.95, 0.04, 0.01))
    assert mixed.schema == docs.schema
    ids = [row["doc_id"] for row in mixed.collect()]
    part = lambda of: sum(i is not None and i < 900 and i % 8 == of for i in ids)
    assert part(0) < 25 and part(1) < 40 and sum(part(of) for of in range(2, 8)) >= 300
    assert {i for i, _ in rows if i % 8 > 1} <= set(ids)


def test_without_labels_every_text_is_judged_alike(spark):
    rows, _ = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = mixing.mix(docs, labels).collect()
    assert len(got) == 400 and {round(row["p_high"], 9) for row in got} == {round(1 / 3, 9)}
    assert mixing.mix(docs.limit(0), labels).count() == 0


def test_query_judges_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_mixing"](spark, folder).collect()
    assert len(rows) == 1000
    tokens = sum(row["n_tokens"] for row in rows)
    shares = [sum(row["n_tokens"] * row["rate"] * row[f"p_{name}"] for row in rows) / tokens for name in mixing.DOMAINS]
    assert shares == pytest.approx(mixing.TARGETS, abs=1e-5)


@pytest.mark.parametrize("same", ["ids", "rows"])
def test_rows_without_ids_are_taken_in_proportion(spark, monkeypatch, same):
    rows = [(None, f"text {i}" if same == "ids" else "one text", "x") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rate string").repartition(3)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for rate in (0.4, 1.7):
        # equal posteriors; this step leads from 1 to the rate
        monkeypatch.setattr(mixing, "fit_rates", lambda *_, rate=rate: [np.full(3, 1 - rate)])
        mixed = mixing.resample(docs, labels)
        assert mixed.schema == docs.schema
        assert abs(mixed.count() / 3000 - rate) < 0.05
