"""Ranked lexical search against plain scores of every document, and against SQL."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from conftest import TABLES

from winback.llm import ranked_search
from winback.llm.oracle import ORACLE
from winback.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, score int, rank string, item_id int, n_terms int"
ITEMS = "item_id bigint, text string, doc_id int, score int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2, 3) for row in rows], DOCS).repartition(3)


def items_of(spark, rows):
    return spark.createDataFrame([(*row, 1, 2) for row in rows], ITEMS)


def plain_terms(text):
    lowered = re.sub("[A-Z]", lambda match: match[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, keep):
    terms = [(doc_id, plain_terms(text)) for doc_id, text in docs]
    N, L = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = {}
    for _, mine in terms:
        for term in set(mine):
            df[term] = df.get(term, 0) + 1
    w = {term: math.floor(1000 * math.log((2 * N + 2) / (2 * count + 1))) for term, count in df.items()}
    rows = []
    for item_id, text in items:
        found = []
        for doc_id, mine in terms:
            if mine:
                m = 25 + (75 * len(mine) * N) // L
                score = sum(w[term] * ((10**9 * mine.count(term)) // (1000 * mine.count(term) + 8 * m)) for term in plain_terms(text) if term in mine)
                if score > 0:
                    found.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(found, key=lambda row: row[:3])[:keep], 1)]
    return sorted(rows, key=str)


def test_terms_of_slices():
    texts = ["aa B", "Cc_dd\x7fE-9", None, "", "ÀÉ x\x1cy", "  ", "日本 語"] * 3
    for start in range(len(texts)):
        part = texts[start : start + 5]
        terms, counts = ranked_search.terms_of(pa.array(texts).slice(start, 5))
        assert counts.tolist() == [len(plain_terms(text)) for text in part]
        assert terms.to_pylist() == [term for text in part for term in plain_terms(text)]


@pytest.mark.parametrize("block", [4, 8192])
def test_against_scores_of_every_document(spark, monkeypatch, block):
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    rng = random.Random(5)
    vocabulary = [f"w{at}" for at in range(150)]
    texts = [" ".join(rng.choice(vocabulary[: rng.choice([5, 40, 150])]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    docs = [(rng.randint(0, 90), text) for text in texts] + [(None, texts[3]), (None, texts[3]), (4, None), (5, "..."), (6, "W1 W1")]
    docs += [(at, texts[7]) for at in range(300, 330)]
    items = [(1, " ".join(vocabulary[:100]) + " w3 w3"), (2, texts[7]), (2, "w1"), (None, "w2, W2"), (3, ""), (4, None), (5, "unknown"), (6, "w149 unknown w5")]
    got = ranked_search.search(docs_of(spark, docs), items_of(spark, items), 7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(row) for row in got.collect()), key=str) == plain_search(docs, items, 7)


def test_items_are_searched_in_blocks(spark, monkeypatch):
    docs = [(at, f"a{at % 7} b{at % 5} c") for at in range(60)]
    items = [(at, f"a{at} c") for at in range(7)]
    whole = sorted(tuple(row) for row in ranked_search.search(docs_of(spark, docs), items_of(spark, items), 3).collect())
    monkeypatch.setattr(ranked_search, "ITEMS_BYTES", 10)
    assert sorted(tuple(row) for row in ranked_search.search(docs_of(spark, docs), items_of(spark, items), 3).collect()) == whole
    assert whole == sorted(plain_search(docs, items, 3))


def test_empty_tables(spark):
    docs, items = docs_of(spark, [(1, "a")]), items_of(spark, [(1, "a")])
    assert ranked_search.search(docs_of(spark, []), items).count() == 0
    assert ranked_search.search(docs, items_of(spark, [])).count() == 0
    assert ranked_search.search(docs_of(spark, [(1, None)]), items).count() == 0


def test_groups_end_early_and_never_too_early():
    """Bounds hold for every document of a group, and low groups are not evaluated."""
    rng = np.random.default_rng(2)
    scale = ranked_search.Scale(1000, 50_000)
    rows = [np.unique(rng.integers(0, 80, rng.integers(1, 40))).astype(np.uint32) for _ in range(500)]
    counts = [rng.integers(1, 9, len(row)).astype(np.uint32) for row in rows]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(500)), pa.array([int(c.sum()) for c in counts]), pa.array([r.tobytes() for r in rows]), pa.array([c.tobytes() for c in counts])],
        names=["doc_id", "n_terms", "terms", "counts"],
    )
    block = ranked_search.Block(batch, scale)
    terms = np.arange(0, 75, dtype=np.int64)  # more than one lane of bits
    weights = rng.integers(1, 3000, len(terms))
    weight_of = np.zeros(80, np.int64)
    weight_of[terms] = weights
    docs, limits, bounds = block.groups(terms, weights)
    scores = block.scores(docs, weight_of)
    assert (np.diff(bounds) <= 0).all() and (scores <= np.repeat(bounds, np.diff(limits))).all()
    mine = [frozenset(row[row < 75].tolist()) for row in rows]
    groups = [{mine[doc] for doc in docs[a:b]} for a, b in zip(limits[:-1], limits[1:], strict=True)]
    assert all(len(group) == 1 for group in groups) and len(groups) == len({g for g in mine if g})
    evaluated = []
    original = block.scores
    block.scores = lambda chosen, weight: evaluated.extend(chosen) or original(chosen, weight)
    best = ranked_search.search_block(block, terms, weights, weight_of, [], 3)
    assert [score for score, _ in best] == sorted(scores.tolist(), reverse=True)[:3]
    assert len(evaluated) < len(docs)


def test_query_matches_the_oracle(spark):
    assert difference(QUERIES["op12_ranked_search"](spark, TABLES), connect(TABLES), ORACLE["op12_ranked_search"]) is None
