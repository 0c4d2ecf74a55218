"""N-gram Jaccard join against all pairs by brute force."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from compare import connect, difference
from conftest import TABLES
from test_near_dedup import awkward_rows, docs_of, edited, plain_groups, plain_set, words

from winback.llm import ngram_join
from winback.llm.ngram_join import Threshold
from winback.llm.oracle import ORACLE
from winback.llm.queries import QUERIES


@pytest.mark.parametrize("threshold", [Threshold(4, 85), Threshold(5, 80), Threshold(1, 60)])
def test_groups_against_all_pairs(spark, threshold):
    rows = awkward_rows()
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in ngram_join.similar_groups(docs_of(spark, rows), threshold).collect()}
    assert got == plain_groups(rows, threshold)


def test_hot_parts_and_small_tiles_against_all_pairs(spark, monkeypatch):
    for name, value in (("HOT_SHARE", 3000), ("COLUMNS", 8), ("ROWS", 3), ("TILE_GRAMS", 900)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = awkward_rows()
    threshold = Threshold(4, 85)
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in ngram_join.similar_groups(docs_of(spark, rows), threshold).collect()}
    assert got == plain_groups(rows, threshold)


def test_all_links_against_all_pairs(spark):
    rows = awkward_rows()
    threshold = Threshold(4, 85)
    links, membership = ngram_join.similar_classes(docs_of(spark, rows), threshold)
    members = {}
    for row in membership.collect():
        members.setdefault(row["rep"], []).append(row["doc_id"])
    sets = {doc_id: plain_set(text, 4) for doc_id, text in rows}
    assert {frozenset(ids) for rep, ids in members.items() if rep is not None} == {
        frozenset(other for other in sets if sets[other] == mine) for mine in sets.values() if mine
    }
    assert sorted(members[None]) == sorted(doc_id for doc_id, mine in sets.items() if not mine)
    found = {frozenset((sets[members[row["a"]][0]], sets[members[row["b"]][0]])) for row in links.collect()}
    different = list({mine for mine in sets.values() if mine})
    wanted = {
        frozenset((x, y)) for at, x in enumerate(different) for y in different[:at] if x & y and 100 * len(x & y) >= 85 * len(x | y)
    }
    assert found == wanted and len(wanted) > 100


def test_clashing_and_null_ids(spark):
    random.seed(12)
    x, y = words(60), words(60)
    near = lambda base: " ".join([*base[:59], "changed"])
    rows = [(3, near(x)), (7, " ".join(x)), (7, " ".join(y)), (9, " ".join(y)), (None, near(y)), (None, "one text"), (None, None), (8, None), (7, " ".join(x))]
    got = sorted(map(str, (tuple(row) for row in ngram_join.similar_groups(docs_of(spark, rows)).collect())))
    wanted = [(3, 56, 3), (7, 56, 3), (7, 56, 7), (9, 56, 7), (None, 56, 7), (None, 1, None), (None, 0, None), (8, 0, 8), (7, 56, 3)]
    assert got == sorted(map(str, wanted))
    assert ngram_join.similar_groups(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("threshold", [Threshold(1, 85), Threshold(1, 80), Threshold(1, 50)])
def test_linked_sets_always_share_a_part(threshold):
    """Pairs at the very limit, of all small sizes and some large, also where parts are empty."""
    rng = np.random.default_rng(4)
    checked = 0
    with np.errstate(over="ignore"):
        for size in [*range(1, 60), *range(60, 1500, 97)]:
            for _ in range(12):
                # crowd the hashes, so that many parts are empty
                span = 2 ** int(rng.integers(40, 64))
                pool = np.unique(rng.integers(0, span, 3 * size, np.uint64))
                x = np.sort(rng.permutation(pool)[:size])
                gone = int(rng.integers(0, size - int(np.ceil(threshold.percent * size / 100)) + 1))
                kept = np.sort(rng.permutation(x)[: len(x) - gone])
                spare = np.setdiff1d(pool, x)
                room = 100 * len(kept) // threshold.percent - len(x)
                y = np.union1d(kept, rng.permutation(spare)[: max(0, min(room, len(spare)))])
                both = len(np.intersect1d(x, y))
                if len(x) == len(y) == both or 100 * both < threshold.percent * (len(x) + len(y) - both):
                    continue
                checked += 1
                keys, owners = ngram_join.part_keys([x, y], threshold)
                assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist()), (size, len(y), both)
    assert checked > 200


def test_products_against_plain_intersections():
    rng = np.random.default_rng(6)
    threshold = Threshold(1, 80)
    base = rng.integers(0, 2**63, 200, np.uint64) * np.uint64(2)
    sets = [np.unique(np.where(rng.random(200) < share, rng.integers(0, 2**63, 200, np.uint64), base)) for share in np.linspace(0, 0.4, 40)]
    sets += [np.zeros(0, np.uint64), base[:1], np.sort(base[:170])]
    found = {(at, other) for at, others in ngram_join.products(sets, sets, threshold) for other in others.tolist()}
    wanted = set()
    for at, x in enumerate(sets):
        for other, y in enumerate(sets):
            both = len(np.intersect1d(x, y))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                wanted.add((at, other))
    assert found == wanted


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_ngram_join"](spark, folder)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in got.collect()} == plain_groups(rows, Threshold(4, 85))


def test_edited_copies_are_one_group(spark):
    random.seed(21)
    base = words(150)
    rows = [(at, " ".join(edited(base, 0.01))) for at in range(300)] + [(900 + at, " ".join(words(40))) for at in range(30)]
    got = {row["doc_id"]: row["component_id"] for row in ngram_join.similar_groups(docs_of(spark, rows), Threshold(4, 80)).collect()}
    assert got == {doc_id: root for doc_id, (_, root) in plain_groups(rows, Threshold(4, 80)).items()}


def test_query_matches_the_oracle(spark):
    assert difference(QUERIES["op11_ngram_join"](spark, TABLES), connect(TABLES), ORACLE["op11_ngram_join"]) is None


def test_released_tables_are_gone_and_others_stay(spark):
    from winback.llm.common import release, stored

    kept, gone = (stored(spark.range(10), name) for name in ("kept", "gone"))
    folder = gone.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    release(gone)
    assert not Path(folder).exists() and kept.count() == 10
