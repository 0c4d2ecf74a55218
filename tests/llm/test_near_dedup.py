"""Near-duplicate groups against all pairs by brute force."""

from __future__ import annotations

import random
import re
from math import comb

import numpy as np
import pytest

from winback.llm import near_dedup
from winback.llm.near_dedup import Rule
from winback.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, kept int, component_id int, rep int, signature int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], DOCS).repartition(3)


def plain_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def plain_groups(rows, rule):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {doc_id: plain_set(text, rule.width) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    having = {}
    for i in ids:
        seen = {}
        for shingle in sets[i]:
            for j in having.setdefault(shingle, []):
                seen[j] = seen.get(j, 0) + 1
            having[shingle].append(i)
        for j, both in seen.items():
            if 100 * both >= rule.percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def words(n):
    return [random.choice("abcdefgh") + str(random.randint(0, 9999)) for _ in range(n)]


def edited(base, share):
    return [random.choice(words(1)) if random.random() < share else word for word in base]


def awkward_rows():
    random.seed(4)
    rows = [(0, None), (1, ""), (2, " \t"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "two one"), (7, "a b c"), (8, "a  b\nc"), (9, "É b c"), (10, "é b c")]
    rows += [(20, "x " * 3000), (21, "x " * 40), (22, "same words here now"), (23, "same words here now")]
    at = 100
    for size, share in ((40, 0.01), (40, 0.02), (30, 0.03), (25, 0.045)):
        base = words(120)
        rows += [(at + i, " ".join(edited(base, share))) for i in range(size)]
        at += size
        rows.append((at, " ".join(base)))
        at += 1
    passage = words(60)
    for _ in range(60):
        rows.append((at, " ".join(words(30) + passage + words(random.randint(0, 40)))))
        at += 1
    return rows


@pytest.mark.parametrize("rule", [Rule(3, 85), Rule(5, 80)])
def test_groups_against_all_pairs(spark, rule):
    rows = awkward_rows()
    got = {row["doc_id"]: row for row in near_dedup.near_groups(docs_of(spark, rows), rule).collect()}
    plain = plain_groups(rows, rule)
    assert {i: (row["n_shingles"], row["component_id"]) for i, row in got.items()} == plain
    assert all(row["kept"] == (i == row["component_id"]) for i, row in got.items())
    assert len({component for _, component in plain.values()}) < len(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "only here without id"), (3, "x y z u v w")]
    docs = docs_of(spark, rows)
    got = sorted(map(str, (tuple(row) for row in near_dedup.near_groups(docs).collect())))
    assert got == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, None, True), (3, 2, 3, True)]))
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(str(row["doc_id"]) for row in left.collect()) == ["1", "3", "None"]
    assert near_dedup.near_groups(docs_of(spark, [])).count() == 0


def test_bands_and_batches_keep_their_promise():
    for rule in (Rule(3, 85), Rule(5, 80)):
        assert (1 - (rule.percent / 100) ** rule.rows) ** (near_dedup.HASHES // rule.rows) <= near_dedup.MISS
    least = near_dedup.least_matches(20, 0.85)
    # posterior with a uniform prior, by numerical integration
    x = np.linspace(0, 1, 200_001)
    for matches, kept in ((least, True), (least - 1, False)):
        density = x**matches * (1 - x) ** (20 - matches) * comb(20, matches)
        assert (density[x >= 0.85].sum() / density.sum() >= near_dedup.MISS) == kept
    left = np.zeros((3, near_dedup.HASHES), np.uint32)
    right = left.copy()
    right[1, ::2] = 1
    right[2, ::9] = 1
    assert near_dedup.plausible(left, right, 0.85).tolist() == [True, False, True]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000, np.uint64)
    equal = near_dedup.signature(pool[:2000]) == near_dedup.signature(pool[200:2200])
    assert abs(equal.mean() - 1800 / 2200) < 0.13


def test_components_of_chains_and_stars(spark):
    random.seed(8)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 200), (300, 300)]
    random.shuffle(links)
    got = {tuple(row) for row in near_dedup.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(i, 100) for i in range(101, 150)} | {(201, 200)}


def test_groups_merge_by_later_links(spark):
    groups = spark.createDataFrame([(2, 1), (3, 1), (11, 10), (21, 20)], "rep bigint, component bigint")
    links = spark.createDataFrame([(3, 11), (11, 30), (41, 40), (2, 3)], "a bigint, b bigint")
    got = {tuple(row) for row in near_dedup.merged_groups(groups, links).collect()}
    assert got == {(2, 1), (3, 1), (11, 1), (10, 1), (30, 1), (21, 20), (41, 40)}


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in QUERIES["op6_near_dedup"](spark, folder).collect()}
    assert got == plain_groups(rows, Rule(3, 85))


def test_word_hashes_of_a_slice_are_those_of_its_texts():
    import pyarrow as pa

    from winback.llm.words import word_hashes

    texts = ["aa b", "cc dd ee", " f g\n", None, "", "HH ii jj kk", "ll mm"] * 3
    for start in range(len(texts)):
        hashes, counts = word_hashes(pa.array(texts).slice(start, 5))
        wanted, wanted_counts = word_hashes(pa.array(texts[start : start + 5], pa.string()))
        assert hashes.tolist() == wanted.tolist() and counts.tolist() == wanted_counts.tolist()


def test_clashing_and_null_ids_against_all_pairs(spark):
    random.seed(11)
    x, y, z, n = words(60), words(60), words(60), words(60)
    near = lambda base, at: " ".join([*base[:at], "changed", *base[at + 1 :]])
    # X is near X', Y is not; whichever of 7's texts were searched alone, the other would be lost or keep a wrong group
    rows = [(3, near(x, 59)), (7, " ".join(x)), (7, " ".join(y)), (9, " ".join(y)), (5, near(y, 0)), (7, " ".join(z)), (8, near(z, 0)), (8, near(x, 0))]
    # groups with no id at all, and with one id only at a near copy
    rows += [(None, " ".join(n)), (None, near(n, 0)), (None, near(n, 59)), (None, near(z, 59)), (None, "one text"), (None, None), (8, None)]
    rule = Rule(3, 85)
    groups = {}
    for at, (_, root) in plain_groups([(at, text) for at, (_, text) in enumerate(rows)], rule).items():
        groups.setdefault(root, []).append(rows[at])
    order = lambda row: (row[0] is None, row[0] or 0)
    expected = [(doc_id, min(group, key=order)[0]) for group in groups.values() for doc_id, _ in group]
    docs = docs_of(spark, rows)
    found = near_dedup.near_groups(docs, rule).collect()
    assert sorted(map(str, [(row["doc_id"], row["component_id"]) for row in found])) == sorted(map(str, expected))
    left = [(row["doc_id"], row["text"]) for row in near_dedup.keep_one(docs, rule).collect()]
    # one row of each group, of its smallest id
    assert len(left) == len(groups)
    for group in groups.values():
        stayed = [row for row in left if row in group]
        assert len(stayed) == 1 and order(stayed[0]) == min(map(order, group))
