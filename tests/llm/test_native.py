"""Exact dedup, url rules and sharding on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from compare import connect, difference
from conftest import TABLES

from pyspark.sql import functions as F

from winback.llm import exact_dedup, sharding, url_filter
from winback.llm.common import LOWEST_LONG, bounds_at_or_below, long_array, shared_path
from winback.llm.oracle import ORACLE
from winback.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, kept string, text_sha256 int, shard int, `key` int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, 3) for row in rows], DOCS)


@pytest.mark.parametrize("name", ["op2_url_filter", "op5_exact_dedup"])
def test_query_matches_the_oracle(spark, name):
    assert difference(QUERIES[name](spark, TABLES), connect(TABLES), ORACLE[name]) is None


def test_binary_search_counts_bounds(spark):
    from pyspark.sql import functions as F

    bounds = [-5, 0, 0, 7, 100]
    rows = spark.createDataFrame([(v,) for v in (-9, -5, -1, 0, 6, 7, 99, 100, 10**12)], "v bigint")
    for count in range(len(bounds) + 1):
        at = bounds_at_or_below([long_array(bounds[:count])], [F.col("v")], count)
        for row in rows.withColumn("at", at).collect():
            assert row["at"] == sum(bound <= row["v"] for bound in bounds[:count])


# --- exact dedup ----------------------------------------------------------------------------

ROWS = [
    (3, "a  b"), (1, "a\tb"), (2, "a b"), (9, None), (4, ""), (5, " "), (None, "a\n\x0b b"), (7, "A b"),
    (8, "x" * 50_000), (6, "x" * 50_000), (6, "x" * 50_000), (None, "alone"), (None, "alone"), (11, "a\xa0b"),
]


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return groups


@pytest.mark.parametrize("hot_parts", [1000, 3])
def test_dedup_of_one_batch(spark, hot_parts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_PARTS", hot_parts)
    index = exact_dedup.DigestIndex.scratch(spark, buckets=3)
    docs = docs_of(spark, ROWS)
    judged = exact_dedup.deduplicate(docs, index)
    rows = judged.collect()
    assert len(rows) == len(ROWS)
    for text, ids in expected_groups(ROWS).items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        mine = [row for row in rows if row["text_sha256"] == digest]
        known = [i for i in ids if i is not None]
        assert {row["keep_id"] for row in mine} == {min(known) if known else None}
        assert {row["group_size"] for row in mine} == {len(ids)}
        assert [row["kept"] for row in mine].count(True) == 1
        assert all(row["doc_id"] == row["keep_id"] for row in mine if row["kept"])
    left = exact_dedup.keep_first(docs, judged)
    assert left.columns == docs.columns
    assert sorted(str(row["doc_id"]) for row in left.collect()) == sorted(
        str(min([i for i in ids if i is not None], default=None)) for ids in expected_groups(ROWS).values()
    )


def test_index_is_kept_and_appended_to(spark):
    path = shared_path(spark, "index-test")
    index = exact_dedup.DigestIndex.open(spark, path, "index_test_a", buckets=2)
    exact_dedup.deduplicate(docs_of(spark, [(5, "one"), (6, "two")]), index).collect()
    # the same files under another name, as a later session would open them
    later = exact_dedup.DigestIndex.open(spark, path, "index_test_b", buckets=2)
    second = docs_of(spark, [(1, "one"), (2, "three"), (3, "three")])
    got = {row["doc_id"]: (row["keep_id"], row["kept"], row["group_size"]) for row in exact_dedup.deduplicate(second, later).collect()}
    assert got == {1: (5, False, 1), 2: (2, True, 2), 3: (2, False, 2)}
    assert later.rows.count() == 3
    assert exact_dedup.deduplicate(docs_of(spark, []), later).count() == 0
    plan = later.rows.join(index.rows.hint("merge"), "text_sha256", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_batch_that_is_run_again_gets_the_same_verdicts(spark, monkeypatch):
    index = exact_dedup.DigestIndex.open(spark, shared_path(spark, "index-test"), "index_test_again", buckets=2)
    exact_dedup.deduplicate(docs_of(spark, [(5, "one")]), index, batch="first").collect()
    rows = [(1, "one"), (2, "two"), (3, "two"), (None, "three")]
    verdicts = lambda: sorted(
        (str(row["doc_id"]), str(row["keep_id"]), row["kept"]) for row in exact_dedup.deduplicate(docs_of(spark, rows), index, batch="second").collect()
    )
    expected = [("1", "5", False), ("2", "2", True), ("3", "2", False), ("None", "None", True)]
    # dies after the index has learned of the batch, before anything is done with its verdicts
    with monkeypatch.context() as broken:
        broken.setattr(exact_dedup, "join_groups", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            verdicts()
    assert index.rows.count() == 3
    assert verdicts() == expected and verdicts() == expected
    assert index.rows.count() == 3
    # another batch knows them all
    other = exact_dedup.deduplicate(docs_of(spark, rows), index, batch="third").collect()
    assert not any(row["kept"] for row in other) and index.rows.count() == 3


def test_two_batches_at_once_and_compaction(spark):
    index = exact_dedup.DigestIndex.open(spark, shared_path(spark, "index-test"), "index_test_twice", buckets=3)
    groups = spark.createDataFrame([("d1", 7, 1), ("d2", 8, 1)], "text_sha256 string, keep_id bigint, first_rows bigint")
    index.append(groups, "left")
    index.append(groups.withColumn("keep_id", F.lit(6).cast("bigint")), "right")
    assert index.rows.count() == 4
    assert sorted(tuple(row) for row in index.known(without="third").collect()) == [("d1", 6), ("d2", 6)]
    small = index.compact(shared_path(spark, "index-test"), "index_test_small", 2)
    assert sorted((row["text_sha256"], row["keep_id"], row["batch"]) for row in small.rows.collect()) == [("d1", 6, "right"), ("d2", 6, "right")]
    # the number of buckets is the index's own
    assert exact_dedup.DigestIndex.open(spark, small.path, "index_test_small_again", buckets=64).buckets == 2
    small.drop()
    assert not spark.catalog.tableExists("index_test_small")


# --- url rules ------------------------------------------------------------------------------

URLS = [
    "http://example.com/en/a", "http://WWW.Example.com/en/a?x", "https://a.b.example.com/en/", "http://example.com/en",
    "http://example.com", "http://example.com?/en/", "http://xexample.com/en/1", "ftp://net/es/", "http://a.net/fr/#x", "http://a.net/de/",
    "no scheme", "", None, "://", "http://example.com:80/en/", "http://.com/", "http://com./", "http://com-x.com/", "http://a..com/x",
    "http://www.example.com/EN/", "http://example.com/en/" + "y" * 20_000, "x://y://example.com/en/", "http://é.example.com/en/\n#", "http://a\x01.net/es/",
]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=(None, None, "allow"))
    return host, path, None if best[0] is None else best[0] + best[1], best[2]


@pytest.mark.parametrize("more", [[], [("a.net", "/fr/", "allow"), ("a.net", "/fr/", "block"), ("b.example.com", "/", "block"), (None, "/", "block"), ("org", "", "block")]])
def test_urls_against_every_rule(spark, more):
    urls = URLS + ["http://hot.example.com/en/"] * 60 + [f"http://s{i % 7}.net/{'es' if i % 2 else 'xx'}/{i}" for i in range(80)]
    pages = spark.createDataFrame([(i, url, "h", "r") for i, url in enumerate(urls)], "page_id bigint, url string, html string, rule string")
    rules = [*url_filter.RULES, *more]
    got = url_filter.judge_urls(pages, url_filter.rule_frame(spark, rules)).collect()
    whole = [rule for rule in rules if None not in rule]
    assert len(got) == len(urls)
    for row in got:
        assert tuple(row)[1:] == plain_verdict(urls[row["page_id"]], whole), urls[row["page_id"]]


def test_no_urls_or_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    rules = url_filter.rule_frame(spark, url_filter.RULES)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert [row["verdict"] for row in url_filter.judge_urls(pages, rules.limit(0), "block").collect()] == ["block"]


# --- sharding -------------------------------------------------------------------------------


def check_shards(rows, texts, shards):
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
        assert 0 <= row["shard"] < shards
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    assert sorted((row["size"], row["text_crc32"]) for row in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts
    )


def test_shards_of_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "é" * 10), (3, "x" * 30_000), (None, "x" * 30_000)]
    got = sharding.shard_documents(docs_of(spark, rows), 4).collect()
    check_shards(got, [text for _, text in rows], 4)
    assert sharding.shard_documents(docs_of(spark, []), 4).count() == 0


@pytest.mark.parametrize("copies", [0, 3000])
def test_shards_are_even_even_with_a_third_of_copies(spark, copies):
    random.seed(3)
    texts = ["w" * random.randint(0, 400) + str(i) for i in range(6000)] + ["c" * 300] * copies + [""] * copies
    got = sharding.shard_documents(docs_of(spark, enumerate(texts)), 8).collect()
    check_shards(got, texts, 8)
    sums = defaultdict(int)
    for row in got:
        sums[row["shard"]] += row["size"]
    mean = sum(sums.values()) / 8
    assert len(sums) == 8 and max(abs(size - mean) for size in sums.values()) < 0.03 * mean
    if not copies:  # equal texts stand together where their range is not overfull
        again = sharding.shard_documents(docs_of(spark, enumerate(texts + texts[:2000])), 8).collect()
        homes = defaultdict(set)
        for row in again:
            homes[row["text_crc32"]].add(row["shard"])
        assert max(map(len, homes.values())) == 1


def test_equal_rows_are_divided_too(spark):
    random.seed(5)
    rows = [(i, "w" * random.randint(0, 400) + str(i)) for i in range(6000)] + [(None, "c" * 300)] * 3000
    got = sharding.shard_documents(docs_of(spark, rows), 8).collect()
    check_shards(got, [text for _, text in rows], 8)
    sums = defaultdict(int)
    for row in got:
        sums[row["shard"]] += row["size"]
    mean = sum(sums.values()) / 8
    assert len(sums) == 8 and max(abs(size - mean) for size in sums.values()) < 0.03 * mean


def test_sharding_query_against_its_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op9_sharding"](spark, folder).collect()
    check_shards(rows, [row["text"] for row in docs], 16)
    texts = {row["doc_id"]: (row["text"] or "").encode() for row in docs}
    assert all((row["size"], row["text_crc32"]) == (len(texts[row["doc_id"]]) + 1, zlib.crc32(texts[row["doc_id"]])) for row in rows)
    assert {(row["law"], row["grown_shard"]) for row in rows} == {("bytes", None)}
    sums = defaultdict(int)
    for row in rows:
        sums[row["shard"]] += row["size"]
    mean = sum(sums.values()) / 16
    # no shard is farther from its share than its largest rows explain
    assert len(sums) == 16 and max(abs(size - mean) for size in sums.values()) <= 0.05 * mean + max(row["size"] for row in rows)


def test_ranges_subdivide_a_hot_text(spark):
    rows = sharding.measure(docs_of(spark, [(i, "same") for i in range(4000)]))
    plan = sharding.plan_shards(rows, 4)
    assert len({key[0] for key in plan.splitters}) == 1 and len(plan.splitters) > 50
    assert min(key[1] for key in plan.splitters) >= LOWEST_LONG


def test_written_shards_hold_every_row(spark):
    docs = docs_of(spark, [(i, f"text {i % 50}") for i in range(300)]).drop("shard")
    path = shared_path(spark, "shards-test")
    sharding.write_shards(docs, path, 3)
    back = spark.read.parquet(path)
    assert back.count() == 300 and {row[0] for row in back.select("shard").distinct().collect()} == {0, 1, 2}
