"""The corpus run, stage by stage, against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from test_near_dedup import plain_groups
from test_packing import check_packed

from winback.llm import common, mixing
from winback.llm.common import shared_path, stored
from winback.llm.near_dedup import Rule

#: the columns of documents, and some that operators use themselves
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, rate string, text_key int, row string, component bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def planted():
    """(doc_id, text) and labels: clean, toxic and low-quality texts, exact and near copies, rows without id or text."""
    random.seed(17)
    vocabulary = ["".join(random.choices("abcdeilnorst", k=random.randint(3, 9))) for _ in range(1200)]
    words = lambda count: random.choices(vocabulary, k=count)
    rows, labels = [], []
    for at in range(300):
        body = words(random.randint(30, 120))
        toxic, low = at % 6 == 0, at % 6 == 1
        if toxic:
            body[7:7] = ["vilest", "grubword", "spiteful"]
        if low:
            body = [word + "!!!" for word in body[:4] * 10]
        rows.append((at, " ".join(body)))
        if at < 240:
            labels.append((at, int(not low), int(toxic)))
    clean = [text for at, text in rows if at % 6 > 1]
    rows += [(400 + at, text.replace(" ", "  \n")) for at, text in enumerate(clean[:20])]
    near = lambda text: " ".join([*text.split()[:-1], "otherend"])
    rows += [(500 + at, near(text)) for at, text in enumerate(clean[30:50]) if len(text.split()) >= 60]
    rows += [(None, "a text without any id " * 6), (None, "a text without any id " * 6), (None, None), (700, ""), (701, "long " * 3000)]
    return rows, labels


@pytest.fixture(scope="module")
def stages(spark):
    """The rows each stage took and gave."""
    rows, labels = planted()
    folder = shared_path(spark, "pipeline-test")
    docs = spark.createDataFrame([(*row, "en", "src", 5, True, "x", 7, "y", 9) for row in rows], DOCS).repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    found, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        path = shared_path(spark, f"pipeline-test-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        found[name] = given, docs
    return folder, found


def texts_of(df):
    return [(row["doc_id"], row["text"]) for row in df.collect()]


def test_stages_and_columns(stages):
    _, found = stages
    assert list(found) == ["toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "best_fit_packing"]
    for name, (given, got) in found.items():
        if name != "best_fit_packing":
            assert sorted(got.columns) == sorted(given.columns)
            others = [column for column in given.columns if column not in ("doc_id", "text")]
            assert got.select(others).distinct().collect() == given.select(others).distinct().collect()


def test_toxic_texts_go_and_clean_ones_stay(stages):
    given, got = stages[1]["toxicity"]
    before, after = Counter(texts_of(given)), Counter(texts_of(got))
    gone = before - after
    assert not after - before
    assert {doc_id for doc_id, text in gone if "grubword" in (text or "")} == {at for at in range(0, 300, 6)}
    assert all("grubword" in (text or "") for _, text in gone)


def test_of_equal_texts_the_smallest_id_stays(stages):
    given, got = stages[1]["exact_dedup"]
    groups = {}
    for doc_id, text in texts_of(given):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    order = lambda doc_id: (doc_id is None, doc_id or 0)
    expected = sorted((re.sub("x", "x", text), str(min(ids, key=order))) for text, ids in groups.items())
    assert sorted((re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), str(doc_id)) for doc_id, text in texts_of(got)) == expected
    assert len(expected) < given.count()


def test_one_text_of_each_near_group_stays(stages):
    given, got = stages[1]["minhash_near_dedup"]
    rows = texts_of(given)
    groups = {}
    for at, (_, root) in plain_groups([(at, text) for at, (_, text) in enumerate(rows)], Rule(5, 80)).items():
        groups.setdefault(root, []).append(rows[at])
    order = lambda row: (row[0] is None, row[0] or 0)
    left = texts_of(got)
    assert len(left) == len(groups) < len(rows)
    for group in groups.values():
        assert min(map(order, group)) in [order(row) for row in left if row in group]


def test_rows_are_taken_at_their_rates(spark, stages):
    folder, found = stages
    given, got = found["mixing"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rated = mixing.mix(given, labels, corpus_pipeline.MIX).collect()
    rates = {row["doc_id"]: row["rate"] for row in rated}
    rows = texts_of(given)
    assert len({doc_id for doc_id, _ in rows}) == len(rows)  # one row an id by now
    taken = mixing.copies([row[0] for row in rows], np.array([rates[row[0]] for row in rows]), [row[1] or "" for row in rows])
    expected = Counter({row: int(count) for row, count in zip(rows, taken, strict=True) if count})
    assert Counter(texts_of(got)) == expected
    clean = [doc_id for doc_id, _ in rows if doc_id is not None and doc_id < 300 and doc_id % 6 > 1]
    assert sum(rates[doc_id] > 0.5 for doc_id in clean) > 0.95 * len(clean)


def test_all_pieces_are_packed(stages):
    given, got = stages[1]["best_fit_packing"]
    check_packed(got.collect(), texts_of(given), 1024)


def test_the_whole_run_equals_its_stages_and_leaves_no_intermediates(spark, stages):
    from pathlib import Path

    folder, found = stages
    checkpoints = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(checkpoints.iterdir())
    tables = {table.name for table in spark.catalog.listTables()}
    got = corpus_pipeline.run(spark, folder)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: Counter(tuple(row) for row in df.select(names).collect())
    assert rows(got) == rows(found["best_fit_packing"][1])
    left = [path.name for path in set(checkpoints.iterdir()) - before if path.name.startswith("pipeline-") and any(path.glob("*.parquet"))]
    assert len(left) == 1 and left[0].startswith("pipeline-best_fit_packing")
    assert {table.name for table in spark.catalog.listTables()} == tables


def test_an_empty_table(spark):
    folder = shared_path(spark, "pipeline-empty")
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_small_tables_have_few_files_however_wide_their_shuffle(spark, monkeypatch):
    monkeypatch.setattr(common, "FILES_A_CORE", 2)
    cores = spark.sparkContext.defaultParallelism
    path = shared_path(spark, "few files=é")  # a folder whose name is written otherwise in a URI
    spark.range(5000).selectExpr("id % 700 AS key", "id").repartition(3).write.parquet(path)
    wide = spark.read.parquet(path).repartition(90, "key").withColumn("number", common.F.monotonically_increasing_id())
    files = lambda df: len(df.inputFiles())
    kept = stored(wide, "few")
    assert files(kept) == 2 * cores
    assert kept.select("key", "id").exceptAll(spark.read.parquet(path)).isEmpty()
    assert kept.count() == kept.select("number").distinct().count() == 5000
    # a large table keeps its partitions, and so does one whose size is not known
    monkeypatch.setattr(common, "FILE_BYTES", 10)
    assert files(stored(wide, "few")) == 90
    monkeypatch.undo()
    assert files(stored(spark.range(5000).repartition(90, "id"), "few")) == 90
