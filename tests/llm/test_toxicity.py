"""The conditional random field: marginals against enumeration, spans, held-out accuracy."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from winback.llm import lexicon, toxicity
from winback.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, toxic int, score int, spans int, predicted int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], DOCS).repartition(3)


def enumerated(scores, trans):
    """Marginals of one sequence by summing over all taggings."""
    to_toxic, to_plain, stay, start = trans
    total, toxic = 0.0, np.zeros(len(scores))
    for tags in itertools.product((0, 1), repeat=len(scores)):
        value = start * tags[0] + sum(score * tag for score, tag in zip(scores, tags, strict=True))
        value += sum({(0, 0): 0, (0, 1): to_toxic, (1, 0): to_plain, (1, 1): stay}[pair] for pair in itertools.pairwise(tags))
        total += np.exp(value)
        toxic += np.exp(value) * np.array(tags)
    return toxic / total


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 1, 8, 5, 8, 0, 2])
    scores, trans = rng.normal(0, 2, lengths.sum()), rng.normal(0, 1, 4)
    chances = toxicity.marginals(scores, lengths, trans)
    for end, length in zip(np.cumsum(lengths), lengths, strict=True):
        if length:
            assert np.allclose(chances[end - length : end], enumerated(scores[end - length : end], trans))
    assert len(toxicity.marginals(np.zeros(0), np.zeros(0, int), trans)) == 0
    long = toxicity.marginals(rng.normal(0, 9, 200_000), np.array([200_000]), trans)
    assert np.isfinite(long).all() and long.min() >= 0 and long.max() <= 1


def test_training_climbs_to_the_gradient_zero():
    words = np.array([0, 1, 0, 2, 0, 1, 1, 0])
    tags = np.array([0, 1, 0, 0, 0, 1, 1, 0])
    table = np.array([lexicon.features(word) for word in ("calm", "vile", "plain")])
    weights, trans = toxicity.train_field(words, tags, np.array([4, 4]), table)
    chances = toxicity.marginals(weights[table].sum(axis=1)[words], np.array([4, 4]), trans)
    assert ((chances > 0.5) == tags).all()


def corpus(count, seed):
    random.seed(seed)
    for i in range(count):
        words = ["".join(random.choices("abcdeilnorst", k=random.randint(2, 8))) for _ in range(random.randint(20, 120))]
        label = int(i % 5 == 0)
        if label:
            for _ in range(random.randint(2, 4)):
                words.insert(random.randrange(len(words)), random.choice(["Vilest", "grubword", "spite" + random.choice("abcd")]))
        yield i, " ".join(words), label


@pytest.fixture(scope="module")
def trained(spark):
    rows = list(corpus(600, 1))
    docs = docs_of(spark, [(i, text) for i, text, _ in rows])
    labels = spark.createDataFrame([(i, label, "z") for i, _, label in rows] + [(None, 1, "z"), (7, None, "z"), (9999, 1, "z")], "doc_id bigint, toxic int, text string")
    return toxicity.fit(docs, labels)


def test_unseen_texts_and_spans(spark, trained):
    rows = list(corpus(200, 2))
    odd = [(1000, None), (1001, ""), (None, "!!! ..."), (1002, "É vilest. GRUBWORD é"), (1003, "calm " * 60_000)] + [(1004, "some text")] * 3
    got = toxicity.score_documents(docs_of(spark, [(i, text) for i, text, _ in rows] + odd), trained).collect()
    assert len(got) == 200 + len(odd)
    labels = {i: label for i, _, label in rows}
    assert sum(row["predicted"] == labels[row["doc_id"]] for row in got if row["doc_id"] in labels) >= 196
    by_id = {row["doc_id"]: row for row in got}
    spans = by_id[1002]["spans"]
    assert spans[0]["start"] == 2 and spans[-1]["end"] >= 18
    empty = by_id[1000]["score"]
    assert empty == by_id[1001]["score"] == by_id[None]["score"] and 0 <= empty < 0.3
    assert by_id[1003]["predicted"] == 0 and all(0 <= row["score"] <= 1 for row in got)


def test_drop_toxic_keeps_columns(spark, trained):
    docs = docs_of(spark, [(1, "calm words"), (2, "vilest grubword vilest grubword"), (None, None)])
    left = toxicity.drop_toxic(docs, trained)
    assert left.schema == docs.schema and sorted(str(row["doc_id"]) for row in left.collect()) == ["1", "None"]


def test_without_both_classes(spark):
    docs = docs_of(spark, [(1, "a text"), (2, "b")])
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    for known in (labels, labels.limit(0)):
        scored = toxicity.score_documents(docs, toxicity.fit(docs, known)).collect()
        assert [row["predicted"] for row in scored] == [0, 0]
    assert toxicity.score_documents(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_copies_count_once():
    texts = ["a b c d e f", "a b c d e f", "u v w x y z", "", ""]
    keys = [(at, lexicon.copy_keys(text.split())) for at, text in enumerate(texts)]
    assert lexicon.without_copies(reversed(keys)) == [0, 2, 3]


def test_ids_kept_are_handed_on_without_workers_for_python_objects(spark, monkeypatch):
    given = []
    make = type(spark).createDataFrame

    def watched(self, data, *args, **options):
        given.append(type(data))
        return make(self, data, *args, **options)

    rows = [(1, 0, "one two three four"), (2, 0, "one two three four"), (3, 1, "five six seven eight"), (-(2**62), 1, "nine")]
    sample = spark.createDataFrame(rows, "doc_id bigint, label int, text string")
    none = sample.limit(0)
    monkeypatch.setattr(type(spark), "createDataFrame", watched)
    kept = lexicon.distinct_texts(sample, str.split)
    assert sorted(map(tuple, kept.collect())) == [(-(2**62), 1, "nine"), (1, 0, "one two three four"), (3, 1, "five six seven eight")]
    assert kept.columns == ["doc_id", "label", "text"] and lexicon.distinct_texts(none, str.split).count() == 0
    assert given == [pa.Table, pa.Table]


def test_passages_late_in_a_text_are_learned(spark):
    """Toxic words stand after word 10,000 of every toxic text, and nowhere else."""
    random.seed(9)
    vocabulary = ["".join(random.choices("abcdeilnorst", k=random.randint(2, 8))) for _ in range(1500)]
    plain = lambda count: " ".join(random.choices(vocabulary, k=count))
    rows, labels = [], []
    for i in range(80):
        toxic = i % 4 == 0
        rows.append((i, plain(10_100) + (" vilest grubword spiteful " if toxic else " ") + plain(50)))
        labels.append((i, int(toxic)))
    docs = docs_of(spark, rows)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known)
    unseen = [(900, plain(30) + " Vilest grubword spiteful " + plain(30)), (901, plain(80)), (902, plain(12_000) + " grubword spiteful vilest")]
    got = {row["doc_id"]: row for row in toxicity.score_documents(docs_of(spark, unseen), model).collect()}
    assert [got[i]["predicted"] for i in (900, 901, 902)] == [1, 0, 1]
    assert got[900]["spans"] and not got[901]["spans"]
    words = ["calm"] * 30_000
    tagged = [at in (5, 29_990) for at in range(30_000)]
    windows = toxicity.training_windows(3, words, tagged)
    assert sum(any(tags) for _, tags in windows) == 2 and len(windows) == 2 + toxicity.PLAIN_WINDOWS


def test_clashing_ids_give_one_model_whatever_the_layout(spark):
    rows = list(corpus(120, 4)) + [(i, "another vilest text " * 5, 0) for i in range(0, 120, 7)]
    labels = spark.createDataFrame([(i, label) for i, _, label in rows[:120]], "doc_id bigint, toxic int")
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id bigint, text string")
    models = [toxicity.fit(layout, labels) for layout in (docs.repartition(5), docs.orderBy(F.desc("text")).coalesce(1))]
    assert np.array_equal(models[0].weights, models[1].weights) and np.array_equal(models[0].calibration, models[1].calibration)


def test_held_out_rows_of_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    scored = {row["doc_id"]: row for row in QUERIES["op1_toxicity"](spark, folder).collect()}
    labels = [(row["doc_id"], row["toxic"]) for row in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    held = [(scored[i]["score"], label) for i, label in labels if scored[i]["held_out"]]
    pairs = [(a > b) + (a == b) / 2 for a, x in held for b, y in held if x == 1 and y == 0]
    assert len(scored) == 1000 and sum(pairs) / len(pairs) > 0.8
    clean = [scored[i]["predicted"] for i, label in labels if not label]
    assert sum(clean) <= 0.02 * len(clean)
