"""The Katz model against a plain recursive one, and chances that add up to one."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import TABLES

from winback.llm import katz
from winback.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, key int, score int, texts int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3) for row in rows], DOCS).repartition(3)


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


class Plain:
    def __init__(self, texts, share):
        found = [tokens(text) for text in texts]
        self.c = Counter(word for words in found for word in words)
        self.n = sum(self.c.values())
        self.v = len(self.c)
        d = self.factors(self.c)
        mass = sum(self.less(c, d) for c in self.c.values())
        total = self.n if mass < self.n - 1e-9 else self.n + 1
        self.p1 = {word: self.less(c, d) / total for word, c in self.c.items()}
        self.unknown = 1 - mass / total if self.n else 1.0
        self.vocabulary = {word for word, c in self.c.items() if c >= max(share * self.n, 1)} | {"\n"}
        self.p_class = {word: self.p1.get(word, 0.0) for word in self.vocabulary}
        self.p_class["<rare>"] = 1 - sum(self.p_class.values()) if self.n else 1.0
        pairs = Counter(pair for words in found for pair in self.pairs(words))
        self.d2 = self.factors(pairs)
        self.pairs_, self.contexts = pairs, {}
        for (context, word), c in pairs.items():
            self.contexts.setdefault(context, {})[word] = c

    @staticmethod
    def factors(counts):
        n = Counter(counts.values())
        plain = {r: (r - 0.5) / r for r in range(1, 6)}
        if all(n[r] for r in range(1, 7)):
            left = 6 * n[6] / n[1]
            if left < 1:
                turing = {r: ((r + 1) * n[r + 1] / (r * n[r]) - left) / (1 - left) for r in range(1, 6)}
                if all(0 < x < 1 for x in turing.values()):
                    return turing
        return plain

    @staticmethod
    def less(count, factors):
        return count * factors.get(count, 1.0)

    def name(self, word):
        return word if word in self.vocabulary else "<rare>"

    def pairs(self, words):
        names = [self.name(word) for word in words]
        return list(zip(["<begin>", *names], names, strict=False))

    def chance(self, context, word):
        """Of a class after a context."""
        seen = self.contexts.get(context)
        if not seen:
            return self.p_class[word]
        mass, count = sum(self.less(c, self.d2) for c in seen.values()), sum(seen.values())
        total = count if count - mass > 1e-9 else count + 1
        unseen = 1 - sum(self.p_class[other] for other in seen)
        if unseen <= 1e-12:
            total = mass
        if word in seen:
            return self.less(seen[word], self.d2) / total
        return (total - mass) / total / unseen * self.p_class[word]

    def score(self, text):
        words = tokens(text)
        total = 0.0
        for word, (context, name) in zip(words, self.pairs(words), strict=True):
            total += math.log10(self.chance(context, name))
            if name == "<rare>":
                total += math.log10(self.p1.get(word, self.unknown) / self.p_class["<rare>"])
        base = sum(math.log10((self.c[word] + 1) / (self.n + self.v + 1)) for word in words)
        return len(words), sum(self.c[word] > 0 for word in words), base, total


def texts(count, seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [" ".join(random.choices(vocabulary, weights, k=random.randint(0, 60))).replace("w1 ", "W1\t") for _ in range(count)]


@pytest.mark.parametrize("cached", [2.5e-7, 0.004, 0.0009])
def test_scores_against_a_plain_model(spark, monkeypatch, cached):
    monkeypatch.setattr(katz, "CACHED", cached)
    train, other = texts(150, 1), texts(40, 2)
    model = katz.train(docs_of(spark, enumerate(train)))
    plain = Plain(train, 0)
    rows = list(enumerate(train + other + [None, "", " ", "unknown words É", "w0 " * 20_000])) + [(3, train[3]), (None, "w0 w1"), (1, "w5 other text")]
    got = [tuple(row) for row in katz.score(docs_of(spark, rows), model).collect()]
    expected = []
    for doc_id, text in rows:
        n, known, base, score = plain.score(text)
        expected.append((doc_id, n, known, plain.n, base, score))
    order = lambda row: (row[0] is None, row[0] or 0, row[1], row[4])
    for mine, want in zip(sorted(got, key=order), sorted(expected, key=order), strict=True):
        assert mine[:4] == want[:4]
        assert mine[4:] == pytest.approx(want[4:], rel=1e-9, abs=1e-5)  # sums of 20,000 terms


def test_chances_add_up_to_one(spark):
    model = katz.train(docs_of(spark, [*enumerate(texts(150, 1)), (900, "only here"), (901, None)]))
    words = {row["key"]: row["chance"] for row in spark.read.parquet(f"{model.path}/order=1").collect()}
    assert sum(words.values()) + model.unknown == pytest.approx(1)
    alphas = {row["context"]: row["alpha"] for row in spark.read.parquet(f"{model.path}/contexts").collect()}
    seen = {context: {} for context in alphas}
    several = {row["place"]: row["context"] for row in model.places.table(spark).collect()}
    assert len(several) > len(model.places.contexts) > 10
    for found in katz.gained(spark, model, katz.F.lit(True)).collect():
        row = {**found.asDict(), "context": several.get(found["place"], found["place"])}
        # a gain is what the pair's logarithm is above that of backing off
        seen[row["context"]][row["word"]] = 10 ** row["gain"] * max(alphas[row["context"]], 1e-300) * words[row["word"]]
    assert len(seen) > 100
    for context, pairs in seen.items():
        others = 1 - sum(words[word] for word in pairs)
        assert sum(pairs.values()) + alphas[context] * others == pytest.approx(1), context


def test_without_texts(spark):
    model = katz.train(docs_of(spark, []))
    got = katz.score(docs_of(spark, [(1, "a b"), (2, None)]), model).collect()
    assert sorted((row["doc_id"], row["n_tokens"], row["n_known"], row["score"]) for row in got) == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)]
    assert katz.score(docs_of(spark, []), model).count() == 0


def test_query_beats_the_base_on_held_out_texts(spark):
    rows = QUERIES["op4_katz"](spark, TABLES).collect()
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").collect()
    assert len(rows) == len(docs)
    plain = Plain([row["text"] for row in docs if zlib.crc32(str(row["doc_id"]).encode()) % 7 != 2], 0)
    by_id = {row["doc_id"]: row for row in rows}
    for doc in docs:
        n, known, base, score = plain.score(doc["text"])
        row = by_id[doc["doc_id"]]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n, known, plain.n)
        assert (row["base_score"], row["score"]) == pytest.approx((base, score), rel=1e-9)
    held = [row for row in rows if row["held_out"]]
    assert held and np.sum([row["score"] for row in held]) > np.sum([row["base_score"] for row in held])


@pytest.mark.parametrize("cached", [2.5e-7, 0.004, 0.0009, 2.0])
def test_every_word_has_its_own_pairs(spark, monkeypatch, cached):
    monkeypatch.setattr(katz, "CACHED", cached)
    monkeypatch.setattr("winback.llm.katz.SPREAD", 50)
    monkeypatch.setattr("winback.llm.katz.HELD", 500)
    # w0 makes every other word rarer than a share of 2e-5; "seldom pair" still is a pair
    train = [*texts(60, 1), "w0 " * 150_000, "seldom pair", "seldom pair w3"]
    model = katz.train(docs_of(spark, enumerate(train)))
    plain = Plain(train, 0)
    rows = list(enumerate([*train, *texts(20, 2), "pair seldom pair", "unknown words É seldom", None, ""]))
    got = {row["doc_id"]: tuple(row) for row in katz.score(docs_of(spark, rows), model).collect()}
    for doc_id, text in rows:
        n, known, base, score = plain.score(text)
        assert got[doc_id][:4] == (doc_id, n, known, plain.n)
        assert got[doc_id][4:] == pytest.approx((base, score), rel=1e-9, abs=1e-5)  # sums of 150,000 terms


@pytest.mark.parametrize("lows", [(-4, 0), (-4, -1, 2), (-4, -3, -2, -1, 0, 1, 2, 3), (-4,)])
def test_questions_are_asked_in_parts(spark, monkeypatch, lows):
    monkeypatch.setattr(katz, "PARTS", tuple(low * 2**61 for low in lows))
    monkeypatch.setattr(katz, "SPREAD", 50)
    monkeypatch.setattr(katz, "CACHED", 0.004)
    train = [*texts(150, 1), "w0 " * 3000]
    model = katz.train(docs_of(spark, enumerate(train)))

    class Shared:
        value = model

    rows = list(enumerate([*train, *texts(20, 2), None, "", "seldom"]))
    columns = {"doc_id": [row[0] for row in rows], "text": [row[1] or "" for row in rows], "mark": [0] * len(rows), "row": [row[0] for row in rows]}
    asked = []
    for part, low in enumerate(katz.PARTS):
        told = [row for batch in katz._ask(Shared, part)(iter([pa.record_batch(columns)])) for row in batch.to_pylist()]
        assert sum(row["own"] is not None for row in told) == len(rows)
        asked.append({(row["row"], row["place"], row["word"]) for row in told if row["own"] is None})
        high = katz.PARTS[part + 1] if part + 1 < len(lows) else 2**63
        assert asked[-1] and all(low <= place < high for _, place, _ in asked[-1])
    assert max(map(len, asked)) < 1.6 * sum(map(len, asked)) * max(np.diff([*lows, 4])) / 8
    # busy contexts keep to the part of the context, on both sides
    assert len(model.places.table(spark).collect()) > len(model.places.contexts) > 3
    for row in model.places.table(spark).collect():
        assert katz.part_of(np.array([row["place"]])) == katz.part_of(np.array([row["context"]]))
    plain = Plain(train, 0)
    again = [*rows, (3, train[3]), (3, train[3]), (3, "other text of the id"), (None, train[3]), (None, train[3]), (None, None)]
    got = sorted(tuple(row) for row in katz.score(docs_of(spark, again), model).na.fill({"doc_id": -1}).collect())
    wanted = sorted((-1 if doc_id is None else doc_id, n, known, plain.n, base, score) for doc_id, text in again for n, known, base, score in [plain.score(text)])
    assert [row[:4] for row in got] == [row[:4] for row in wanted]
    for mine, want in zip(got, wanted, strict=True):
        assert mine[4:] == pytest.approx(want[4:], rel=1e-9, abs=1e-6)
    model.drop(spark)
    assert not spark.catalog.tableExists(model.pairs) and not spark.catalog.tableExists(katz.rare_of(model.pairs))


def test_counts_of_rare_words_are_stored_once(spark, monkeypatch):
    monkeypatch.setattr(katz, "CACHED", 0.004)
    model = katz.train(docs_of(spark, enumerate(texts(150, 1))))
    counts = {row["key"]: row["count"] for row in spark.read.parquet(f"{model.path}/order=1").collect()}
    pairs = spark.table(model.pairs).collect()
    rare = {(row["place"], row["word"]): row["seen"] for row in spark.table(katz.rare_of(model.pairs)).collect()}
    assert rare == {(row["place"], row["word"]): counts[row["word"]] for row in pairs if row["seen"] == 0} and rare
    assert all(row["seen"] in (0, counts[row["word"]]) for row in pairs)
    with katz.joined_in_place(spark):
        # pairs and the rare ones meet as they lie: only the contexts are moved
        plan = katz.gained(spark, model, katz.F.lit(True), 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(place") == 1, plan


def test_rows_are_handed_on_by_place(monkeypatch):
    monkeypatch.setattr(katz, "TOLD_ROWS", 7)
    random.seed(5)
    rows = [(random.choice([-(2**63), -1, 0, 5, 2**63 - 1]), at, random.randint(1, 9)) for at in range(100)]
    columns = zip(*rows, strict=True)
    table = pa.concat_tables([pa.table(dict(zip(("place", "word", "count"), map(list, columns), strict=True)))] * 2)
    parts = list(katz.by_place(table))
    assert max(part.num_rows for part in parts) == 7
    told = [tuple(row.values()) for part in parts for row in part.to_pylist()]
    assert [row[0] for row in told] == sorted(row[0] for row in told) and sorted(told) == sorted(rows * 2)
    assert list(katz.by_place(table.slice(0, 0))) == []


def test_places_come_as_an_arrow_table(spark, monkeypatch):
    given, make = [], type(spark).createDataFrame

    def watched(self, data, *args, **options):
        given.append(type(data))
        return make(self, data, *args, **options)

    monkeypatch.setattr(type(spark), "createDataFrame", watched)
    places = katz.Places(np.array([-(2**62), 7]), np.array([2, 3]))
    expected = [(-(2**62), -(2**62)), (-(2**62), -(2**62) ^ katz.STEP), (7, 7), (7, 7 ^ katz.STEP), (7, 7 ^ 2 * katz.STEP)]
    assert sorted(map(tuple, places.table(spark).collect())) == sorted(expected)
    empty = katz.Places(np.zeros(0, np.int64), np.zeros(0, np.int64)).table(spark)
    assert empty.count() == 0 and empty.columns == ["context", "place"] and set(given) == {pa.Table}


def test_files_are_released_again_and_again(monkeypatch):
    from time import sleep
    from types import SimpleNamespace

    from winback.llm import common

    calls = []
    spark = SimpleNamespace(sparkContext=SimpleNamespace(_jvm=SimpleNamespace(System=SimpleNamespace(gc=lambda: calls.append(1)))))
    monkeypatch.setattr(common, "RELEASED_SECONDS", 0.01)
    with pytest.raises(ValueError, match="ends"), common.releasing(spark):
        sleep(0.3)
        raise ValueError("ends")
    called = len(calls)
    assert called > 2
    sleep(0.1)
    assert len(calls) == called
