"""Periodic runs against a direct scan of every distance."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from winback.llm import periodic
from winback.llm.queries import QUERIES, with_periodic_tails

DOCS = "doc_id bigint, text string, runs string, start int, collapsed int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2) for row in rows], DOCS).repartition(3)


def plain_runs(words):
    """(start, length, period) by start, then period: equal words at each distance, extended both ways by the scan."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(6, 4 * period):
                found.setdefault((at, length), period)
            at = max(end, at + 1)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda run: (run[0], run[2]))


def plain_collapsed(words, runs):
    dropped = {at for start, length, period in runs for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(words) if at not in dropped)


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def edited_words(doc_id, text):
    words = words_in(text)
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, words):
    runs = plain_runs(words)
    best = (None,) * 4
    if runs:
        start, length, period = min(runs, key=lambda run: (-(run[1] * 10**9 // run[2]), run[0], run[2]))
        for run in runs:
            if run[1] * period > length * run[2]:
                start, length, period = run
        best = (start, length, period, 1000 * length // period)
    told = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    digests = [hashlib.sha256(text.encode()).hexdigest() for text in (told, plain_collapsed(words, runs))]
    return (doc_id, len(runs), *best, *digests)


def random_words(rng):
    count = rng.choice([0, 1, 5, 6, 7, 20, 60, 150])
    words = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(count)]
    if count > 10 and rng.random() < 0.6:
        start, period = rng.randrange(count), rng.randint(1, 12)
        words = [words[at] if at < start else words[start + (at - start) % period] for at in range(count)]
    return words


def test_runs_of_many_sequences_at_once():
    rng = random.Random(3)
    for _ in range(400):
        docs = [random_words(rng) for _ in range(rng.randint(1, 4))]
        codes = np.array([of * 10 + ord(word) - 97 for of, words in enumerate(docs) for word in words], np.int64)
        limits = np.concatenate([[0], np.cumsum([len(words) for words in docs])]).astype(np.int64)
        owners = np.repeat(np.arange(len(docs)), np.diff(limits))
        starts, lengths, periods = periodic.find(codes, limits[owners], limits[owners + 1])
        found = list(zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True))
        assert found == [(start + limits[of], length, period) for of, words in enumerate(docs) for start, length, period in plain_runs(words)]


@pytest.mark.parametrize("words", [["a"] * 60_000, list("abcdefg") * 9000, [w for at in range(9000) for w in (*"abcde", f"x{at}")]])
def test_long_and_repetitive_texts_take_little_more_than_their_length(words):
    codes = pa.array(words).dictionary_encode().indices.to_numpy().astype(np.int64)
    starts, lengths, _ = periodic.find(codes, np.zeros(len(words), np.int64), np.full(len(words), len(words)))
    assert (len(starts), lengths.sum()) in ((1, len(words)), (0, 0))


def test_farthest_follows_from_the_least_length():
    for shared in range(200):
        fits = [period for period in range(1, 200) if shared + period >= max(6, 4 * period)]
        assert periodic.farthest(shared) == max(fits, default=0)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, " a a\na a\ta a "), (5, " a a\na a\ta a "), (None, "x y " * 4), (7, "É é " * 5 + "É"), (8, "A a " * 4 + "a")]
    rows += [(9, "one " * 30_000), (10, "k " + "p q r " * 5 + "p q " + "z z z z z z z")]
    got = sorted(map(str, (tuple(row) for row in periodic.find_runs(docs_of(spark, rows)).collect())))
    wanted = []
    for doc_id, text in rows:
        words = words_in(text)
        runs = plain_runs(words) if doc_id != 9 else [(0, 30_000, 1)]
        wanted.append((doc_id, len(words), [{"start": s, "length": length, "period": p} for s, length, p in runs], plain_collapsed(words, runs)))
    from pyspark.sql import Row

    assert got == sorted(str((a, b, [Row(**run) for run in c], d)) for a, b, c, d in wanted)
    assert periodic.find_runs(docs_of(spark, [])).count() == 0


def test_tails_are_repeated_as_stated(spark):
    rows = [(at, " ".join(f"w{i}" for i in range(at % 23))) for at in range(200)] + [(None, "a b"), (30, None), (30, "É  b\tc d \n")]
    got = {(row["doc_id"], tuple(words_in(row["text"]))) for row in with_periodic_tails(docs_of(spark, rows)).collect()}
    assert got == {(doc_id, tuple(edited_words(doc_id, text))) for doc_id, text in rows}


def test_query_against_the_scan(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_periodic_runs"](spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(row) for row in got.collect()) == sorted(expected(doc_id, edited_words(doc_id, text)) for doc_id, text in rows)
