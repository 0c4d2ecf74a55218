"""Packing: ids of whole texts, plain best-fit decreasing, gapless sequences."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from conftest import TABLES

from winback.llm import packing
from winback.llm.queries import QUERIES, tokenizer_path

DOCS = "doc_id bigint, text string, piece int, rank int, bucket int, length int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], DOCS).repartition(3)


@cache
def reference_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return tokenizer


@cache
def whole(text):
    return [*reference_tokenizer().encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_words_give_the_ids_of_whole_texts():
    random.seed(1)
    odd = [" ", "  ", "\n", "\t", "\x0b", "\xa0", "\u2003", "\u3000", "\x1c", "\x85", "\u180e", "\u200b", "\ufeff"]
    bits = ["word", "é", "1", "!", "'s", "'", "<|endoftext|>", "😀", "ſ", "²5", ".", "\x00", "\u0301"]
    texts = ["", " ", "a b", " a  b \n c", "x" * 5000, "\n", "a\n\nb", "a\nb", "a \nb", "'s\n's 's"]
    # words that differ in a bit or two, in both forms
    texts += ["Hereat Iereau\nIereau Hereat", "Iereau Hereat\nHereat Iereau", "aaaa baab\nbaab aaaa", "aaaa"]
    texts += ["".join(random.choices(bits + odd, k=random.randint(1, 30))) for _ in range(500)]
    texts += ["".join(random.choice(bits) + random.choice([" ", "\n", ""]) for _ in range(random.randint(1, 30))).strip() for _ in range(500)]
    encoder = packing.Encoder(tokenizer_path())
    ids, counts = encoder.texts(pa.array(texts))
    ends = np.cumsum(counts)
    for text, end, count in zip(texts, ends, counts, strict=True):
        assert ids[end - count : end].tolist() == list(whole(text))[:-1], repr(text)
    assert [len(part) for part in encoder.texts(pa.array([], pa.string()))] == [0, 0]


def test_words_are_forgotten_and_learned_again(monkeypatch):
    encoder = packing.Encoder(tokenizer_path())
    monkeypatch.setattr(encoder, "REMEMBERED", 20)
    monkeypatch.setattr(encoder, "JOINED", 3)
    random.seed(7)
    for _ in range(30):
        texts = [" ".join(random.choices(["alpha", "beta", "é9", "Łódź", "x1y2", "don't"], k=5)) + f"\nw{random.randint(0, 99)}" for _ in range(8)]
        ids, counts = encoder.texts(pa.array(texts))
        ends = np.cumsum(counts)
        assert [ids[end - count : end].tolist() for end, count in zip(ends, counts, strict=True)] == [list(whole(text))[:-1] for text in texts]
        assert (np.diff(encoder.high.astype(object)) >= 0).all() and len(encoder.numbers) == len(encoder.counts)


def test_a_mark_after_a_word_is_a_word_of_its_own():
    encoder = packing.Encoder(tokenizer_path())
    random.seed(11)
    ends = [".", ",", ";", ":", "!", "?", "..", "'", "'s.", "*", ".x", "\u0301."]
    stems = ["word", "z", "Z", "é", "ÿ", "÷", "×", "naïve", "ĳ", "ж", "9", "x9", "²", "'", "'s", "", "@", "[", "`", "{", "\u0183", "ǃ", "日本"]
    texts = [" ".join(random.choice(stems) + random.choice(ends) for _ in range(6)) + random.choice(["", "\nword.\nword,", "\n."]) for _ in range(800)]
    ids, counts = encoder.texts(pa.array(texts))
    for text, end, count in zip(texts, np.cumsum(counts), counts, strict=True):
        assert ids[end - count : end].tolist() == list(whole(text))[:-1], repr(text)
    encoder = packing.Encoder(tokenizer_path())
    encoder.texts(pa.array(["one two, two. two! three, three. three"]))
    assert len(encoder.counts) == 8  # the line feed, the first word in both forms, two words and three marks
    words = ["word.", "é,", "a!", ".", "", "x9.", "×.", "w..", "ж?", "w"]
    for given in (words, ["left out", *words]):
        array = pa.array([word.encode() for word in given], pa.large_binary())[len(given) - len(words) :]
        assert packing.marked(array).tolist() == [True] * 3 + [False] * 7
    assert packing.marked(pa.array([], pa.large_binary())).tolist() == []


def test_words_met_again_are_not_forgotten(monkeypatch):
    encoder = packing.Encoder(tokenizer_path())
    monkeypatch.setattr(encoder, "REMEMBERED", 40)
    learned, learn = Counter(), encoder._learn

    def watched(words, high, low, lead):
        learned.update((lead, word) for word in words)
        learn(words, high, low, lead)

    monkeypatch.setattr(encoder, "_learn", watched)
    for at in range(30):
        texts = ["often alpha, beta\ngamma", " ".join(f"x{chr(97 + at)}{chr(97 + i)}" for i in range(15))]
        ids, counts = encoder.texts(pa.array(texts))
        assert ids.tolist() == [i for text in texts for i in list(whole(text))[:-1]]
        assert len(encoder.numbers) == len(encoder.counts) == len(encoder.again) <= 40 + 20
        assert sorted(encoder.numbers.tolist()) == list(range(len(encoder.counts)))
    assert all(learned[word] == 1 for word in ((b"", b"often"), (b" ", b"alpha"), (b" ", b"beta"), (b"", b"gamma"), (b"", b",")))
    assert len(learned) > 400  # so many that memory was full several times
    # where all words are met again, none stays
    encoder.again[:] = True
    monkeypatch.setattr(encoder, "REMEMBERED", 4)
    encoder.forget_rare()
    assert encoder.numbers.tolist() == [0] and encoder.ids.tolist() == [encoder.feed]


def test_learning_many_words_holds_no_second_copy_of_what_is_known():
    random.seed(3)

    def text(words):
        return " ".join("".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(words))

    encoder = packing.Encoder(tokenizer_path())
    for _ in range(3):
        encoder.texts(pa.array([text(100_000)]))
    slice_ = pa.array([text(1000) for _ in range(packing.TEXT_BYTES // 7000)])
    tracemalloc.start()
    try:
        encoder.texts(slice_)
        assert tracemalloc.get_traced_memory()[1] < 130e6
    finally:
        tracemalloc.stop()


def test_texts_encoded_whole_go_to_the_tokenizer_a_few_at_a_time(monkeypatch):
    encoder = packing.Encoder(tokenizer_path())
    monkeypatch.setattr(encoder, "ENCODED", 50)
    sizes, own = [], encoder.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **options):
            sizes.append(len(texts))
            return own.encode_batch_fast(texts, **options)

    monkeypatch.setattr(encoder, "tokenizer", Watched())
    texts = [f"two  blanks\tand number {at}" for at in range(40)] + ["", "  " * 100]
    ids, counts = encoder.whole(texts)
    ends = np.cumsum(counts)
    assert [ids[end - count : end].tolist() for end, count in zip(ends, counts, strict=True)] == [list(whole(text))[:-1] for text in texts]
    assert max(sizes) == 3 and sum(sizes) == len(texts)  # the third text of over 20 characters reaches 50


def test_equal_pieces_are_numbered_in_many_buckets(spark):
    docs = docs_of(spark, [(None, "one text that all rows share")] * 4000)
    pieces = packing.tokenise(docs, tokenizer_path(), 64).withColumn("row", packing.F.monotonically_increasing_id())
    ranks = sorted(row["rank"] for row in packing.numbered(pieces).collect())
    assert ranks == list(range(4000))


def plain_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, free in enumerate(bins) if free >= length]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= length
        else:
            bins.append(capacity - length)
    return Counter(bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    random.seed(seed)
    capacity = random.choice([1, 7, 20, 64, 100])
    lengths = [random.randint(1, capacity) if seed % 2 else min(capacity, 1 + int(random.expovariate(0.1))) for _ in range(random.randint(0, 600))]
    counts = Counter(lengths)
    plan = packing.best_fit_decreasing(counts, capacity)
    used = defaultdict(list)
    runs = list(zip(plan.length, plan.rank, plan.each, plan.first, plan.offset, strict=True))
    for length, count in counts.items():
        own = sorted(run[1:] for run in runs if run[0] == length)
        for number in range(count):
            rank, each, first, offset = max(run for run in own if run[0] <= number)
            used[first + (number - rank) // each].append((offset + (number - rank) % each * length, length))
    assert len(used) == plan.sequences
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert Counter(capacity - sum(length for _, length in parts) for parts in used.values()) == plain_best_fit(lengths, capacity)


def check_packed(rows, docs, capacity):
    pieces, bins = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        bins[row["sequence_id"]].append((row["offset"], row["length"]))
    expected = Counter()
    for doc_id, text in docs:
        ids = whole(text)
        for _, piece, start, length in zip(*(part.tolist() for part in packing.cut(np.array([len(ids)]), capacity)), strict=True):
            expected[doc_id, piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    assert Counter(tuple(row)[:5] for row in rows) == expected
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return bins


def test_cut_leaves_only_the_first_piece_short():
    got = list(zip(*(part.tolist() for part in packing.cut(np.array([1, 4, 9]), 4)), strict=True))
    assert got == [(0, 0, 0, 1), (1, 0, 0, 4), (2, 0, 0, 1), (2, 1, 1, 4), (2, 2, 5, 4)]


def test_packing_of_odd_rows(spark):
    random.seed(2)
    docs = [(1, None), (2, ""), (None, "null id"), (None, "null id"), (3, "long " * 9000), (4, "same"), (4, "same")]
    docs += [(10 + i, "word " * random.randint(0, 90)) for i in range(300)] + [(400 + i, "hot copy of a text") for i in range(300)]
    packed = packing.pack(docs_of(spark, docs), tokenizer_path(), 64).collect()
    bins = check_packed(packed, docs, 64)
    sizes = Counter(sum(length for _, length in parts) for parts in bins.values())
    lengths = [row["length"] for row in packed]
    assert sizes == Counter({64 - free: n for free, n in plain_best_fit(lengths, 64).items()})
    assert packing.pack(docs_of(spark, []), tokenizer_path()).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = [(i, "some words " * (i % 40)) for i in range(120)] + [(5, "some words " * 5), (None, None)]
    rows = packing.sequences(docs_of(spark, docs), tokenizer_path(), 128).collect()
    assert max(len(row["ids"]) for row in rows) <= 128
    assert Counter(i for row in rows for i in row["ids"]) == Counter(i for _, text in docs for i in whole(text))
    assert sum(row["ids"].count(packing.END_ID) for row in rows) == len(docs)


def test_query_packs_the_whole_table(spark):
    rows = QUERIES["op7_best_fit_packing"](spark, TABLES).collect()
    docs = [tuple(row) for row in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    bins = check_packed(rows, docs, 1024)
    assert len(bins) <= 1.02 * sum(row["length"] for row in rows) / 1024 + 1
