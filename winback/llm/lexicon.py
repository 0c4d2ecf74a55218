"""Words of labelled texts: a bounded sample of labelled rows, and which word features tell a class.

The sample bounds rows and nothing else. Its texts are stored and stay whole on the executors; what the driver gets of them
is a few numbers per row and one per feature bucket.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from winback.llm.arrow import sliced, small_batches, tidied
from winback.llm.common import id_and_text, stored

#: runs of letters
WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
#: features of a word: itself, its first 4 and 5 letters, its first and last 3
FEATURES = 5
TELLING = 3  # the first three can make a word tell a class

#: a feature tells a class if it is in so many sampled texts of it, and so many times as often as in others
LEAST_TEXTS = 5
LEAST_RATIO = 20.0

#: from a text to the words that can tell its class
Words = Callable[[str], Iterable[str]]


def telling_buckets(word: str) -> tuple[int, int, int]:
    """The buckets of the features that can tell a class."""
    word = word.lower()
    whole, four, five = (f"w{word}".encode(), f"p4{word[:4]}".encode(), f"p5{word[:5]}".encode())
    return zlib.crc32(whole) & (BUCKETS - 1), zlib.crc32(four) & (BUCKETS - 1), zlib.crc32(five) & (BUCKETS - 1)


def features(word: str) -> list[int]:
    word = word.lower()
    parts = ("w" + word, "p4" + word[:4], "p5" + word[:5], "p3" + word[:3], "s3" + word[-3:])
    return [zlib.crc32(part.encode()) & (BUCKETS - 1) for part in parts]


def sample_labelled(docs: DataFrame, labels: DataFrame, values: Sequence[int], per_class: int) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` documents of each label value, chosen by a hash of doc_id; stored.

    ``labels`` holds doc_id and label. Rows without either are left out, and so are labels without a document; of labels that
    repeat an id the largest counts, of texts that repeat an id the one with the smallest hash.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label"))
    known = known.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = known.limit(0)
    for value in values:
        picked = picked.unionByName(known.filter(F.col("label") == value).orderBy(*order).limit(per_class))
    # bounded by ``per_class``
    found = docs.select(*id_and_text()).join(F.broadcast(picked), "doc_id")
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    return stored(found.groupBy("doc_id", "label").agg(one), "labelled")


def per_text(sample: DataFrame, schema: str, work: Callable[[list, list, list], dict[str, list]]) -> DataFrame:
    """``work(doc_ids, labels, texts)`` for slices of a sample; returns columns by name, any number of rows."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns = work(*(batch.column(name).to_pylist() for name in ("doc_id", "label", "text")))
            yield pa.RecordBatch.from_arrays([pa.array(columns[field.name], field.type) for field in arrow], schema=arrow)

    return small_batches(sample).mapInArrow(tidied(run), struct)


MULTIPLIERS = np.array([[2_654_435_761], [2_246_822_519], [3_266_489_917], [668_265_263]], np.uint64)


def copy_keys(words: Sequence[str]) -> list[int]:
    """Four minimum hashes of a text's word triples."""
    triples = {" ".join(words[at : at + 3]) for at in range(max(1, len(words) - 2))}
    hashes = np.array([zlib.crc32(triple.encode()) for triple in triples], np.uint64)
    return ((hashes * MULTIPLIERS) & np.uint64(0xFFFFFFFF)).min(axis=1).astype(np.int64).tolist()


def without_copies(keys: Iterable[tuple[int, list[int]]]) -> list[int]:
    """The ids, in ascending order, of texts that are no near copies of earlier ones, whose words would count once per copy.

    A copy shares one of its ``copy_keys`` with an earlier text.
    """
    seen: set[tuple[int, int]] = set()
    kept = []
    for doc_id, mine in sorted(keys):
        named = set(enumerate(mine))
        if not named & seen:
            kept.append(doc_id)
        seen |= named
    return kept


def distinct_texts(sample: DataFrame, words: Words) -> DataFrame:
    """The sample without near copies."""

    def work(doc_ids: list, _: list, texts: list) -> dict[str, list]:
        return {"doc_id": doc_ids, "keys": [copy_keys(list(words(text))) for text in texts]}

    found = per_text(sample, "doc_id bigint, keys array<bigint>", work).collect()
    kept = without_copies((row["doc_id"], row["keys"]) for row in found)
    # rows given as Python objects would start workers of another kind on the executors, beside those that are there
    ids = sample.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(kept, pa.int64())}))
    return stored(sample.join(F.broadcast(ids), "doc_id", "left_semi"), "labelled")


def texts_with_features(sample: DataFrame, words: Words, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of each class a feature bucket is, and the number of texts of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros((classes, BUCKETS), np.int64), np.zeros(classes, np.int64)
        for batch in sliced(batches):
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                buckets = {bucket for word in set(words(text)) for bucket in telling_buckets(word)}
                seen[label, list(buckets)] += 1
                texts[label] += 1
        # the number of texts stands after the last bucket
        label, bucket = np.nonzero(seen)
        columns = [np.append(label, np.arange(classes)), np.append(bucket, np.full(classes, BUCKETS)), np.append(seen[label, bucket], texts)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["label", "bucket", "texts"])

    counted = small_batches(sample).mapInArrow(tidied(run), "label bigint, bucket bigint, texts bigint")
    table = np.zeros((classes, BUCKETS + 1))
    for row in counted.groupBy("label", "bucket").agg(F.sum("texts").alias("texts")).collect():  # a row per class and bucket at most
        table[row["label"], row["bucket"]] = row["texts"]
    return table[:, :BUCKETS], table[:, BUCKETS]


def telling_features(seen: np.ndarray, texts: np.ndarray, of: int) -> np.ndarray:
    """Which feature buckets tell class ``of`` from the others, as a boolean table over BUCKETS."""
    others = [other for other in range(len(texts)) if other != of]
    rest, rest_texts = seen[others].sum(axis=0), texts[others].sum()
    ratio = (seen[of] + 0.5) / (texts[of] + 1) / ((rest + 0.5) / (rest_texts + 1))
    return (seen[of] >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)


def tells(telling: np.ndarray, word: str) -> bool:
    return bool(telling[list(telling_buckets(word))].any())
