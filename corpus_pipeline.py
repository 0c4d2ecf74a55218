"""A corpus run: toxic texts out, exact and near copies out, mixed to target weights, packed into sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from winback.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from winback.llm.common import few_files, release, stored, table
from winback.llm.queries import tokenizer_path

#: shares of tokens for the domains high, low and toxic; the last, which the first stage removes, stays as it is
MIX = (0.90, 0.10, None)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    index = exact_dedup.DigestIndex.scratch(spark)
    judged = exact_dedup.deduplicate(docs, index)
    index.drop()
    return few_files(exact_dedup.keep_first(docs, judged))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return few_files(near_dedup.keep_one(docs))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated or left out, so that the domains' expected tokens meet the targets."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"), MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return few_files(packing.pack(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_to_targets),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as parquet and read by the next.

    A null text counts as empty in every stage; rows without id, repeated rows, clashing ids and further columns are
    treated as each operator states; an empty table gives no rows. What a stage has written goes when the next has ended.
    """
    docs = table(spark, sf_dir, "documents")
    written = None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if written is not None:
            release(written)
        written = docs
    return docs


#: trained models and tokens have no SQL
ORACLE_SQL = None
