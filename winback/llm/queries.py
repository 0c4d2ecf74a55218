"""Registered queries of this subpackage; each is a thin reading of its operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm import exact_dedup, fingerprints, katz, mixing, near_dedup, ngram_join, packing, periodic, ranked_search, secrets, sharding, toxicity, url_filter
from winback.llm.common import table, text_or_empty


def tokenizer_path() -> str:
    """The vocabulary file lies at the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def held_out(part: int) -> Column:
    """Rows kept from training, by a checksum of the id."""
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.pmod(checksum, F.lit(part)) == 2


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels").filter(~held_out(4)))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out(4).alias("held_out"), "score", "predicted", F.to_json("spans").alias("spans"))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), url_filter.rule_frame(spark, url_filter.RULES))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, folder, "documents"))


def op4_katz(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = katz.train(docs.filter(~held_out(7)))
    scored = katz.score(docs, model)
    model.drop(spark)
    return scored.select("doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = exact_dedup.DigestIndex.scratch(spark)
    judged = exact_dedup.deduplicate(table(spark, folder, "documents"), index)
    index.drop()
    return judged.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"), near_dedup.Rule(width=3, percent=85))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def spans_of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda span: span["kind"].isin(*kinds))


def told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    counts = [F.size(spans_of_kinds(kind)).cast("bigint").alias(f"n_{kind}") for kind in secrets.BASE_KINDS]
    base = F.sha2(told(spans_of_kinds(*secrets.BASE_KINDS)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, told(F.col("spans")).alias("spans"))


def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"), ngram_join.Threshold(width=4, percent=85))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=10)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id as text) ends in 0 the words from a chosen one on repeat (no id: as they are)."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    draw = F.floor(checksum / 10)

    def repeated(words: Column) -> Column:
        count = F.size(words)
        start = F.pmod(draw, count).cast("int")
        period = (1 + F.floor((count - start) / (3 + F.pmod(draw, F.lit(8))))).cast("int")
        times = F.ceil((count - start) / period).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
        edited = F.concat(F.slice(words, F.lit(1), start), F.slice(tail, F.lit(1), count - start))
        return F.when(count > 0, F.array_join(edited, " ")).otherwise("")

    text = text_or_empty()
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    # the list is bound to a name, so a text is split once
    edited = F.element_at(F.transform(F.array(words), repeated), 1)
    return docs.select("doc_id", F.when(F.pmod(checksum, F.lit(10)) == 0, edited).otherwise(text).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(with_periodic_tails(table(spark, folder, "documents")))
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # runs come by start, then period, so the first of equal ones stays
    best = F.aggregate(
        "runs",
        nothing,
        lambda held, run: F.when(held.isNull() | (run["length"] * held["period"] > held["length"] * run["period"]), run).otherwise(held),
    )
    told = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_fingerprints": op3_fingerprints,
    "op4_katz": op4_katz,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_secret_scan": op10_secret_scan,
    "op11_ngram_join": op11_ngram_join,
    "op12_ranked_search": op12_ranked_search,
    "op13_periodic_runs": op13_periodic_runs,
}
