"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text. A batch is reduced
to one row per digest, digests that the index holds are removed by a sort-merge anti-join, the
rest is appended. Index and batch meet bucket by bucket, so the index itself is never shuffled. The number of buckets is chosen
when an index is made and stored with it; ``compact`` makes one of the same texts with other buckets and few files.

A batch has a name that the index keeps with its texts. A text is known if another batch brought it, so a batch that is run
again under its name, after a failure at any point, gets the verdicts it would have got. Two batches that run at the same
time may both keep a text that is new to both; later batches find it once.

Defined cases: a null text counts as empty, and empty texts are equal to each other; a null
doc_id comes after every known one; of rows that repeat a doc_id and text one stays; an empty batch
changes nothing; columns besides doc_id and text are carried by ``keep_first`` and never read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm.common import join_groups, shared_path, stored, text_or_empty
from winback.sources.snapshots import file_of

#: characters that count as white space; a run of them equals one space
SPACES = r"[\x20\x09-\x0D]+"
#: a digest with more than 1/HOT_PARTS of a batch is joined by broadcast; so there are fewer than HOT_PARTS of them
HOT_PARTS = 1000
INDEX_COLUMNS = "text_sha256 STRING, keep_id BIGINT, first_rows BIGINT, batch STRING"
BUCKETS_FILE = "_buckets"


def text_digest(text: str = "text") -> Column:
    return F.sha2(F.regexp_replace(text_or_empty(text), SPACES, " "), 256)


@dataclass(frozen=True)
class DigestIndex:
    """A table (text_sha256, keep_id, first_rows, batch), one row per text seen so far."""

    spark: SparkSession
    name: str
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, name: str, buckets: int = 64) -> DigestIndex:
        """Create the index, or register the one that lies at ``path`` with the buckets it was made with."""
        files, told = file_of(spark, f"{path}/{BUCKETS_FILE}")
        if files.exists(told):
            stream = files.open(told)
            buckets = int(bytes(stream.readAllBytes()))
        else:
            stream = files.create(told)
            stream.write(str(buckets).encode())
        stream.close()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({INDEX_COLUMNS}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, name, path, buckets)

    @classmethod
    def scratch(cls, spark: SparkSession, buckets: int = 64) -> DigestIndex:
        """An index for one job; ``drop`` it when the verdicts are there."""
        path = shared_path(spark, "digest-index")
        return cls.open(spark, path, "digest_index_" + path.rsplit("-", 1)[1], buckets)

    def drop(self) -> None:
        """Remove the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        files, folder = file_of(self.spark, self.path)
        files.delete(folder, True)

    @property
    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def known(self, without: str) -> DataFrame:
        """(text_sha256, index_id) of the texts that other batches brought, each once."""
        first = F.min(F.struct(F.col("keep_id").isNull().alias("unknown"), "keep_id"))["keep_id"]
        return self.rows.filter(F.col("batch") != without).groupBy("text_sha256").agg(first.alias("index_id"))

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the new texts of a batch; those it added in an earlier attempt are there already."""
        mine = self.rows.filter(F.col("batch") == batch)
        fresh = groups.join(mine.hint("merge"), "text_sha256", "left_anti").withColumn("batch", F.lit(batch))
        columns = [part.split()[0] for part in INDEX_COLUMNS.split(", ")]
        fresh.select(*columns).repartition(self.buckets, "text_sha256").write.insertInto(self.name)

    def compact(self, path: str, name: str, buckets: int) -> DigestIndex:
        """A new index of the same texts, one row each, with so many buckets of one sorted file."""
        other = DigestIndex.open(self.spark, path, name, buckets)
        first = F.min(F.struct(F.col("keep_id").isNull().alias("unknown"), "keep_id", "first_rows", "batch")).alias("first")
        once = self.rows.groupBy("text_sha256").agg(first).select("text_sha256", "first.keep_id", "first.first_rows", "first.batch")
        once.repartition(buckets, "text_sha256").write.insertInto(name)
        return other


def batch_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row_id, text_sha256) of every row, stored; ``row_id`` tells repeated rows apart."""
    rows = docs.select("doc_id", text_digest().alias("text_sha256"), F.monotonically_increasing_id().alias("row_id"))
    return stored(rows, "digests")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Add a batch to the index and judge each of its rows; give ``batch`` a name to be able to run it again.

    Returns doc_id, row_id, text_sha256, keep_id (doc_id of the row that stays, perhaps from an
    earlier batch), group_size (rows of this batch with the text) and kept. The verdicts are stored before the index
    learns of the batch, and do not read it any more.
    """
    name = batch or uuid.uuid4().hex
    rows = batch_digests(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_id"))
    groups = (
        rows.groupBy("text_sha256")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("first_rows"))
        .select("text_sha256", F.col("first.doc_id").alias("own_id"), F.col("first.row_id").alias("keep_row"), "first_rows")
    )
    seen = index.known(without=name).withColumn("seen", F.lit(True))
    judged = stored(groups.join(seen.hint("merge"), "text_sha256", "left").withColumn("seen", F.coalesce("seen", F.lit(False))), "digest-news")
    index.append(judged.filter(~F.col("seen")).withColumn("keep_id", F.col("own_id")), name)
    verdicts = judged.select(
        "text_sha256",
        F.when(F.col("seen"), F.col("index_id")).otherwise(F.col("own_id")).alias("keep_id"),
        "keep_row",
        "seen",
        F.col("first_rows").alias("group_size"),
    )
    kept = ~F.col("seen") & (F.col("row_id") == F.col("keep_row"))
    return join_groups(rows, verdicts, "text_sha256", "group_size", HOT_PARTS).withColumn("kept", kept).drop("seen", "keep_row")


def keep_first(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are dealt by digest and doc_id together, so a text with very many copies is spread.
    """
    digest = "__text_digest"
    stay = decisions.filter("kept").select(F.col("text_sha256").alias("__kept_digest"), F.col("doc_id").alias("__kept_id"))
    marked = docs.withColumn(digest, text_digest())
    same = (F.col(digest) == F.col("__kept_digest")) & F.col("doc_id").eqNullSafe(F.col("__kept_id"))
    found = marked.join(stay.hint("merge"), same)
    # only where rows repeat a kept doc_id and text is there more than one to choose from
    repeated = decisions.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    if not repeated.filter("kept and rows > 1").isEmpty():
        found = found.dropDuplicates([digest, "doc_id"])
    return found.select(*[F.col(f"`{name}`") for name in docs.columns])
