"""What several text operators share: the tables, folders every executor can reach, search in sorted bounds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Event, Thread

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.session import ensure_checkpoint_dir

LOWEST_LONG = -(2**63)
#: bytes read for each file of a small table, and files for each core that it may have whatever it reads
FILE_BYTES, FILES_A_CORE = 4_000_000, 3
RELEASED_SECONDS = 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def few_files(df: DataFrame) -> DataFrame:
    """The same rows, for writing: no more partitions than one for each FILE_BYTES of the files read, or some for each core.

    Where a small table comes out of a wide shuffle, each of its partitions would be a file. On a local file system without
    Hadoop's native library every new file has its permissions set by processes that the executor starts. A table that
    reads no files, so that its size is not known, stays as it is.
    """
    context = df.sparkSession.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    if not folders:
        return df
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder)) for folder in folders]
    read = sum(path.getFileSystem(conf).getContentSummary(path).getLength() for path in paths)
    return df.coalesce(max(FILES_A_CORE * context.defaultParallelism, read // FILE_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once as parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    few_files(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that no later step reads, and let Spark delete shuffle files nobody refers to.

    Spark does so when the driver's collector finds them, which on a driver with much memory may be long after.
    """
    spark = SparkSession.active()
    jvm = spark.sparkContext._jvm
    for folder in {file.rsplit("/", 1)[0] for frame in frames for file in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    jvm.System.gc()


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Meanwhile let Spark delete shuffle files nobody refers to, every few seconds.

    Spark's listeners refer to a query for a while after it has ended, the longer the more tasks it had, so a single call of
    ``release`` may come too early.
    """
    ended, jvm = Event(), spark.sparkContext._jvm

    def run() -> None:
        while not ended.wait(RELEASED_SECONDS):
            jvm.System.gc()

    thread = Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z; every other letter stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def long_array(values: Sequence[int]) -> Column:
    """A constant array of longs, written as one literal however many there are."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bounds_at_or_below(bounds: Sequence[Column], values: Sequence[Column], count: int) -> Column:
    """How many of ``count`` bounds are <= the value, by binary search.

    ``bounds`` are constant arrays, one per key part, sorted together; ``values`` the same parts
    of the row's key, none of them null.
    """
    if count == 0:
        return F.lit(0)

    def not_above(at: Column) -> Column:
        result = F.lit(True)
        for array, value in reversed(list(zip(bounds, values, strict=True))):
            bound = F.element_at(array, (at + 1).cast("int"))
            result = (bound < value) | ((bound == value) & result)
        return result

    def step(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        open_ = low < high
        below = not_above(F.least(middle, F.lit(count - 1)))
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(low).cast("int").alias("low"),
            F.when(open_ & ~below, middle).otherwise(high).cast("int").alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(count).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(count.bit_length() + 1))
    return F.aggregate(steps, start, step, lambda state: state["low"])


def id_and_text() -> list[Column]:
    """doc_id and text (null: empty), whatever other columns a table has."""
    return [F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")]


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, parts: int = 1000) -> DataFrame:
    """``rows`` joined with ``groups``, which has each key once and the number of its rows in ``size``.

    A group with more than 1/parts of the rows would fill one task; there are fewer than ``parts``
    such groups, and they are broadcast instead.
    """
    limit = max(rows.count() // parts, 1)
    hot = F.broadcast(groups.filter(F.col(size) > F.lit(limit)))
    rest = rows.join(hot.select(key), key, "left_anti").join(groups, key)
    return rows.join(hot, key).unionByName(rest)
