"""CSV source: five tables, tolerant of missing files, bad dates and text that means "missing"."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winback.functions.missing import known_number, known_text, safe_timestamp
from winback.sources import schemas
from winback.sources.schemas import ShopTables

log = logging.getLogger(__name__)

# How the files of the five tables end. A pattern may match one file or many parts.
FILE_PATTERNS = {
    "customers": "*_customers_dataset.csv",
    "orders": "*_orders_dataset.csv",
    "payments": "*_order_payments_dataset.csv",
    "reviews": "*_order_reviews_dataset.csv",
    "geolocation": "*_geolocation_dataset.csv",
}
SCHEMAS = {
    "customers": schemas.CUSTOMERS,
    "orders": schemas.ORDERS,
    "payments": schemas.PAYMENTS,
    "reviews": schemas.REVIEWS,
}
# Only free text may hold line breaks. Reading such files cannot be split inside a file, so the
# other tables keep the splittable line reader.
FREE_TEXT_TABLES = {"reviews"}


@dataclass(frozen=True)
class TextFiles:
    """CSV files with one header."""

    header: str
    paths: list[str]


def data_files(spark: SparkSession, pattern: str) -> list[str]:
    """The files a path or pattern matches; folders count with all their data files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(conf)
    found, waiting = [], list(files.globStatus(path) or [])
    while waiting:
        status = waiting.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            waiting += [inner for inner in files.listStatus(status.getPath()) if not inner.getPath().getName().startswith(("_", "."))]
        elif not name.startswith(("_", ".")):
            found.append(status.getPath().toString())
    return sorted(found)


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, which may be compressed; None if it has none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        inside = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(inside, "UTF-8")).readLine()
    finally:
        stream.close()


def text_files(spark: SparkSession, path: str) -> list[TextFiles]:
    """The files of a table by header; parts may have their columns in another order, or further columns.

    The driver reads the first line of each file, nothing else of it.
    """
    by_header: dict[str, list[str]] = {}
    for file in data_files(spark, path):
        header = first_line(spark, file)
        if header is not None:
            by_header.setdefault(header.removeprefix("\ufeff"), []).append(file)
    return [TextFiles(header, files) for header, files in by_header.items()]


#: a column that holds the whole line where its fields do not match the header
MALFORMED = "_malformed_line"


def read_text(spark: SparkSession, files: TextFiles, multi_line: bool = False, malformed: bool = False) -> DataFrame:
    """All columns as text, by header name; with ``malformed`` also MALFORMED, at the price of parsing every column."""
    options = {"header": True, "enforceSchema": False, "multiLine": multi_line, "quote": '"', "escape": '"'}
    if not malformed:
        return spark.read.csv(files.paths, **options)
    columns = spark.read.csv(files.paths[0], **options).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, MALFORMED]])
    reader = spark.read.schema(schema).option("columnPruning", False)
    return reader.csv(files.paths, columnNameOfCorruptRecord=MALFORMED, **options)


#: how the text of a cell is read, by the type it becomes
READERS = {T.DoubleType(): known_number, T.TimestampNTZType(): safe_timestamp}


def to_schema(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the schema's columns by name and turn their text into its types, bad values to null."""
    return raw.select(
        [
            READERS.get(field.dataType, lambda column: column)(known_text(F.col(field.name))).alias(field.name)
            for field in schema
        ]
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame | None:
    """A table of CSV files, with the schema's columns or all as text; ``None`` when nothing matches the path."""
    frames = []
    for files in text_files(spark, path):
        raw = read_text(spark, files, multi_line)
        missing = [field.name for field in schema or [] if field.name not in raw.columns]
        if missing:
            raise ValueError(f"{files.paths[0]} has no column {', '.join(missing)}; its header is {files.header}")
        frames.append(to_schema(raw, schema) if schema is not None else raw)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def delivered(orders: DataFrame) -> DataFrame:
    """Orders that reached the customer; the only ones that count."""
    return orders.filter(F.col("order_status") == "delivered")


def load_and_clean_data(
    spark: SparkSession,
    data_path: str = "data/raw/",
    files: Mapping[str, str] | None = None,
) -> ShopTables:
    """Read the shop's CSV files; a missing one gives a warning and no table.

    ``files`` replaces file names or patterns per table. Files of a table may have their columns in different orders. Nothing is
    read beyond the header lines until a query runs, so the unused geolocation table costs nothing. What the readers
    turn into null is listed by :func:`csv_rejects`.
    """
    patterns = {**FILE_PATTERNS, **(files or {})}
    tables: dict[str, DataFrame] = {}
    for name, pattern in patterns.items():
        path = f"{data_path.rstrip('/')}/{pattern}"
        table = read_table(spark, path, SCHEMAS.get(name), multi_line=name in FREE_TEXT_TABLES)
        if table is None:
            log.warning("no file matches %s; table %s is left out", path, name)
            continue
        tables[name] = table
    if "orders" in tables:
        tables["orders"] = delivered(tables["orders"])
    return ShopTables(**tables)


def csv_rejects(spark: SparkSession, data_path: str = "data/raw/", files: Mapping[str, str] | None = None) -> DataFrame:
    """(table, file, reason, text) of everything :func:`load_and_clean_data` could not read as it stands.

    A line whose fields do not match the header is one row with the whole line; a cell that is neither of its column's type nor a
    word for a missing value is one row with its text. Reasons are ``malformed line``, ``no number: <column>`` and ``no
    date: <column>``.
    """
    patterns = {**FILE_PATTERNS, **(files or {})}
    words = {T.DoubleType(): "no number", T.TimestampNTZType(): "no date"}
    nothing = F.lit(None).cast("struct<reason:string,text:string>")
    parts = []
    for name, schema in SCHEMAS.items():
        for found in text_files(spark, f"{data_path.rstrip('/')}/{patterns[name]}"):
            raw = read_text(spark, found, name in FREE_TEXT_TABLES, malformed=True)
            # the reader refuses a query that needs nothing but the malformed line
            line = F.coalesce(MALFORMED, raw.columns[0]).alias("text")
            checks = [F.when(F.col(MALFORMED).isNotNull(), F.struct(F.lit("malformed line").alias("reason"), line))]
            for field in schema:
                if field.dataType in READERS and field.name in raw.columns:
                    text = known_text(F.col(field.name))
                    bad = F.col(MALFORMED).isNull() & text.isNotNull() & READERS[field.dataType](text).isNull()
                    checks.append(F.when(bad, F.struct(F.lit(f"{words[field.dataType]}: {field.name}").alias("reason"), text.alias("text"))))
            rejected = F.filter(F.array(*checks, nothing), lambda item: item.isNotNull())
            parts.append(raw.select(F.lit(name).alias("table"), F.col("_metadata.file_path").alias("file"), F.inline(rejected)))
    if not parts:
        return spark.createDataFrame([], "table string, file string, reason string, text string")
    return reduce(DataFrame.unionByName, parts)
