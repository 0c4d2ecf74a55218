"""Compare a Spark result with the same query in DuckDB, ignoring row order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    tidy = [tuple(plain(row[i]) for i in order) for row in rows]
    return names, sorted(tidy, key=lambda row: tuple((value is None, str(type(value)), value) if value is not None else (True, "", 0) for value in row))


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [item[0] for item in cursor.description]
    return sorted_rows(columns, cursor.fetchall())


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def difference(df, con, sql) -> str | None:
    """What differs, or None."""
    names, mine = spark_rows(df)
    duck_names, theirs = duck_rows(con, sql)
    if names != duck_names:
        return f"columns {names} != {duck_names}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first: {wrong[0]}"
    return None
