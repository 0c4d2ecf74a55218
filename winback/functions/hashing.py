"""Stable pseudo-random numbers from ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_hash(id_column: Column, seed: int | str) -> Column:
    """32-bit number from the md5 of ``seed:id``; the same on every run, engine and partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), id_column.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
