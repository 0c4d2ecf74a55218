"""Sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from winback.sources.snapshots import file_of


def write_leads(leads: DataFrame, path: str, file_format: str = "parquet", single_file: bool = False) -> None:
    """Write the lead list, person id included, in place of the one at ``path``.

    The parts keep the order of the list. They are written beside the path and take its name when all are there, so that a
    failed run leaves the list before it as it was. ``single_file`` pulls the list through one task and is meant for a short
    list that a person will open.
    """
    parts = leads.coalesce(1) if single_file else leads
    target = path.rstrip("/")
    attempt = uuid.uuid4().hex
    writer = parts.write
    if file_format == "csv":
        writer = writer.option("header", True)
    spark = leads.sparkSession
    files, final = file_of(spark, target)
    _, staged = file_of(spark, f"{target}.staged-{attempt}")
    _, before = file_of(spark, f"{target}.before-{attempt}")
    try:
        writer.format(file_format).save(staged.toString())
        replaced = files.exists(final) and files.rename(final, before)
        if not files.rename(staged, final):
            if replaced:
                files.rename(before, final)
            raise OSError(f"the list could not be moved to {path}")
        files.delete(before, True)
    finally:
        files.delete(staged, True)
