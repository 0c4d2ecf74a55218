"""Keeping a result that several later steps read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row

from winback.session import ensure_checkpoint_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once and store reliably.

    Files lie in the shared checkpoint folder, so a lost executor costs a re-read and not the
    whole upstream job. Partitioning and order of the result are kept for later joins.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame, *totals: Column) -> tuple[DataFrame, Row]:
    """Cache a result that is expected to be small and read one row of totals from it.

    Reading the totals fills the cache, so Spark knows the true size from then on: a later join
    broadcasts it only while it is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    both sides (with adaptive skew handling) beyond that.
    """
    kept = df.persist()
    return kept, kept.agg(*totals).first()
