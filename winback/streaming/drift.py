"""Feature drift of people as they are scored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from winback.operators.monitor import DriftBaseline, bin_counts
from winback.session import ensure_checkpoint_dir
from winback.sources.snapshots import PublishedTable
from winback.streaming.deliveries import EVERY_MINUTE


def watch_drift(people: DataFrame, baseline: DriftBaseline, table: PublishedTable, checkpoint: str, **trigger) -> StreamingQuery:
    """Publish (feature, psi) of all rows of a stream so far, after each micro-batch.

    The stream's state is a count per bin, to which a micro-batch adds its own; no earlier row is read again.
    """

    def publish(counts: DataFrame, batch_id: int) -> None:
        table.replace(baseline.psi(counts), batch_id)

    writer = bin_counts(people, baseline.edges).writeStream.outputMode("complete").foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()


def replay_drift(baseline: DriftBaseline, people: DataFrame, batches: int = 3) -> DataFrame:
    """Store the baseline, let people arrive in batches, return what was published last."""
    spark = people.sparkSession
    work = f"{ensure_checkpoint_dir(spark)}/drift-{uuid.uuid4().hex}"
    baseline.table(spark).write.parquet(f"{work}/baseline")
    known = DriftBaseline.from_table(spark.read.parquet(f"{work}/baseline"))
    people.select(*known.edges).repartition(batches).write.parquet(f"{work}/people")
    arriving = spark.readStream.schema(spark.read.parquet(f"{work}/people").schema).option("maxFilesPerTrigger", 1)
    table = PublishedTable(spark, f"{work}/drift")
    watch_drift(arriving.parquet(f"{work}/people"), known, table, f"{work}/progress", availableNow=True).awaitTermination()
    return table.read()
