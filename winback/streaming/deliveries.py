"""Delivery times as a stream: tumbling windows that show a sudden rise."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winback.operators.monitor import delivery_rows
from winback.session import ensure_checkpoint_dir
from winback.sources.parquet_tables import WAREHOUSE_SCHEMAS, map_warehouse_orders
from winback.sources.snapshots import PublishedTable

EVERY_MINUTE = {"processingTime": "1 minute"}


def delivery_window_stream(orders: DataFrame, width: str = "30 days", lateness: str = "90 days") -> DataFrame:
    """Windowed mean delivery days of a stream of orders, by purchase date.

    In append mode a window is given out once it is older than ``lateness`` and later rows for
    it are ignored; state is one row per open window.
    """
    timed = delivery_rows(orders).withColumn("event_time", F.col("order_purchase_timestamp").cast("timestamp"))
    return (
        timed.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", width).alias("span"))
        .agg(F.count(F.lit(1)).alias("deliveries"), F.avg("delivery_days").alias("mean_delivery_days"))
        .select(F.col("span.start").cast("timestamp_ntz").alias("window_start"), "deliveries", "mean_delivery_days")
    )


def watch_deliveries(windows: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append closed windows to a parquet table; the file sink commits each batch once."""
    writer = windows.writeStream.outputMode("append").format("parquet").option("path", table)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()


def keep_current_windows(windows: DataFrame, table: PublishedTable, checkpoint: str, **trigger) -> StreamingQuery:
    """Publish all windows, open ones too, after each batch (a few rows each); readers always see a whole table."""
    writer = windows.writeStream.outputMode("complete").foreachBatch(table.replace)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()


def replay_delivery_windows(spark: SparkSession, folder: str, width: str = "30 days") -> DataFrame:
    """Stream the stored orders through the windows once and return the table."""
    work = f"{ensure_checkpoint_dir(spark)}/delivery-windows-{uuid.uuid4().hex}"
    stored = spark.readStream.schema(WAREHOUSE_SCHEMAS["orders"]).parquet(f"{folder}/orders.parquet*")
    orders = map_warehouse_orders(stored, delivered_only=True)
    table = PublishedTable(spark, f"{work}/windows")
    stream = keep_current_windows(delivery_window_stream(orders, width), table, f"{work}/progress", availableNow=True)
    stream.awaitTermination()
    return table.read()
