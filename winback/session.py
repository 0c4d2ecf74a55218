"""Session set-up shared by the command line, the bench and the tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "winback", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session, or reuse the running one.

    Only settings the engine relies on are fixed here. Shuffle width is left to the caller
    (adaptive execution merges small partitions, so a cluster should set it generously).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # checkpoint files go away with the DataFrame that owns them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's own setting first, a scratch folder only on local[*]."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="winback-checkpoints-")
    context.setCheckpointDir(shared)
    return shared
