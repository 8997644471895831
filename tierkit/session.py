"""Session helpers: where a job may write, and a local session for tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a
    cluster a machine-local folder would be lost with the machine, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tierkit-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def local_session(cores: int | str = 8, app: str = "tierkit") -> SparkSession:
    """Small local session; cluster sessions come from spark-submit instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIERKIT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tierkit-wh-"))
        .getOrCreate()
    )
