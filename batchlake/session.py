"""Session helpers: settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # folders of a layer or drop are listed by so many tasks, not by one task for each folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def build_session(app: str = "batchlake", **settings: str) -> SparkSession:
    """Session with the settings above; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode with the setting unset; on a
    cluster without it this raises, since a machine-local path would not do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return os.path.join(tempfile.gettempdir(), "batchlake-work")
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/batchlake/{label}-{uuid.uuid4().hex}"
