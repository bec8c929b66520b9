"""Session settings, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on. `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local-mode session without the setting gets a folder of its own; a
    cluster without it is an error, because a machine-local folder would be lost
    with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names a folder of one machine; a cluster needs a shared one")
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    cached = getattr(spark.sparkContext, "_tidemark_folder", None)
    if cached is None:
        cached = tempfile.mkdtemp(prefix="tidemark-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext._tidemark_folder = cached
    return cached


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
