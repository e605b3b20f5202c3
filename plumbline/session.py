"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the checks rely on (UTC days, ANSI errors, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, deleted when the driver ends.

    It lies in the shared folder that ``spark.checkpoint.dir`` names; where that is unset, in the warehouse. A warehouse on
    the driver's own disk is no place for tables that executors of a cluster write, and is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = shared or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/plumbline/{purpose}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not shared and files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share: {base} is a local disk")
    files.deleteOnExit(folder)
    return path
