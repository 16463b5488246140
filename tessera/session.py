"""A session with the settings that the library's queries are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.legacy.javaCharsets": "true",
}


def build(master: str | None = None, checkpoint_dir: str | None = None, **more: str) -> SparkSession:
    """master: None on a cluster, where the launcher sets it.

    checkpoint_dir: a folder that all executors share; intermediate tables go there.  It may be
    emptied whenever no query runs.
    """
    builder = SparkSession.builder.appName("tessera").config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()})
    if master:
        builder = builder.master(master)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()
