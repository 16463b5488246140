"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Rows of a partition of spread().
PARTITION_ROWS = 50_000


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder.

    Only where the setting is absent and the master is this machine (tests) is a temporary
    folder made; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root) if spark.conf.isModifiable("spark.checkpoint.dir") else None
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tessera/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: Sequence[str], most: int = PARTITION_ROWS) -> DataFrame:
    """df dealt by its key over as many partitions as leave each about `most` rows, few as the bytes may be: adaptive execution keeps that number."""
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(min(session, 12), -(-df.count() // most)), *by)
