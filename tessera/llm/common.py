"""Shared helpers: scratch tables, size-checked joins, stable hashes, words."""

from __future__ import annotations

import re
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.scratch import materialize, scratch

__all__ = ["WORD", "WORD_SQL", "fold_of", "join_dimension", "materialize", "scratch", "small_batches", "table", "unit_hash", "worker_state"]

#: A word: a run of anything but space, tab, LF, VT, FF and CR.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: The same word class for Spark's (Java) and DuckDB's (RE2) regular expressions.
WORD_SQL = r"[^\x20\x09-\x0D]+"

#: A dimension with at most this many rows may be broadcast.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches of long texts small, so that Python workers stay within bounds.

    The settings are read when a plan runs, after the operator has returned it, so they stay set
    on the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def join_dimension(facts: DataFrame, dim: DataFrame, key: str, how: str = "left", salts: int = 32) -> DataFrame:
    """Join facts with a dimension of one row per key, whatever the keys' skew.

    The dimension is counted first; up to BROADCAST_ROWS rows it is broadcast, beyond
    that each of its rows is repeated once per salt and facts choose a salt by a hash
    of their row, so a key with a third of all rows spreads over `salts` tasks.
    Null keys match null keys.
    """
    right = dim.withColumnRenamed(key, "__key")
    if dim.count() <= BROADCAST_ROWS:
        return facts.join(F.broadcast(right), F.col(key).eqNullSafe(F.col("__key")), how).drop("__key")
    left = facts.withColumn("__salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
    right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__salt_r"))
    return left.join(right, on, how).drop("__key", "__salt", "__salt_r")


def unit_hash(col: Column, seed: str) -> Column:
    """A number in (0, 1) from a value's text, the same in every run and engine (52 bits of MD5)."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(col.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def fold_of(col: Column, folds: int) -> Column:
    """crc32 of the id's text modulo folds."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def worker_state(name: str, make):
    """An object that lives as long as this Python worker: made once, used by all its tasks."""
    holder = sys.modules.setdefault("_tessera_worker", types.ModuleType("_tessera_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)
