"""Candidate files of registered sources, and the first of each series that answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enumerate_sources(registry: DataFrame, revisions: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """source, series, ord and url of every candidate.

    registry: source, kind (list, series or page), urls (of a list), base and numbers (of a
    series).  A series gives every number with every revision and date, in that order; a page
    gives none.
    """
    listed = registry.filter("kind = 'list'").select("source", F.posexplode("urls").alias("ord", "url")).select("source", F.col("url").alias("series"), F.lit(0).alias("ord"), "url")
    marks = F.array(*(F.struct(F.lit(k).alias("ord"), F.lit(f"-{r}-{d}.pdf").alias("tail")) for k, (r, d) in enumerate((r, d) for r in revisions for d in dates)))
    series = registry.filter("kind = 'series'").select("source", "base", F.explode("numbers").alias("number")).select("source", F.concat("base", F.col("number").cast("string")).alias("series"), F.explode(marks).alias("m"))
    return listed.unionByName(series.select("source", "series", F.col("m.ord").alias("ord"), F.concat("series", "m.tail").alias("url")))


def first_alive(candidates: DataFrame, answers: DataFrame, least_bytes: int) -> DataFrame:
    """source, series, url and state: per series the first candidate that is there and large enough; `blocked` or `missing` if none is.

    answers: url, status, n_bytes.
    """
    seen = candidates.join(answers, "url", "left")
    alive = (F.col("status") == 200) & (F.col("n_bytes") > least_bytes)
    of = seen.groupBy("source", "series").agg(F.min_by(F.when(alive, F.col("url")), F.when(alive, F.col("ord"))).alias("url"), F.coalesce(F.bool_or(F.col("status") == 403), F.lit(False)).alias("blocked"))
    return of.select("source", "series", "url", F.when(F.col("url").isNotNull(), "alive").when(F.col("blocked"), "blocked").otherwise("missing").alias("state"))
