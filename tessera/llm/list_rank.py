"""Places of the elements of linked lists (list ranking), distributed.

1. Elements come with a block: any grouping into bounded blocks in which neighbours are likely
   to meet.  A task follows the links inside its block and leaves one link per chain.
2. While more than FINAL_LINKS links are left, each round lets every element whose coin shows
   tails swallow its successor where that one's coin shows heads: a quarter of the links go.
   Coins are hashes, so rounds repeat alike.
3. What is left is ranked in one task, and everything that was swallowed gets its place from the
   element that swallowed it, round by round backwards, the blocks' chains at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

#: Links that one task may rank.
FINAL_LINKS = 1 << 17
NONE = -1


def chains_of(ids: np.ndarray, nexts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(head, offset, length of the chain, element behind the chain) per element: chains of links among these elements.

    Length and the element behind are right at heads only.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    found = np.searchsorted(ids[order], nexts)
    inside = order[np.minimum(found, n - 1)]
    linked = ids[inside] == nexts
    head, offset = np.arange(n), np.zeros(n, np.int64)
    head[inside[linked]] = np.flatnonzero(linked)
    offset[inside[linked]] = lengths[linked]
    while (head[head] != head).any():
        offset = offset + offset[head]
        head = head[head]
    total, behind = np.zeros(n, np.int64), np.full(n, NONE, np.int64)
    last = np.flatnonzero(~linked)
    total[head[last]] = offset[last] + lengths[last]
    behind[head[last]] = nexts[last]
    return head, offset, total, behind


def _chained(links: DataFrame, block: str) -> DataFrame:
    """id, head, offset, length, next per element of links (id, next, length), chained inside blocks; a written table."""

    def follow(table: pa.Table) -> pa.Table:
        ids, nexts, lengths = (table.column(c).to_numpy() for c in ("id", "next", "length"))
        head, offset, total, behind = chains_of(ids, nexts, lengths)
        return pa.Table.from_arrays([pa.array(x) for x in (ids, ids[head], offset, total, behind)], ["id", "head", "offset", "length", "next"])

    return materialize(links.groupBy(block).applyInArrow(follow, "id long, head long, offset long, length long, next long"), "chains")


def _swallow(links: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(links left, swallowed: id, head, offset) after one round."""
    coin = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(turn)), F.lit(2))
    after = links.filter(coin("id") == 1).select(F.col("id").alias("s"), F.col("length").alias("s_length"), F.col("next").alias("s_next"))
    able = links.withColumn("wanted", F.when((coin("id") == 0) & (F.col("next") != NONE) & (coin("next") == 1), F.col("next")))
    both = materialize(able.join(after, F.col("wanted") == F.col("s"), "left"), "swallowing")
    swallowed = both.filter(F.col("s").isNotNull()).select(F.col("s").alias("id"), F.col("id").alias("head"), F.col("length").alias("offset"))
    left = both.join(swallowed.select(F.col("id").alias("gone")), F.col("id") == F.col("gone"), "left_anti")
    length, behind = F.col("length") + F.coalesce("s_length", F.lit(0)), F.when(F.col("s").isNull(), F.col("next")).otherwise(F.col("s_next"))
    return materialize(left.select("id", length.alias("length"), behind.alias("next")), "links"), swallowed


def _expanded(rows: DataFrame, places: DataFrame) -> DataFrame:
    """id, place of rows (id, head, offset), given the places of heads."""
    heads = places.select(F.col("id").alias("__head"), F.col("place").alias("__place"))
    return rows.join(heads, F.col("head") == F.col("__head")).select("id", (F.col("__place") + F.col("offset")).alias("place"))


def list_places(links: DataFrame, block: str, final: int = FINAL_LINKS) -> DataFrame:
    """id, place (from 0) of every element of links (id, next, and a bounded block); next is -1 at a list's end.  Every list has places of its own."""
    chains = _chained(links.withColumn("length", F.lit(1).cast("long")), block)
    left = materialize(chains.filter(F.col("id") == F.col("head")).select("id", "length", "next"), "links")
    rounds = []
    while left.count() > final:
        left, swallowed = _swallow(left, len(rounds))
        rounds.append(swallowed)

    def rank(table: pa.Table) -> pa.Table:
        ids, nexts, lengths = (table.column(c).to_numpy() for c in ("id", "next", "length"))
        _, offset, _, _ = chains_of(ids, nexts, lengths)
        return pa.Table.from_arrays([pa.array(ids), pa.array(offset)], ["id", "place"])

    places = left.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(rank, "id long, place long")
    for swallowed in reversed(rounds):
        places = materialize(places, "places")
        places = places.unionByName(_expanded(swallowed, places))
    return _expanded(chains.select("id", "head", "offset"), materialize(places, "places"))
