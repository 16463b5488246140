"""Places of rows in an order, and running sums along it, without a task that sees a whole group.

Rows are range-sorted and written; a row's place is its place in its partition plus the rows
of its group in the partitions before, which are summed over one row per partition and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

#: Rows of one block of places in a running sum.
BLOCK = 1 << 16
#: monotonically_increasing_id() holds the partition above these bits and the row's place in it below.
ROW_BITS = 33


def in_order(df: DataFrame, group: list[str], order: list[str], tag: str) -> DataFrame:
    """df range-sorted by group and order (nulls first), as a written table with `part` (partition) and `at` (ascending over all rows).

    Rows that agree in every key come in any order; they too spread over partitions.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys, F.col("__tie")).sortWithinPartitions(*keys, "__tie").drop("__tie")
    return materialize(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", ROW_BITS)), tag)


def spans(rows: DataFrame, group: list[str]) -> DataFrame:
    """part, group, first, ahead, total: a partition's first row of a group, the group's rows in partitions before, all its rows."""
    held = rows.groupBy("part", *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ahead = F.sum("n").over(whole.orderBy("part")) - F.col("n")
    return held.select("part", *group, "first", ahead.alias("ahead"), F.sum("n").over(whole).alias("total"))


def placed(rows: DataFrame, held: DataFrame, group: list[str]) -> DataFrame:
    """rows of in_order() with what held (spans(), more columns allowed) says of their group, and `place` (from 0) in it; `at` and `part` stay."""
    more = [c for c in held.columns if c not in ("part", "first", *group)]
    right = held.select(*(F.col(c).alias(f"__{c}") for c in held.columns))
    on = F.col("part") == F.col("__part")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    place = (F.col("__ahead") + F.col("at") - F.col("__first")).alias("place")
    return rows.join(right, on).select(*rows.columns, *(F.col(f"__{c}").alias(c) for c in more), place)


def ranked(df: DataFrame, group: list[str], order: list[str], tag: str) -> DataFrame:
    """df with `place` (from 0, in its group, by order) and `total` (rows of the group)."""
    rows = in_order(df, group, order, tag)
    return placed(rows, spans(rows, group), group).drop("at", "part", "ahead")


def running_sums(df: DataFrame, place: str, sums: list[str], block: int = BLOCK) -> DataFrame:
    """df with each of `sums` replaced by its sum over all rows of a place not above the row's; places are 0, 1, 2, ...

    Blocks of places are summed each in one task, and the blocks' totals in the same way.
    """
    blocked = df.withColumn("__block", F.floor(F.col(place) / block).cast("long"))
    inside = Window.partitionBy("__block").orderBy(place)
    inner = blocked.select("*", *(F.sum(c).over(inside).alias(f"__in_{c}") for c in sums))
    totals = materialize(blocked.groupBy("__block").agg(*(F.sum(c).alias(c) for c in sums)), "blocks")
    if totals.count() > block:
        upto = running_sums(totals.withColumnRenamed("__block", "p"), "p", sums, block).withColumnRenamed("p", "__block")
    else:
        upto = totals.select("__block", *(F.sum(c).over(Window.orderBy("__block")).alias(c) for c in sums))
    before = upto.select((F.col("__block") + 1).alias("__next"), *(F.col(c).alias(f"__ahead_{c}") for c in sums))
    found = inner.join(before, F.col("__block") == F.col("__next"), "left")
    others = [c for c in df.columns if c not in sums]
    return found.select(*others, *((F.col(f"__in_{c}") + F.coalesce(F.col(f"__ahead_{c}"), F.lit(0))).alias(c) for c in sums))
