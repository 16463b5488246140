"""Order-dependent operators.

Each takes explicit order columns and, where it works per entity, partition columns.
Window forms stream through a partition.  The folds (bands, assignment) hold one entity's
rows as an array: an entity there is a document or an interface, not a skewed join key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.scratch import materialize

#: Places of an entity whose chain of segments one array holds.
BLOCK_PLACES = 4096


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def forward_fill(df: DataFrame, value: str, by: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """The last non-null value at or before each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, value: str, out: str) -> DataFrame:
    """Rows of left with the value of the last right row at or before their position; right rows at the same position count.

    Both sides are put in one order and the value is carried forward: one shuffle by key,
    no comparison of pairs.  Of right rows at one position the greatest value counts.
    """
    marks = right.groupBy(*by, at).agg(F.max(value).alias("__value"))
    both = left.withColumn("__value", F.lit(None).cast(marks.schema["__value"].dataType)).withColumn("__side", F.lit(1)).unionByName(marks.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    filled = forward_fill(both, "__value", by, [at, "__side"], out)
    return filled.filter("__side = 1").drop("__value", "__side")


def gap_clusters(df: DataFrame, by: Sequence[str], value: str, tolerance: float | Column, ties: Sequence[str] = ()) -> DataFrame:
    """cluster: 0, 1, ... per entity; a new one starts where the gap to the row before exceeds the tolerance."""
    w = Window.partitionBy(*by).orderBy(value, *ties)
    gap = F.col(value) - F.lag(value).over(w)
    starts = F.when(gap > tolerance, 1).otherwise(0)
    return df.withColumn("__start", starts).withColumn("cluster", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__start")


def neighbour_overlap(df: DataFrame, kinds: str, by: Sequence[str], order: Sequence[str], least: int, out: str) -> DataFrame:
    """Whether a row has enough kinds, or shares one with the row before or after it."""
    w = Window.partitionBy(*by).orderBy(*order)
    before, after = (F.coalesce(F.arrays_overlap(F.col(kinds), f(kinds).over(w)), F.lit(False)) for f in (F.lag, F.lead))
    return df.withColumn(out, (F.size(kinds) >= least) | before | after)


def _gathered(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, *columns))).alias("rows"))


def key_reuse_segments(df: DataFrame, by: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """by, order, key and segment: a new segment starts where a key was already seen since the last start; null keys never count as seen.

    If a segment starts at place s, the next one starts at the first place that repeats a key
    of s or later: the least next occurrence of all places from s on.  The chain of these
    starts is followed inside blocks of BLOCK_PLACES places; entities of more than one block
    find where the chain enters each of theirs by doubling, over written tables.
    """
    keys = list(by)
    places = df.select(*by, *order, key).withColumn("__at", F.row_number().over(Window.partitionBy(*by).orderBy(*order, key)).cast("long"))
    again = F.when(F.col(key).isNotNull(), F.lead("__at").over(Window.partitionBy(*by, key).orderBy("__at")))
    behind = Window.partitionBy(*by).orderBy(F.desc("__at")).rowsBetween(Window.unboundedPreceding, 0)
    places = materialize(places.withColumn("__again", again).withColumn("__next", F.coalesce(F.min("__again").over(behind), F.lit(0).cast("long"))).drop("__again"), "places")
    size = BLOCK_PLACES
    block = F.floor((F.col("__at") - 1) / size).cast("long").alias("__block")
    blocks = places.groupBy(*by, block).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__next"))), lambda x: x["__next"]).alias("nexts"))
    blocks = materialize(blocks, "blocks")
    schema = ", ".join(f"`{c}` {t}" for c, t in blocks.select(*by).dtypes)
    entries = places.filter("__at = 1").select(*by, "__at")
    if blocks.filter("__block > 0").limit(1).count():
        entries = _entries(entries, blocks.mapInArrow(lambda x: _block_exits(x, size), f"{schema}, __at long, __next long"), keys)
    entries = entries.select(*(F.col(c).alias(f"e_{c}") for c in by), F.col("__at").alias("entry"))
    first = F.floor((F.col("entry") - 1) / size)
    on = [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in by] + [F.col("__block") == first]
    entered = blocks.join(entries, on).select(*by, "__block", "nexts", "entry")
    starts = entered.mapInArrow(lambda x: _block_starts(x, size), f"{schema}, __at long")
    starts = starts.select(*(F.col(c).alias(f"s_{c}") for c in by), F.col("__at").alias("s_at"))
    marked = places.join(starts, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in by] + [F.col("__at") == F.col("s_at")], "left")
    upto = Window.partitionBy(*by).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    return marked.select(*by, *order, key, (F.count("s_at").over(upto) - 1).cast("int").alias("segment"))


def _block_exits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per place: the first place of the chain from it that lies in a later block; none where the chain ends before."""
    for batch in batches:
        owner, at, found = [], [], []
        for k, (block, nexts) in enumerate(zip(batch.column("__block").to_pylist(), batch.column("nexts").to_pylist(), strict=True)):
            base, exits = block * size + 1, list(nexts)
            for i in range(len(nexts) - 1, -1, -1):
                inside = nexts[i] - base
                exits[i] = exits[inside] if 0 <= inside < len(nexts) else nexts[i]
            kept = [i for i, x in enumerate(exits) if x]
            owner += [k] * len(kept)
            at += [base + i for i in kept]
            found += [exits[i] for i in kept]
        names = [c for c in batch.schema.names if c not in ("__block", "nexts")]
        rows = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in names), pa.array(at, pa.int64()), pa.array(found, pa.int64())], [*names, "__at", "__next"])


def _block_starts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The places of the chain from a block's entry on that lie in the block."""
    for batch in batches:
        owner, at = [], []
        for k, (block, nexts, place) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("__block", "nexts", "entry")), strict=True)):
            base = block * size + 1
            while base <= place < base + len(nexts):
                owner.append(k)
                at.append(place)
                place = nexts[place - base]
        names = [c for c in batch.schema.names if c not in ("__block", "nexts", "entry")]
        rows = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in names), pa.array(at, pa.int64())], [*names, "__at"])


def _entries(starts: DataFrame, jumps: DataFrame, by: list[str]) -> DataFrame:
    """starts (by, __at) and all that follow from them by jumps (by, __at, __next), by doubling."""
    jumps = materialize(jumps, "jumps")
    same = lambda x, y, at: [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in by] + [F.col(at) == F.col("j.__at")]
    while jumps.limit(1).count():
        landed = starts.alias("s").join(jumps.alias("j"), same("s", "j", "s.__at")).select(*(f"s.{c}" for c in by), F.col("j.__next").alias("__at"))
        starts = materialize(starts.unionByName(landed).distinct(), "starts")
        farther = jumps.alias("f").join(jumps.alias("j"), same("f", "j", "f.__next")).select(*(f"f.{c}" for c in by), "f.__at", "j.__next")
        jumps = materialize(farther, "jumps")
    return starts


def band_groups(df: DataFrame, by: Sequence[str], order: Sequence[str], low: str, high: str) -> DataFrame:
    """by, order, low, high and band: a block joins the band before it iff it starts above that band's highest address."""
    rows = _gathered(df, by, order, [low, high])
    empty = F.struct(F.lit(-1).alias("band"), F.lit(None).cast("double").alias("top"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        joins = F.coalesce(row[low].cast("double") > acc["top"], F.lit(False))
        band = acc["band"] + F.when(joins, 0).otherwise(1)
        top = F.when(joins, F.greatest(acc["top"], row[high].cast("double"))).otherwise(row[high].cast("double"))
        return F.struct(band.alias("band"), top.alias("top"), F.concat(acc["out"], F.array(band)).alias("out"))

    folded = rows.withColumn("bands", F.aggregate("rows", empty, step, lambda acc: acc["out"]))
    return folded.select(*by, F.explode(F.arrays_zip("rows", "bands")).alias("x")).select(*by, *(F.col(f"x.rows.{c}").alias(c) for c in (*order, low, high)), F.col("x.bands").alias("band"))


def greedy_assignment(candidates: DataFrame, by: Sequence[str], rule_order: str, rule: str, item: str, score: str) -> DataFrame:
    """by, rule and item: rules in order each claim their best item that no earlier rule claimed.

    candidates has one row per (entity, rule, item); the best has the highest score, then
    the smallest item.  Items are claimed by name: equal names are claimed together.  An
    earlier rule claims one item at most, so of each rule's items only as many as there are
    rules can ever be claimed; the others go before anything is gathered.
    """
    rules = candidates.select(rule_order, rule).distinct().count()
    scored = candidates.groupBy(*by, rule_order, rule, item).agg(F.max(score).alias(score))
    place = F.row_number().over(Window.partitionBy(*by, rule_order, rule).orderBy(F.desc(score), item))
    able = scored.withColumn("__place", place).filter(F.col("__place") <= rules)
    per_rule = able.groupBy(*by, rule_order, rule).agg(F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(item).alias("i")))).alias("c"))
    rows = per_rule.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(rule_order, rule, "c"))).alias("rules"))
    taken = "array<struct<rule:string,item:string>>"
    empty = F.struct(F.array().cast("array<string>").alias("used"), F.array().cast(taken).alias("out"))

    def step(acc: Column, row: Column) -> Column:
        free = F.filter(row["c"], lambda x: ~F.array_contains(acc["used"], x["i"]))
        best = F.try_element_at(free, F.lit(1))["i"]
        pair = F.array(F.struct(row[rule].cast("string").alias("rule"), best.alias("item"))).cast(taken)
        hit = best.isNotNull()
        return F.struct(F.when(hit, F.concat(acc["used"], F.array(best))).otherwise(acc["used"]).alias("used"), F.when(hit, F.concat(acc["out"], pair)).otherwise(acc["out"]).alias("out"))

    folded = rows.select(*by, F.explode(F.aggregate("rules", empty, step, lambda acc: acc["out"])).alias("x"))
    return folded.select(*by, "x.rule", "x.item")


def consume_pairs(df: DataFrame, by: Sequence[str], order: str, is_label: Column, is_value: Column) -> DataFrame:
    """The rows that are labels answered by the next row, as (by, order, next order); a consumed value can't be a label.

    A label followed by a value uses both.  In a run of rows that could be either, pairs
    are formed from the run's start, two by two.
    """
    w = Window.partitionBy(*by).orderBy(order)
    marked = df.withColumn("__can", F.coalesce(is_label & F.lead(is_value).over(w), F.lit(False))).withColumn("__next", F.lead(order).over(w))
    broken = marked.withColumn("__break", F.when(F.coalesce(F.lag("__can").over(w), F.lit(False)), 0).otherwise(1))
    run = broken.withColumn("__run", F.sum("__break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.row_number().over(Window.partitionBy(*by, "__run").orderBy(order))
    return run.withColumn("__place", place).filter(F.col("__can") & (F.col("__place") % 2 == 1)).select(*by, order, F.col("__next").alias("value_at"))


def split_at_first(df: DataFrame, by: Sequence[str], order: str, mark: Column, out: str) -> DataFrame:
    """0 before the first marked row of an entity, 1 from it on; entities without a mark, or with one at their start, stay 0."""
    w = Window.partitionBy(*by)
    cut = F.min(F.when(mark, F.col(order))).over(w)
    start = F.min(order).over(w)
    return df.withColumn(out, F.when(cut.isNotNull() & (cut > start) & (F.col(order) >= cut), 1).otherwise(0))


def stitch(df: DataFrame, by: Sequence[str], order: str, continues: Column, text: str) -> DataFrame:
    """Rows with their continuation rows appended: by, order of the first row, text joined by blanks."""
    w = Window.partitionBy(*by).orderBy(order)
    island = df.withColumn("__new", F.when(continues & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1))
    island = island.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = island.groupBy(*by, "__island").agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("rows"))
    return rows.select(*by, F.col("rows")[0][order].alias(order), F.array_join(F.transform("rows", lambda r: r[text]), " ").alias(text), F.size("rows").cast("long").alias("n_parts"))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], tagged: Column, out: str) -> DataFrame:
    """Numbers from 1 per entity over tagged rows only; null on the others."""
    upto = F.sum(F.when(tagged, 1).otherwise(0)).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, F.when(tagged, upto))
