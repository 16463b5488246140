"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key scaled by its quality weight (Efraimidis and
Spirakis).  A source's budget is met by whole epochs first; the rest takes documents in
key order while their prefix sum of words stays nearest the budget.  The order inside a
source is never built in one place: keys fall into many ranges, sums per range find the
one range where the budget ends, and only that range is sorted.

Only built-in column functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_SQL, join_dimension, materialize, unit_hash

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
SYMBOLS_SQL = "[#*$%&|<>]"
#: Expected rows of one key range at most, and the widest range as a ratio of its ends.
RANGE_ROWS, WIDEST = 20_000, 0.1
#: Key ranges of one block, the step in which their sizes are summed first.
BLOCK_RANGES = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, less the more symbols a text has per word."""
    return 1.0 / (1.0 + 10.0 * F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS_SQL)) / F.greatest(size, F.lit(1)))


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, size and sampling key of every row."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), "text")
    weighed = sized.select("doc_id", "source", "size", quality_weight(F.col("text"), F.col("size")).alias("w"))
    return weighed.select("doc_id", "source", "size", _key(seed))


def _key(seed: str) -> Column:
    return (-F.log(unit_hash(F.col("doc_id"), seed)) / F.col("w")).alias("key")


def _ranged(keyed: DataFrame, step: float) -> DataFrame:
    """Ranges whose ends stand in a fixed ratio.

    A key of weight w lies between x and x * (1 + d) with a chance of w * x * d / exp(w * x) at
    most, so in any range with d / e at most, whatever the weight.
    """
    return keyed.withColumn("range", F.floor(F.log("key") / F.lit(step)))


def range_step(rows: int) -> float:
    """Logarithm of the ratio of a range's ends for so many rows."""
    return math.log1p(min(WIDEST, math.e * RANGE_ROWS / max(rows, 1)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, target from source, source_size: shares by weight, cut at cap times the size.

    Sources are in code point order, null last.  The level at which uncut sources share
    follows from prefix sums in the order in which sources reach their cut.  There is one
    row per source here, so one sorted pass over them is small beside the documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1)
    ranked = sizes.select("source", "source_size", weight.alias("weight"), (F.lit(float(cap)) * F.col("source_size")).alias("most"))
    everything = Window.partitionBy(F.lit(0))
    earlier = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = ranked.select(
        "*",
        (
            (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        ).alias("level"),
    )
    reached = F.min(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))).over(everything)["level"]
    return level.select("source", "source_size", F.least(F.col("most"), F.coalesce(reached, F.lit(0.0)) * F.col("weight")).alias("target"))


def _crossing(sums: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """source, key, before, rest: the first key up to which the sizes of a source reach its rest, and the sizes before it.

    sums: source, key, size; wanted: source, rest and the sizes before the first key.
    """
    running = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy(key)))
    reached = join_dimension(running, wanted, "source", "inner").filter(F.col("upto") + F.col("before") >= F.col("rest"))
    found = reached.groupBy("source").agg(F.min(F.struct(key, (F.col("before") + F.col("upto") - F.col("size")).alias("before"))).alias("end"), F.first("rest").alias("rest"))
    return found.select("source", F.col(f"end.{key}").alias(key), F.col("end.before").alias("before"), "rest")


def mixing_plan(docs: DataFrame, seed: str = "mix") -> tuple[DataFrame, DataFrame, float]:
    """(keyed documents, plan, width of the key ranges): the plan has one row per source: source_size, target, epochs and where the fraction ends.

    A row of the fraction has range < cut_range, or range = cut_range and (key, doc_id) up to (cut_key, cut_id).
    """
    keyed = materialize(_keyed(docs, seed), "keyed")
    step = range_step(keyed.count())
    keyed = _ranged(keyed, step)
    sums = materialize(keyed.groupBy("source", "range").agg(F.sum("size").alias("size")), "ranges")
    targets = source_targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")))
    budget = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    budget = materialize(budget.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")

    # Where a budget ends is found in two steps, blocks of ranges and then the ranges of one block, so no task sees all ranges of a source.
    blocked = sums.withColumn("block", F.floor(F.col("range") / BLOCK_RANGES))
    wanted = budget.filter("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("before"))
    block_ends = materialize(_crossing(blocked.groupBy("source", "block").agg(F.sum("size").alias("size")), "block", wanted), "blocks")
    inner = join_dimension(blocked, block_ends.withColumnRenamed("block", "end_block"), "source", "inner").filter(F.col("block") == F.col("end_block"))
    ends = _crossing(inner.select("source", "range", "size"), "range", block_ends.select("source", "rest", "before"))
    ends = materialize(ends.withColumnRenamed("range", "cut_range"), "ends")
    inside = join_dimension(keyed, ends, "source", "inner").filter(F.col("range") == F.col("cut_range"))
    # Repeated rows share a key and are taken together: one row for all of them, however many.
    inside = inside.groupBy("source", "before", "rest", "key", "doc_id").agg(F.sum("size").alias("all"), F.max("size").alias("size"))
    order = Window.partitionBy("source").orderBy("key", "doc_id")
    cuts = (
        inside.withColumn("upto", F.col("before") + F.sum("all").over(order))
        .filter(F.col("upto") - F.col("size") / 2 <= F.col("rest"))
        .groupBy("source")
        .agg(F.max(F.struct("key", "doc_id")).alias("cut"))
    )
    same = F.col("p.source").eqNullSafe(F.col("e.source"))
    last = F.col("p.source").eqNullSafe(F.col("c.source"))
    plan = (
        budget.alias("p").join(ends.alias("e"), same, "left").join(cuts.alias("c"), last, "left")
        .select("p.source", "p.source_size", "p.target", "p.epochs", "e.cut_range", F.col("c.cut.key").alias("cut_key"), F.col("c.cut.doc_id").alias("cut_id"))
    )
    return keyed, materialize(plan, "plan"), step


def _copies() -> Column:
    tie = (F.col("key") == F.col("cut_key")) & (F.col("doc_id").eqNullSafe(F.col("cut_id")) | F.col("doc_id").isNull() | (F.col("doc_id") < F.col("cut_id")))
    chosen = (F.col("range") < F.col("cut_range")) | ((F.col("range") == F.col("cut_range")) & ((F.col("key") < F.col("cut_key")) | tie))
    return F.col("epochs") + F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(0)


def mix_counts(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document.

    docs: doc_id, source, text.  Null and empty texts have size 0 and are taken 0 times
    their words; the null source is a source of its own, ordered last.  Repeated rows
    share a key and are taken together.  Keys come from a hash of doc_id: reruns agree.
    """
    keyed, plan, _ = mixing_plan(docs, seed)
    found = join_dimension(keyed, plan, "source", "left").withColumn("copies", _copies().cast("long"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with docs' own columns.

    Keys are computed from the rows themselves, so only the small plan is joined to the
    texts and no text is shuffled.
    """
    _, plan, step = mixing_plan(docs, seed)
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    sized = whole.select("row", "row.doc_id", "row.source", word_count(F.col("row.text")).alias("size"))
    weighed = sized.select("row", "doc_id", "source", quality_weight(F.col("row.text"), F.col("size")).alias("w"))
    rows = _ranged(weighed.select("row", "doc_id", "source", _key(seed)), step)
    found = join_dimension(rows, plan, "source", "left").withColumn("copies", _copies().cast("int"))
    return found.filter(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}')) AS BIGINT) AS size,
    len(regexp_extract_all(coalesce(text, ''), '{SYMBOLS_SQL}')) AS symbols,
    (CAST('0x' || substring(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
keyed AS (SELECT doc_id, source, size, -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE + 10.0::DOUBLE * symbols / greatest(size, 1))) AS k FROM sized),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2.0::DOUBLE * source_size AS most
  FROM sizes),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM ranked WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
reached AS (SELECT arg_min(level, most / weight) AS level FROM levels WHERE level <= most / weight),
targets AS (SELECT l.source, l.source_size, least(l.most, coalesce(r.level, 0) * l.weight) AS target FROM levels l, reached r),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets),
summed AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM keyed k JOIN budget b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN rest > 0 AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken,
  CAST(epochs + CASE WHEN rest > 0 AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM summed
"""
