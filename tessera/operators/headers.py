"""Recognising columns of raw tables: aliases, stacked and scrambled headers, headers repaired from values, blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.match import rule_side


def squeezed(text: Column) -> Column:
    """Lower case without white space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", "")


def resolve_columns(cells: DataFrame, table: Sequence[str], column: str, text: str, aliases: DataFrame) -> DataFrame:
    """table, field and column: the header cell that holds a field's alias.

    aliases: field, alias, ord.  The alias with the smallest ord decides, then the leftmost
    cell; a field without a match has no row.
    """
    hits = cells.select(*table, column, squeezed(F.col(text)).alias("__cell")).join(rule_side(aliases.withColumn("__alias", squeezed(F.col("alias")))), F.contains("__cell", F.col("__alias")))
    return hits.groupBy(*table, "field").agg(F.min(F.struct("ord", column)).alias("x")).select(*table, "field", F.col(f"x.{column}").alias(column))


def is_scrambled(text: Column, target: str, missing: int = 1) -> Column:
    """Whether a cell has the letters of the target in any order: at most `missing` of them absent, at most twice its length."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]", "")
    wanted = "".join(c for c in target.lower() if c.isalpha())
    lacking = F.lit(0)
    for letter in sorted(set(wanted)):
        have = F.length(bare) - F.length(F.replace(bare, F.lit(letter), F.lit("")))
        lacking = lacking + F.greatest(F.lit(wanted.count(letter)) - have, F.lit(0))
    return (lacking <= missing) & (F.length(bare) <= 2 * len(wanted))


def merge_stacked(rows: Column) -> Column:
    """Header rows (an array of arrays of cells) joined column by column with blanks, without repeats."""
    first = F.element_at(rows, 1)
    below = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))

    def add(acc: Column, row: Column) -> Column:
        def both(a: Column, b: Column) -> Column:
            x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
            return F.when((y == "") | F.contains(x, y), x).when(x == "", y).otherwise(F.concat(x, F.lit(" "), y))

        return F.zip_with(acc, row, both)

    return F.aggregate(below, first, add)


def swapped_columns(rows: DataFrame, table: Sequence[str], a: Column, b: Column, least: int = 2) -> DataFrame:
    """table and swapped: whether at least `least` rows show both columns holding what the other is meant to hold."""
    return rows.groupBy(*table).agg((F.count_if(a & b) >= least).alias("swapped"))


def raw_if_different(raw: Column, shown: Column) -> Column:
    """The raw cell where it says something else than the shown one."""
    return F.when(~squeezed(raw).eqNullSafe(squeezed(shown)), raw)


def blocks(lines: DataFrame, by: Sequence[str], order: str, starts: Column, out: str = "block") -> DataFrame:
    """Every line with the number of its block; a block starts at each marked line, lines before the first have 0."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(out, F.sum(F.when(starts, 1).otherwise(0)).over(w))


def restore_typography(names: DataFrame, name: str, words: DataFrame, word: str) -> DataFrame:
    """name and restored: the one page word with the same squeezed letters; names with none or several stay."""
    key = lambda c: F.regexp_replace(F.lower(F.col(c)), "[^a-z0-9]", "")
    unique = words.select(key(word).alias("__key"), word).distinct().groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.min(word).alias("__word")).filter("__n = 1")
    return names.select(name, key(name).alias("__key")).distinct().join(unique, "__key", "left").select(name, F.coalesce("__word", name).alias("restored"))


def restored_by_page(values: DataFrame, words: DataFrame, by: Sequence[str], value: str, longest: int = 3) -> DataFrame:
    """values with `restored` and `found`: names whose underscores and blanks were lost, as the page itself writes them.

    words: by, pos, word of the page's text.  Words and runs of up to `longest` of them, joined, are
    looked up by what is left without blanks and underscores; the shortest run that fits decides.
    If it is written in more than one way, or no run fits, the value stays; found says whether it
    was restored or stands on the page as it is.
    """
    bare = lambda c: F.regexp_replace(c, r"[\s_]+", "")
    along = Window.partitionBy(*by).orderBy("pos")
    ahead = words.withColumns({f"__w{k}": F.lead("word", k).over(along) if k else F.col("word") for k in range(longest)})
    runs = F.array(*(F.struct(F.lit(n).alias("n"), F.concat(*(F.col(f"__w{k}") for k in range(n))).alias("gram")) for n in range(1, longest + 1)))
    grams = ahead.select(*by, F.explode(runs).alias("g")).select(*by, "g.n", "g.gram").filter("gram is not null").withColumn("key", bare(F.col("gram"))).filter("key <> ''")
    index = grams.groupBy(*by, "n", "key").agg(F.min("gram").alias("gram"), (F.min("gram") != F.max("gram")).alias("ambiguous"))
    index = index.groupBy(*by, "key").agg(F.min_by(F.struct("gram", "ambiguous"), "n").alias("hit"))
    text = words.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"]), " ").alias("page_text"))
    clean = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " "))
    rows = values.withColumn("__clean", clean).withColumn("key", bare(F.col("__clean")))
    rows = rows.join(index, [*by, "key"], "left").join(text, list(by), "left")
    there = F.when(F.col("__clean") == "", True).when(F.col("hit").isNull(), F.coalesce(F.contains("page_text", F.col("__clean")), F.lit(False))).otherwise(~F.col("hit.ambiguous"))
    restored = F.when(F.col("hit").isNotNull() & ~F.col("hit.ambiguous"), F.col("hit.gram")).otherwise(F.col("__clean"))
    return rows.withColumns({"restored": restored, "found": there}).drop("__clean", "key", "hit", "page_text")
