"""Publishing: long and wide tables, child rows, dynamic columns, search, facets and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_long(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per key and field that has a value: keys, feature, value."""
    long = df.select(*keys, F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in fields))).alias("x"))
    return long.select(*keys, "x.feature", "x.value").filter("value is not null")


def to_wide(long: DataFrame, keys: Sequence[str], feature: str, value: str, order: Sequence[str]) -> DataFrame:
    """One row per key with a column per feature, in the given order (so no pass is needed to find the features)."""
    return long.groupBy(*keys).pivot(feature, list(order)).agg(F.max(value))


def present_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Those candidate columns that hold any value, in order: one aggregate row decides."""
    some = df.select(*(F.max(F.col(c).isNotNull()).alias(c) for c in candidates)).first()
    return [c for c in candidates if some[c]]


def with_children(df: DataFrame, keys: Sequence[str], entries: Column, fields: Sequence[str]) -> DataFrame:
    """One row per entry of an array of structs, with its place from 1; rows without entries give none."""
    return df.select(*keys, F.posexplode(entries).alias("place", "x")).select(*keys, (F.col("place") + 1).alias("place"), *(F.col(f"x.{f}").alias(f) for f in fields))


def ratio_tally(df: DataFrame, by: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Rows, and per flag how many rows have it and their share in percent with one decimal."""
    counts = [F.count_if(c).alias(n) for n, c in flags.items()]
    shares = [F.round(100.0 * F.count_if(c) / F.count(F.lit(1)), 1).alias(f"{n}_pct") for n, c in flags.items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *counts, *shares) if by else df.agg(F.count(F.lit(1)).alias("n"), *counts, *shares)


def search(parts: Sequence[tuple[str, DataFrame, Column, Column]], needle: str, cap: int | None = None, label_chars: int | None = None) -> DataFrame:
    """kind, ref and label of rows whose text holds the needle, regardless of case, over several tables.

    The whole text is searched; label_chars cuts only what is shown.  cap: at most that many
    hits per kind, the smallest refs (a feature of the search page).
    """
    found = None
    for kind, df, ref, label in parts:
        hits = df.filter(F.contains(F.lower(label), F.lit(needle.lower()))).select(F.lit(kind).alias("kind"), ref.cast("string").alias("ref"), (F.substring(label, 1, label_chars) if label_chars else label).alias("label"))
        hits = hits.orderBy("ref").limit(cap) if cap else hits
        found = hits if found is None else found.unionByName(hits)
    return found


def top_and_rest(counts: DataFrame, by: str, label: str, n: str, keep: int) -> DataFrame:
    """by, place, label and n: the `keep` most frequent labels, ties by label, then one row for how many more there are and their sum."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(n), label)).cast("long")
    ranked = counts.select(by, F.col(label).alias("label"), F.col(n).alias("n"), place.alias("place"))
    rest = ranked.filter(F.col("place") > keep).groupBy(by).agg(F.concat(F.lit("… "), F.count(F.lit(1)).cast("string"), F.lit(" more")).alias("label"), F.sum("n").alias("n"))
    return ranked.filter(F.col("place") <= keep).select(by, "place", "label", "n").unionByName(rest.select(by, F.lit(keep + 1).cast("long").alias("place"), "label", "n"))


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 60) -> DataFrame:
    """Page `number` (from 0) of the rows in a total order."""
    return df.orderBy(*order).offset(number * size).limit(size)


def keyset_page(df: DataFrame, key: str, after: int | str | None, size: int = 50) -> DataFrame:
    """The next `size` rows (500 at most) after a key: the predicate reaches the scan, nothing is skipped over."""
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(min(size, 500))


def matrix(df: DataFrame, row: str, column: str, value: Column, columns: Sequence[str]) -> DataFrame:
    """Rows by columns, filled with an aggregate's value; n is the number of filled columns."""
    wide = df.groupBy(row).pivot(column, list(columns)).agg(value)
    return wide.withColumn("n", sum((F.when(F.col(f"`{c}`").isNotNull(), 1).otherwise(0) for c in columns), F.lit(0)).cast("long"))


def write_bundle(tables: dict[str, DataFrame], folder: str, form: str = "json") -> None:
    """Every table of a dataset under its name, whole: a bundle is replaced as one, never in part."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer.option("header", "true").csv(f"{folder}/{name}") if form == "csv" else writer.option("ignoreNullFields", "true").format(form).save(f"{folder}/{name}")
