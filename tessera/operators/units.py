"""Unit models from rating tables: where a table names its units, and the values of each.

Tables come as long cells (by, row, col, value): row 0 is the header, column 0 holds the labels.
Everything is an aggregate or a window per table; a table's own size bounds what meets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S

#: Patterns by which documents name units.
CODE_TOKEN = r"[A-Z][A-Za-z/\-]{0,8}\d{2,}"
LONG_CODE = r"[A-Z][A-Za-z/]*\d+[A-Za-z0-9*\-]*"
NO_CODE = r"(?i)^(system data|cooling performance|efficiency)$"
RATING_TITLE = r"(?i)general data|physical data|tons? nominal capacity"
SIZE_HEAD, SIZE_COLUMN = r"(?i)^siz", r"(?i)air\s?f\s?l\s?o\s?w|^width"
PREFIXES = ("AM", "RC", "DV", "ARUM", "ARUN", "PRHR", "PAHC", "LG")
#: A value of more characters or numbers than these is several values pressed into one cell.
LONGEST_VALUE, MOST_NUMBERS = 60, 8
#: The rungs of the ladder: rows of sizes, then six places for codes, then capacities in the header.
SIZE_ROWS, FIRST_ROW, HEADER, TITLE_AND_SIZE, TITLE_AND_LETTER, PREFIX_IN_HEADER, PREFIX_IN_ROW, CAPACITY = range(8)


def promoted(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """cells of tables whose header is a banner (blank above the labels, while the first row starts with a size) with that row as header."""
    table = Window.partitionBy(*by)
    at = lambda row: F.max(F.when((F.col("row") == row) & (F.col("col") == 0), F.trim("value"))).over(table)
    marked = cells.withColumn("__banner", (F.coalesce(at(0), F.lit("")) == "") & F.coalesce(at(1), F.lit("")).rlike(SIZE_HEAD))
    shifted = F.when(F.col("__banner"), F.col("row") - 1).otherwise(F.col("row"))
    return marked.withColumn("row", shifted).filter("row >= 0").drop("__banner")


def unit_codes(cells: DataFrame, tables: DataFrame, by: Sequence[str], prefixes: Sequence[str] = PREFIXES) -> DataFrame:
    """by, rung, row, col and code of every unit that a table names; row or col, by which its values are found, is null.

    tables: by, title, kind, family.  Tables of sizes are known by their shape whatever their kind;
    others must be ratings with a title that says so.  Of the ways in which a table may name its
    units the first that finds any counts, with all it finds.
    """
    cells = promoted(cells, by)
    title = F.coalesce("title", F.lit(""))
    head = F.when(F.col("row") == 0, F.col("value"))
    nominal = F.min(F.when((F.col("row") > 0) & (F.col("col") == 0) & F.col("value").rlike("(?i)^NOMINAL CAPACITY"), F.col("row")))
    of_table = cells.groupBy(*by).agg(
        F.coalesce(F.bool_or((F.col("col") == 0) & head.rlike(SIZE_HEAD)), F.lit(False)).alias("sized"), F.coalesce(F.bool_or(head.rlike(SIZE_COLUMN)), F.lit(False)).alias("flows"), nominal.alias("nominal"),
        F.collect_set(F.when((F.col("col") == 1) & (F.col("value") != ""), F.col("row"))).alias("answered"),
    )
    of_table = of_table.join(tables.select(*by, title.alias("title"), F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("family", F.lit("")).alias("family")), list(by))
    of_table = of_table.withColumns({"sizes": F.col("sized") & F.col("flows"), "rated": (F.col("kind") == "rating") & F.col("title").rlike(RATING_TITLE), "nominal": F.array_contains("answered", F.col("nominal"))}).drop("answered", "sized", "flows")

    columns = cells.filter("col >= 1 and row <= 1").groupBy(*by, "col").agg(F.max(F.when(F.col("row") == 0, F.col("value"))).alias("head"), F.max(F.when(F.col("row") == 1, F.trim("value"))).alias("first"))
    columns = columns.join(of_table.filter("rated and not sizes"), list(by)).withColumns({"head": F.coalesce("head", F.lit("")), "first": F.coalesce("first", F.lit(""))})
    bare = F.trim(F.regexp_replace("head", r"(?i)^models?\s+", ""))
    family = F.upper(F.regexp_extract("title", r"(?i)model\s+([A-Z]{2,6})\b\s*\d", 1))
    series = F.regexp_extract("title", r"^([\w/]+)\s+SIZES\b", 1)
    prefix = rf"(?i)^({'|'.join(prefixes)})\d+[A-Z0-9]+"
    token = F.regexp_extract(bare, LONG_CODE, 0)
    condensing = F.regexp_extract("title", r"([A-Z]{3,}\d*)\s+condensing units", 1)
    ways: dict[int, Column] = {
        FIRST_ROW: F.when(F.col("first").rlike(CODE_TOKEN) & ~F.col("first").rlike(NO_CODE), F.col("first")),
        HEADER: F.when(bare.rlike(CODE_TOKEN), F.when(F.length(bare) <= 24, bare).when(token != "", token)),
        TITLE_AND_SIZE: F.when((family != "") & F.col("first").rlike(r"^\d{2,3}$"), F.concat_ws(" ", family, "first")),
        TITLE_AND_LETTER: F.when((series != "") & F.coalesce("nominal", F.lit(False)) & F.col("head").rlike(r"^[A-Z]$"), F.concat_ws(" ", series, "head")),
        PREFIX_IN_HEADER: F.when(F.col("head").rlike(prefix), F.col("head")),
        PREFIX_IN_ROW: F.when(F.col("first").rlike(prefix), F.col("first")),
        CAPACITY: F.when(F.col("head").rlike(r"^\d{2,3}$"), F.trim(F.concat_ws(" ", F.when(condensing != "", condensing).otherwise(F.col("family")), "head", F.lit("Ton")))),
    }
    tried = columns.select(*by, "col", F.explode(F.array(*(F.struct(F.lit(rung).alias("rung"), code.alias("code")) for rung, code in ways.items()))).alias("way")).select(*by, "col", "way.*").filter("code is not null")
    lowest = tried.withColumn("least", F.min("rung").over(Window.partitionBy(*by))).filter("rung = least")
    sized = cells.filter((F.col("col") == 0) & (F.col("row") > 0) & F.trim("value").rlike(r"^\d{2,3}$")).join(of_table.filter("sizes"), list(by))
    sized = sized.select(*by, F.lit(SIZE_ROWS).alias("rung"), "row", F.lit(None).cast("int").alias("col"), F.trim(F.concat_ws(" ", "family", F.trim("value"))).alias("code"))
    return sized.unionByName(lowest.select(*by, "rung", F.lit(None).cast("int").alias("row"), F.col("col").cast("int").alias("col"), "code"))


def plausible(value: Column) -> Column:
    """Is it one value, not several of them pressed into one cell?"""
    return (F.length(value) <= LONGEST_VALUE) & (F.regexp_count(value, F.lit(r"\d+(?:[.,]\d+)?")) <= MOST_NUMBERS)


def unit_values(cells: DataFrame, codes: DataFrame, by: Sequence[str], fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """by, col, code, field, value and unit for the units of unit_codes() that stand in columns.

    fields: patterns of labels, in order of preference.  The first row with such a label gives the
    value, rows of pressed values passed over; where the unit's own column is empty, that of the
    header cell that it stands under does.  The unit is the label's, for tables of capacities with a
    column of units that column's.
    """
    values = cells.select(*by, "row", F.col("col").cast("int").alias("col"), F.trim("value").alias("value")).filter("value <> ''")
    label = F.col("value")
    matches = [F.when(label.rlike(f"(?i){pattern}"), F.struct(F.lit(field).alias("field"), F.lit(k).alias("choice"))) for field, patterns in fields.items() for k, pattern in enumerate(patterns)]
    labelled = values.filter("col = 0 and row > 0").select(*by, "row", F.col("value").alias("label"), F.explode(F.array_compact(F.array(*matches))).alias("m")).select(*by, "row", "label", "m.*")
    own = codes.filter("col is not null")
    heads = values.filter("row = 0 and col > 0").select(*by, F.col("col").alias("start"))
    under = own.join(heads, list(by)).filter("start <= col").groupBy(*by, "col").agg(F.max("start").alias("start"))
    places = own.join(under, [*by, "col"], "left").select(*by, "col", "code", "rung", F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("col").alias("at")), F.struct(F.lit(1).alias("way"), F.when(F.col("start") < F.col("col"), F.col("start")).alias("at")))).alias("p"))
    places = places.select(*by, "col", "code", "rung", "p.*").filter("at is not null")
    first_capacity = Window.partitionBy(*by)
    places = places.withColumn("unit_col", F.when((F.col("rung") == CAPACITY) & (F.min("col").over(first_capacity) >= 2), 1))
    asked = places.join(labelled, list(by))
    found = asked.join(values.select(*by, "row", F.col("col").alias("at"), "value"), [*by, "row", "at"], "left")
    found = found.join(values.filter("col = 1").select(*by, "row", F.lit(1).alias("unit_col"), F.col("value").alias("beside")), [*by, "row", "unit_col"], "left")
    found = found.filter(F.col("value").isNull() | plausible(F.col("value")))
    first = found.groupBy(*by, "col", "code", "field", "choice", "way").agg(F.min_by(F.struct("value", "label", "beside"), "row").alias("r")).filter("r.value is not null")
    best = first.groupBy(*by, "col", "code", "field").agg(F.min_by("r", F.struct("choice", "way")).alias("r"))
    beside = F.when((F.length("r.beside") <= 8) & ~F.col("r.beside").rlike(r"^[\d.,/ –-]+$"), F.col("r.beside"))
    return best.select(*by, "col", "code", "field", F.col("r.value").alias("value"), F.coalesce(S.label_unit(F.col("r.label")), beside, F.lit("")).alias("unit"))
