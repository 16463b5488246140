"""From raw table cells to rows of points: header rows, column aliases, object ids, units, notes, repeats.

Cells are long-form rows (doc, page, tab, row, col, val), whatever decoder they came from.  A
family of documents is data: its aliases, the type of bare numbers, and what a row must have.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators.headers import squeezed
from tessera.operators.match import rule_side

TABLE = ("doc", "page", "tab")
#: Rows from the top in which a header is looked for; below, a row of data may look like one.
LOOK = 3


@dataclass(frozen=True)
class Family:
    """How one family of documents names its columns.

    aliases: (field, part of a header cell), in order of preference.  keys: the fields of which a
    header must have one.  default_type: the type of ids that are bare numbers.
    """

    name: str
    aliases: Sequence[tuple[str, str]]
    keys: Sequence[str] = ("id",)
    default_type: str | None = None


def header_fields(cells: DataFrame, aliases: DataFrame, keys: Sequence[str], look: int = LOOK) -> DataFrame:
    """doc, page, tab, head (row of the header), field, col of every table.

    aliases: field, alias, ord.  The header is the first of the top rows that has a name and one
    of the key fields; a table without one has its top row as header.  A table's last row is
    never its header.  A field is the cell that holds its first alias, the leftmost of several.
    """
    size = cells.groupBy(*TABLE).agg(F.max("row").alias("last")).filter("last > 0")
    top = cells.filter(F.col("row") < look).join(size, list(TABLE)).filter(F.col("row") < F.greatest("last", F.lit(1)))
    known = rule_side(aliases.select("field", "ord", squeezed(F.col("alias")).alias("alias")))
    hits = top.withColumn("cell", squeezed(F.col("val"))).join(known, F.contains("cell", F.col("alias")))
    fields = hits.groupBy(*TABLE, "row", "field").agg(F.min(F.struct("ord", "col")).alias("best")).select(*TABLE, "row", "field", F.col("best.col").alias("col"))
    shape = fields.groupBy(*TABLE, "row").agg(F.collect_set("field").alias("have"))
    found = shape.filter(F.array_contains("have", "name") & F.arrays_overlap("have", F.array(*map(F.lit, keys)))).groupBy(*TABLE).agg(F.min("row").alias("head"))
    heads = size.select(*TABLE).join(found, list(TABLE), "left").withColumn("head", F.coalesce("head", F.lit(0)))
    return heads.join(fields.withColumnRenamed("row", "head"), [*TABLE, "head"]).select(*TABLE, "head", "field", "col")


def unknown_columns(cells: DataFrame, fields: DataFrame) -> DataFrame:
    """doc, column and n: header cells that no field took, with the number of tables that have them."""
    heads = fields.select(*TABLE, "head").distinct()
    free = cells.join(heads, list(TABLE)).filter((F.col("row") == F.col("head")) & (squeezed(F.col("val")) != ""))
    free = free.join(fields.select(*TABLE, "col"), [*TABLE, "col"], "left_anti")
    return free.groupBy("doc", S.clean_text(F.col("val")).alias("column")).agg(F.count(F.lit(1)).alias("n"))


def body_rows(cells: DataFrame, fields: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per table row below its header, with a column for each field; absent cells are null."""
    below = cells.join(fields, [*TABLE, "col"]).filter(F.col("row") > F.col("head"))
    value = S.present(S.clean_text(F.col("val")))
    return below.groupBy(*TABLE, "row").agg(*(F.max(F.when(F.col("field") == n, value)).alias(n) for n in names))


def point_rows(rows: DataFrame, family: Family) -> DataFrame:
    """Rows with type, inst, name, unit_raw, unit, note and skip: the reason why a row is no point, else null.

    An id is an object id, or digits of the family's default type, or a type cell with a number
    cell.  What stands in the unit's place but is an enumeration goes to the note.
    """
    has = lambda n: F.col(n) if n in rows.columns else F.lit(None).cast("string")
    parsed = S.object_id(has("id"))
    typed = S.object_id(F.concat_ws(" ", has("objtype"), has("instance")))
    bare = F.when(has("id").rlike("^[0-9]{1,6}$"), has("id").try_cast("int"))
    kind = F.coalesce(parsed["type"], F.when(bare.isNotNull(), F.lit(family.default_type)), F.when(has("objtype").isNotNull(), typed["type"]))
    inst = F.coalesce(parsed["inst"], F.when(F.lit(family.default_type).isNotNull(), bare), F.when(has("objtype").isNotNull(), typed["inst"]))
    guard = S.unit_or_note(has("unit"), has("note"))
    repeats_header = squeezed(has("name")).isin(*("".join(a.lower().split()) for f, a in family.aliases if f == "name"))
    skip = F.when(has("name").isNull(), "no name").when(repeats_header, "header again").when(kind.isNull() | inst.isNull(), "no id")
    return rows.select(*TABLE, "row", kind.alias("type"), inst.alias("inst"), has("name").alias("name"), guard["unit"].alias("unit_raw"), S.canonical_unit(guard["unit"]).alias("unit"), guard["note"].alias("note"), skip.alias("skip"))


def scan(cells: DataFrame, family: Family, section: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points, skipped, unknown): the points of a family's documents, counts of skipped rows by reason, and columns without a field.

    Of points with one section, type and instance in a document the first in page, table and row
    order stays; later ones count as skipped (`repeat`).
    """
    spark = cells.sparkSession
    aliases = spark.createDataFrame([(f, a, k) for k, (f, a) in enumerate(family.aliases)], "field string, alias string, ord int")
    fields = header_fields(cells, aliases, family.keys)
    names = list(dict.fromkeys(f for f, _ in family.aliases))
    rows = point_rows(body_rows(cells, fields, names), family).withColumn("family", F.lit(family.name)).withColumn("sect", section if section is not None else F.lit(""))
    place = F.row_number().over(Window.partitionBy("doc", "sect", "type", "inst", F.col("skip").isNull()).orderBy("page", "tab", "row"))
    rows = rows.withColumn("skip", F.when(F.col("skip").isNull() & (place > 1), "repeat").otherwise(F.col("skip")))
    points = rows.filter(F.col("skip").isNull()).drop("skip")
    skipped = rows.filter(F.col("skip").isNotNull()).groupBy("family", "doc", F.col("skip").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return points, skipped, unknown_columns(cells, fields)
