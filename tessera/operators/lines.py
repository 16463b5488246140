"""Reading text lines: second readings, sections, label and value pairs, parameter blocks, tables in Markdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import order


def text_lines(df: DataFrame, ids: Sequence[str], text: str, crop: int = 0) -> DataFrame:
    """ids, pos and line of every line with a character, cleaned; the first `crop` lines of a text (a page's header band) are left out."""
    cut = df.select(*ids, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("pos", "line"))
    return cut.select(*ids, "pos", S.clean_text(F.col("line")).alias("line")).filter((F.col("line") != "") & (F.col("pos") >= crop))


def readings(lines: DataFrame, ids: Sequence[str], readers: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """ids, pos, reader, code and name: what independent readers find.

    A reader is (name, pattern, group of the code, group of the name); group 0 of the name takes
    the next line instead.  Of several readers that fit a line the first counts.
    """
    following = F.lead("line").over(Window.partitionBy(*ids).orderBy("pos"))
    rows = lines.withColumn("next", following)
    found = F.lit(None).cast("struct<reader:string,code:string,name:string>")
    for reader, pattern, code, name in reversed(list(readers)):
        named = F.regexp_extract("line", pattern, name) if name else F.col("next")
        hit = F.struct(F.lit(reader).alias("reader"), F.regexp_extract("line", pattern, code).alias("code"), S.clean_text(named).alias("name"))
        found = F.when(F.col("line").rlike(pattern), hit).otherwise(found)
    return rows.select(*ids, "pos", found.alias("x")).filter("x is not null").select(*ids, "pos", "x.*")


def section_typed(lines: DataFrame, ids: Sequence[str], caption: str, number: str) -> DataFrame:
    """ids, pos, type, inst and name of lines that start with a number; the type is that of the last caption before, null without one.

    caption: a pattern whose first group is the type; number: one with groups for number and name.
    """
    marked = lines.withColumn("caption", F.when(F.col("line").rlike(caption), F.regexp_extract("line", caption, 1)))
    typed = order.forward_fill(marked, "caption", ids, ["pos"], "type").filter(F.col("caption").isNull() & F.col("line").rlike(number))
    return typed.select(*ids, "pos", "type", F.regexp_extract("line", number, 1).try_cast("int").alias("inst"), F.regexp_extract("line", number, 2).alias("name"))


def label_values(lines: DataFrame, ids: Sequence[str], section: Column, is_label: Column, is_value: Column) -> DataFrame:
    """ids, section, label and value: a label line answered by the next line, under the last section line before; the first of equal labels and values."""
    named = order.forward_fill(lines.withColumn("head", F.when(section, F.col("line"))), "head", ids, ["pos"], "section").filter(F.col("head").isNull())
    w = Window.partitionBy(*ids).orderBy("pos")
    pairs = order.consume_pairs(named, ids, "pos", is_label, is_value)
    with_next = named.withColumn("value", F.lead("line").over(w)).withColumnRenamed("line", "label")
    rows = with_next.join(pairs.select(*ids, "pos"), [*ids, "pos"], "left_semi").select(*ids, "pos", "section", "label", "value")
    return order.first_wins(rows, [*ids, "section", "label", "value"], ["pos"]).drop("pos")


def parameters(lines: DataFrame, ids: Sequence[str], head: str) -> DataFrame:
    """ids, number, title, kind, default, low, high, unit and description of numbered parameter blocks.

    head: a pattern with groups for number and title.  In a block `Default:`, `Range:` and `Unit:`
    lines give their fields, the other lines the description; the kind follows from the fields.
    """
    w = Window.partitionBy(*ids).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("block", F.sum(F.when(F.col("line").rlike(head), 1).otherwise(0)).over(w)).filter("block > 0")
    field = lambda name: F.max(F.when(F.col("line").rlike(f"(?i)^{name}\\s*:"), F.trim(F.regexp_replace("line", f"(?i)^{name}\\s*:", ""))))
    plain = F.when(~F.col("line").rlike(head) & ~F.col("line").rlike("(?i)^(default|range|unit)\\s*:"), F.struct("pos", "line"))
    first = F.max(F.when(F.col("line").rlike(head), F.col("line")))
    rows = marked.groupBy(*ids, "block").agg(first.alias("head"), field("default").alias("default"), field("range").alias("range"), field("unit").alias("unit"), F.array_sort(F.collect_list(plain)).alias("rest"))
    span = S.parse_range(F.col("range"))
    kind = F.when(span["min"].isNotNull(), "number").when(F.contains("range", F.lit("=")), "choice").when(F.col("default").isNotNull(), "text").otherwise("note")
    return rows.select(*ids, F.regexp_extract("head", head, 1).alias("number"), F.regexp_extract("head", head, 2).alias("title"), kind.alias("kind"), "default", span["min"].alias("low"), span["max"].alias("high"), "unit", F.array_join(F.transform("rest", lambda r: r["line"]), " ").alias("description"))


def markdown_rows(lines: DataFrame, ids: Sequence[str]) -> DataFrame:
    """ids, tab, row, col, head and val: cells of Markdown tables; a line of dashes makes the line above it the header."""
    is_row = F.col("line").rlike(r"^\|.*\|$")
    is_rule = F.col("line").rlike(r"^\|[ |:-]*-[ |:-]*\|$")
    w = Window.partitionBy(*ids).orderBy("pos")
    table = lines.withColumn("is_row", is_row).withColumn("starts", is_row & ~F.coalesce(F.lag(is_row).over(w) & (F.lag("pos").over(w) == F.col("pos") - 1), F.lit(False)))
    table = table.withColumn("tab", F.sum(F.col("starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("is_row")
    inside = Window.partitionBy(*ids, "tab").orderBy("pos")
    rows = table.withColumn("n", F.row_number().over(inside)).withColumn("cells", F.transform(F.slice(F.split("line", r"\|"), 2, F.size(F.split("line", r"\|")) - 2), lambda c: F.trim(c)))
    rules = F.min(F.when(is_rule, F.col("n"))).over(Window.partitionBy(*ids, "tab"))
    rows = rows.withColumn("rule", rules).withColumn("head", F.max(F.when(F.col("n") == F.col("rule") - 1, F.col("cells"))).over(Window.partitionBy(*ids, "tab")))
    body = rows.filter(F.col("rule").isNull() | (F.col("n") > F.col("rule")))
    numbered = body.withColumn("row", (F.row_number().over(inside) - 1).cast("int"))
    cells = numbered.select(*ids, F.col("tab").cast("int").alias("tab"), "row", "head", F.posexplode("cells").alias("col", "val"))
    return cells.select(*ids, "tab", "row", "col", F.try_element_at("head", F.col("col") + 1).alias("head"), "val")
