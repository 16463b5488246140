"""Workbooks and linked notes as data sources."""

from __future__ import annotations

import json
import zipfile

import pytest

from tessera.sources import sheets

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def test_columns():
    for n, name in ((0, "A"), (25, "Z"), (26, "AA"), (701, "ZZ"), (702, "AAA"), (16383, "XFD")):
        assert sheets.column_name(n) == name and sheets.column_number(f"{name}7") == n


def foreign_workbook(path):
    """As another program writes one: shared texts in runs, gaps, booleans, formulas, absolute targets."""
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets><sheet name="One &amp; two" sheetId="1" r:id="r9"/><sheet name="Other" sheetId="2" r:id="r2"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{RELS}"><Relationship Id="r2" Target="worksheets/b.xml"/><Relationship Id="r9" Target="/xl/worksheets/a.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}"><si><t>plain</t></si><si><r><t>in </t></r><r><t>runs</t></r></si></sst>')
        book.writestr("xl/worksheets/a.xml", f'<worksheet xmlns="{MAIN}"><sheetData><row r="2"><c r="B2" t="s"><v>1</v></c><c r="AA2"><v>3.5</v></c></row><row r="5"><c r="A5" t="b"><v>1</v></c><c r="B5" t="str"><f>A1</f><v>sum</v></c><c r="C5"/></row></sheetData></worksheet>')
        book.writestr("xl/worksheets/b.xml", f'<worksheet xmlns="{MAIN}"><sheetData><row><c t="s"><v>0</v></c><c t="inlineStr"><is><t>inline</t></is></c></row></sheetData></worksheet>')


def test_workbooks_of_other_programs(spark, tmp_path, monkeypatch):
    sheets.register(spark)
    (tmp_path / "deep").mkdir()
    foreign_workbook(tmp_path / "deep" / "x.xlsx")
    (tmp_path / "_manifest.json").write_text("{}")
    cells = [("One & two", 1, 1, "in runs"), ("One & two", 1, 26, "3.5"), ("One & two", 4, 0, "true"), ("One & two", 4, 1, "sum"), ("Other", 0, 0, "plain"), ("Other", 0, 1, "inline")]
    found = spark.read.format("sheet_cells").load(str(tmp_path)).select("sheet", "row", "col", "value").collect()
    assert sorted(map(tuple, found)) == cells
    one = spark.read.format("sheet_cells").option("sheet", "Other").load(str(tmp_path / "deep" / "x.xlsx"))
    assert sorted((r.row, r.col, r.value) for r in one.collect()) == [(0, 0, "plain"), (0, 1, "inline")]
    # Large workbooks are split by their sheets, small ones share a partition.
    assert len(sheets.SheetReader(str(tmp_path), None).partitions()) == 1
    monkeypatch.setattr(sheets, "PARTITION_BYTES", 10)
    assert [p.sheet for p in sheets.SheetReader(str(tmp_path), None).partitions()] == [0, 1]


def test_what_is_written_is_read(spark, tmp_path):
    sheets.register(spark)
    folder = str(tmp_path / "out")
    rows = [(k, f"a <&> \"{k}\" é\n\x01 ", k % 2 == 0, k / 4, None) for k in range(25)]
    spark.createDataFrame(rows, "k int, t string, b boolean, x double, none string").repartition(3).write.format("sheet_cells").option("sheet", "s").option("rows", "5").mode("append").save(folder)
    cells = spark.read.format("sheet_cells").load(folder).collect()
    head = {(r.col, r.value) for r in cells if r.row == 0}
    assert head == {(0, "k"), (1, "t"), (2, "b"), (3, "x"), (4, "none")} and max(r.row for r in cells) == 4
    lines: dict = {}
    for r in cells:
        if r.row:
            lines.setdefault((r.path, r.sheet, r.row), {})[r.col] = r.value
    assert sorted((int(x[0]), x[1], x[2], float(x[3]), x.get(4)) for x in lines.values()) == [(k, t.replace("\x01", "�"), str(b).lower(), x, None) for k, t, b, x, _ in rows]
    files = json.loads((tmp_path / "out" / "_manifest.json").read_text())["files"]
    assert sum(f["rows"] for f in files) == 25 and sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(["_manifest.json", *(f["name"] for f in files)])
    spark.createDataFrame([], "k int").write.format("sheet_cells").mode("append").save(str(tmp_path / "none"))
    assert spark.read.format("sheet_cells").load(str(tmp_path / "none")).count() == 0


def test_rows_beyond_a_full_sheet_are_read_by_its_name(spark, tmp_path):
    sheets.register(spark)
    title, folder = "a title of just 31 letters here", str(tmp_path / "full")
    spark.range(0, 10, 1, 1).write.format("sheet_cells").option("sheet", title).option("rows", "4").mode("append").save(folder)
    cells = spark.read.format("sheet_cells").option("sheet", title).load(folder).filter("row > 0").collect()
    assert sorted(int(r.value) for r in cells) == list(range(10)) and {r.sheet for r in cells} == {title}


def test_a_failed_task_leaves_no_output(spark, tmp_path):
    from pyspark.sql import functions as F

    sheets.register(spark)
    df = spark.range(0, 20, 1, 2).select(F.when(F.col("id") == 19, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("k"))
    with pytest.raises(Exception):  # noqa: B017
        df.write.format("sheet_cells").mode("append").save(str(tmp_path / "bad"))
    assert not [p for p in (tmp_path / "bad").glob("*.xlsx")] and not (tmp_path / "bad" / "_manifest.json").exists()


def test_linked_notes(spark, tmp_path):
    sheets.register(spark)
    rows = [("a/b: c", "kind", "text", ["x", None, "y?"]), ("x", None, None, None)]
    spark.createDataFrame(rows, "node string, kind string, text string, links array<string>").repartition(1).write.format("linked_notes").mode("append").save(str(tmp_path / "v"))
    notes = {p.name: p.read_text() for p in (tmp_path / "v").glob("notes-*/*.md")}
    assert notes == {"a-b- c.md": "---\nkind: kind\n---\n# a/b: c\n\ntext\n\n- [[x]]\n- [[y-]]\n", "x.md": "---\nkind: \n---\n# x\n\n\n\n"}
    with pytest.raises(Exception, match="linked notes need"):
        spark.range(2).write.format("linked_notes").mode("append").save(str(tmp_path / "w"))
