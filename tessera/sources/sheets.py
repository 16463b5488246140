"""Data sources for workbooks and linked notes: spark.read/write with format("sheet_cells") and write with format("linked_notes").

Register them once a session with register(spark).  Files are reached through Arrow's file
systems, so any store with a URL works.  A writer's task writes under a temporary name and the
driver's commit renames what succeeded and writes a manifest; a file that the manifest doesn't
name is none of the output.
"""

from __future__ import annotations

import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes of workbooks that one partition reads; a larger workbook is split by its sheets.
PARTITION_BYTES = 8 << 20
#: Names of the parts of a workbook, and the rows that a sheet can hold.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
SHEET_ROWS = 1_048_576
MANIFEST = "_manifest.json"
NOT_IN_XML = re.compile("[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")


def store_of(url: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(url if "://" in url or url.startswith("file:") else f"file://{url}")


# ---------------------------------------------------------------- workbooks


def column_number(reference: str) -> int:
    """0 for A1, 27 for AB3."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def column_name(n: int) -> str:
    name = ""
    while n >= 0:
        name, n = chr(65 + n % 26) + name, n // 26 - 1
    return name


def sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part of the archive) of a workbook's sheets, in order."""
    targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
    return [(s.get("name", ""), t.lstrip("/") if (t := targets[s.get(LINK)]).startswith("/") else f"xl/{t}") for s in sheets]


def shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return ["".join(t.text or "" for t in item.iter(f"{MAIN}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]


def sheet_cells(book: zipfile.ZipFile, part: str, texts: list[str]) -> Iterator[tuple[int, int, str]]:
    """(row, column, text) of a sheet's cells that hold something, from 0; read as a stream."""
    row = col = -1
    rows = None
    with book.open(part) as f:
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            if event == "start" and e.tag == f"{MAIN}sheetData":
                rows = e
            elif event == "start" and e.tag == f"{MAIN}row":
                row, col = int(e.get("r") or row + 2) - 1, -1
            elif event == "end" and e.tag == f"{MAIN}c":
                col = column_number(e.get("r", "")) if e.get("r") else col + 1
                kind, value = e.get("t"), e.findtext(f"{MAIN}v")
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in e.iter(f"{MAIN}t"))
                elif kind == "s" and value is not None:
                    value = texts[int(value)]
                elif kind == "b" and value is not None:
                    value = "true" if value.strip() == "1" else "false"
                if value:
                    yield row, col, value
            elif event == "end" and e.tag == f"{MAIN}row" and rows is not None:
                rows.clear()


@dataclass
class Books(InputPartition):
    """Workbooks of one partition; sheet: only that one (its place), or all."""

    paths: list[str]
    sheet: int | None = None


class SheetReader(DataSourceReader):
    def __init__(self, path: str, sheet: str | None):
        self.path, self.only = path, sheet

    def partitions(self) -> list[InputPartition]:
        store, root = store_of(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted((x for x in found if x.type == fs.FileType.File and x.path.endswith(".xlsx") and not x.base_name.startswith((".", "_", "~"))), key=lambda x: x.path)
        planned: list[InputPartition] = []
        paths: list[str] = []
        size = 0
        for x in files:
            if x.size > PARTITION_BYTES:
                with store.open_input_file(x.path) as f, zipfile.ZipFile(f) as book:
                    planned += [Books([x.path], k) for k in range(len(sheet_parts(book)))]
                continue
            if paths and size + x.size > PARTITION_BYTES:
                planned.append(Books(paths))
                paths, size = [], 0
            paths.append(x.path)
            size += x.size
        return [*planned, *([Books(paths)] if paths else [])] or [Books([])]

    def read(self, partition: Books) -> Iterator[tuple]:
        store, _ = store_of(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as f, zipfile.ZipFile(f) as book:
                texts = None
                for k, (name, part) in enumerate(sheet_parts(book)):
                    if (partition.sheet is not None and k != partition.sheet) or (self.only is not None and name != self.only):
                        continue
                    texts = shared_texts(book) if texts is None else texts
                    for row, col, value in sheet_cells(book, part, texts):
                        yield path, name, row, col, value


@dataclass
class Written(WriterCommitMessage):
    """(temporary name, name, rows) of what a task wrote."""

    files: list[tuple[str, str, int]]


class CommittedWriter(DataSourceWriter):
    """Renames what tasks wrote under temporary names and writes the manifest."""

    suffix = ""

    def __init__(self, path: str, schema: StructType, options: dict[str, str]):
        self.path, self.columns, self.options, self.run = path, schema.names, options, uuid.uuid4().hex

    def _target(self) -> tuple[fs.FileSystem, str, int]:
        from pyspark import TaskContext

        store, root = store_of(self.path)
        store.create_dir(root, recursive=True)
        return store, root, TaskContext.get().partitionId()

    def commit(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.path)
        store.create_dir(root, recursive=True)
        done = [x for m in messages if m is not None for x in m.files]
        for temporary, name, _ in done:
            store.move(f"{root}/{temporary}", f"{root}/{name}")
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps({"files": [{"name": name, "rows": rows} for _, name, rows in done]}, sort_keys=True).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.path)
        for m in messages:
            for temporary, _, _ in m.files if m is not None else []:
                store.delete_file(f"{root}/{temporary}")


class SheetWriter(CommittedWriter):
    """Workbooks of one sheet per task: a header row and the task's rows, a further workbook where the sheet is full."""

    def write(self, iterator: Iterator[Any]) -> Written:
        store, root, part = self._target()
        task, most = uuid.uuid4().hex, int(self.options.get("rows", SHEET_ROWS))
        if most < 2:
            raise ValueError("a sheet needs room for its header and a row")
        files, pending = [], next(iterator, None)
        while pending is not None:
            more = f"-{len(files)}" if files else ""
            temporary, k = f".part-{part:05d}{more}.{self.run}.{task}.tmp", 1
            with store.open_output_stream(f"{root}/{temporary}", compression=None) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
                with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
                    f.write(b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                    f.write(_row(1, self.columns))
                    while pending is not None and k < most:
                        k += 1
                        f.write(_row(k, pending))
                        pending = next(iterator, None)
                    f.write(b"</sheetData></worksheet>")
                for path, content in _package([self.options.get("sheet", "Sheet")]):
                    book.writestr(path, content)
            files.append((temporary, f"part-{part:05d}{more}.xlsx", k - 1))
        return Written(files)


def _row(number: int, values: Any) -> bytes:
    cells = []
    for k, v in enumerate(values):
        at = f'r="{column_name(k)}{number}"'
        if isinstance(v, bool):
            cells.append(f'<c {at} t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)) and v == v and abs(v) != float("inf"):
            cells.append(f"<c {at}><v>{v!r}</v></c>")
        elif v is not None:
            # Characters that XML can't hold become the replacement character.
            text = escape(NOT_IN_XML.sub("\ufffd", str(v)))
            cells.append(f'<c {at} t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>')
    return f'<row r="{number}">{"".join(cells)}</row>'.encode()


def _package(names: list[str]) -> list[tuple[str, str]]:
    """The parts of a workbook that name its sheets."""
    main, links, kinds = (f"http://schemas.openxmlformats.org/{x}" for x in ("spreadsheetml/2006/main", "officeDocument/2006/relationships", "package/2006"))
    book = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    every = range(1, len(names) + 1)
    quoted = [escape(n[:31], {'"': "&quot;"}) for n in names]
    return [
        ("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>' + "".join(f'<sheet name="{q}" sheetId="{k}" r:id="rId{k}"/>' for k, q in zip(every, quoted, strict=True)) + "</sheets></workbook>"),
        ("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{kinds}/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{links}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in every) + "</Relationships>"),
        ("_rels/.rels", f'<Relationships xmlns="{kinds}/relationships"><Relationship Id="rId1" Type="{links}/officeDocument" Target="xl/workbook.xml"/></Relationships>'),
        ("[Content_Types].xml", f'<Types xmlns="{kinds}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{book}.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{book}.worksheet+xml"/>' for k in every) + "</Types>"),
    ]


class SheetCells(DataSource):
    """Workbooks as long cells (path, sheet, row, col, value); written rows become workbooks of one sheet with their own columns.

    Option of the reader: `sheet`, the only one to be read.  Options of the writer: `sheet` (a sheet's
    name), `rows` (of a sheet at most, its header included).
    """

    @classmethod
    def name(cls) -> str:
        return "sheet_cells"

    def schema(self) -> str:
        return "path string, sheet string, row int, col int, value string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return SheetReader(self.options["path"], self.options.get("sheet"))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SheetWriter(self.options["path"], schema, dict(self.options))


# ---------------------------------------------------------------- linked notes


def note_name(node: str) -> str:
    """A file name for a node: characters that stores don't take are hyphens."""
    return re.sub(r'[\\/:*?"<>|#^\[\]\x00-\x1f]', "-", node).strip(" .") or "-"


class NoteWriter(CommittedWriter):
    """A file per task with a note per node, one after the other, or a folder of notes: kind, text and links to other notes."""

    def write(self, iterator: Iterator[Any]) -> Written:
        store, root, part = self._target()
        folder, temporary = f"notes-{part:05d}", f".notes-{part:05d}.{self.run}.{uuid.uuid4().hex}.tmp"
        at, n = {c: k for k, c in enumerate(self.columns)}, 0
        for row in iterator:
            if not n:
                store.create_dir(f"{root}/{temporary}", recursive=True)
            node, links = str(row[at["node"]]), row[at["links"]] or []
            lines = ["---", f"kind: {row[at['kind']] or ''}", "---", f"# {node}", "", row[at["text"]] or "", ""]
            lines += [f"- [[{note_name(x)}]]" for x in links if x is not None]
            with store.open_output_stream(f"{root}/{temporary}/{note_name(node)}.md", compression=None) as f:
                f.write(("\n".join(lines) + "\n").encode())
            n += 1
        return Written([(temporary, folder, n)] if n else [])

    def abort(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.path)
        for m in messages:
            for temporary, _, _ in m.files if m is not None else []:
                store.delete_dir(f"{root}/{temporary}")


class LinkedNotes(DataSource):
    """Rows (node, kind, text, links) as linked notes: a folder per task, a file per node, links by the names of files."""

    @classmethod
    def name(cls) -> str:
        return "linked_notes"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if missing := {"node", "kind", "text", "links"} - set(schema.names):
            raise ValueError(f"linked notes need the columns {', '.join(sorted(missing))}")
        return NoteWriter(self.options["path"], schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SheetCells)
    spark.dataSource.register(LinkedNotes)
