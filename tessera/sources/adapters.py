"""Input adapters: files in awkward encodings, four-file object lists, JSON documents, content digests.

Everything after the bytes is DataFrame work.  Formats whose decoders are not part of
Spark (PDF, XLSX) plug in as `cells_from`: a function from bytes to cell rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CELLS = "path string, page int, tab int, row int, col int, val string"
BOM = "EFBBBF"


def content_ledger(spark: SparkSession, path: str) -> DataFrame:
    """path, n_bytes, modified and sha256 of every file under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def new_files(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files whose digest the ledger does not hold, the first path of each digest."""
    place = F.row_number().over(Window.partitionBy("sha256").orderBy("path"))
    return found.join(ledger.select("sha256").distinct(), "sha256", "left_anti").withColumn("__p", place).filter("__p = 1").drop("__p")


def decoded(content: Column, fallback: str = "windows-949") -> tuple[Column, Column]:
    """(text, encoding) of file bytes: BOM, then ASCII, then valid UTF-8, else the fallback.

    The fallback charsets need spark.sql.legacy.javaCharsets, see `read_text`.
    """
    marked = F.startswith(F.hex(F.substring(content, 1, 3)), F.lit(BOM))
    text = F.decode(content, "UTF-8")
    plain = F.is_valid_utf8(content.cast("string"))
    ascii_only = plain & (F.length(text) == F.octet_length(content)) & ~text.rlike(r"[^\x00-\x7F]")
    encoding = F.when(marked, "utf-8-sig").when(ascii_only, "ascii").when(plain, "utf-8").otherwise(fallback)
    body = F.when(marked, F.decode(F.substring(content, 4, 2147483647), "UTF-8")).when(plain, text).otherwise(F.decode(content, f"x-{fallback}" if fallback == "windows-949" else fallback))
    return body, encoding


def read_text(spark: SparkSession, path: str, fallback: str = "windows-949") -> DataFrame:
    """path, encoding, pos and line of every line of files whose encodings differ."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    text, encoding = decoded(F.col("content"), fallback)
    lines = files.select("path", encoding.alias("encoding"), F.posexplode(F.split(text, "\r\n|\n|\r")).alias("pos", "line"))
    return lines.filter("line <> ''")


def csv_rows(text: Column, separator: Column | str = ",") -> Column:
    """The rows of separated text as arrays of cells, any number of each; quoted cells may hold separators, quotes and line breaks.

    Rows without any character are left out; blanks around a cell go.
    """
    sep = F.lit(separator) if isinstance(separator, str) else separator
    quoted = '"(?:[^"]++|"")*+"'
    cell = F.concat(F.lit(rf"(?:[ \t]*+{quoted}[ \t]*+(?=["), sep, F.lit(r"\r\n]|\z)|[^"), sep, F.lit(r"\r\n]*+)"))
    record = F.concat(cell, F.lit("(?:["), sep, F.lit("]"), cell, F.lit(")*+"))
    records = F.filter(F.regexp_extract_all(text, record, F.lit(0)), lambda r: r != "")
    # A separator before the first cell makes every cell follow one.
    cells = lambda r: F.regexp_extract_all(F.concat(sep, r), F.concat(F.lit("["), sep, F.lit("]("), cell, F.lit(")")), F.lit(1))

    def bare(c: Column) -> Column:
        c = F.trim(c)
        inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.when((F.length(c) > 1) & F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')), inner).otherwise(c)

    return F.transform(records, lambda r: F.transform(cells(r), bare))


def separator_of(text: Column, lines: int = 12) -> Column:
    """`;` where the first lines hold more of it than of `,`, else `,`."""
    head = F.array_join(F.slice(F.split(text, "\r\n|\n|\r"), 1, lines), "\n")
    count = lambda mark: F.length(head) - F.length(F.replace(head, F.lit(mark), F.lit("")))
    return F.when(count(";") > count(","), ";").otherwise(",")


def _texts(spark: SparkSession, path: str, fallback: str) -> DataFrame:
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    text, encoding = decoded(F.col("content"), fallback)
    return spark.read.format("binaryFile").load(path).select("path", encoding.alias("encoding"), text.alias("text"))


def read_csv(spark: SparkSession, path: str, columns: str, fallback: str = "windows-949", separator: str = ",") -> DataFrame:
    """path, encoding, row and the declared columns of headed CSV files, each decoded by its own encoding.

    Rows are matched to the declared columns by the file's own header, so files with
    different column orders or missing columns come out alike, whatever their width.
    """
    names = [c.split()[0] for c in columns.split(",") if c.strip()]
    rows = _texts(spark, path, fallback).select("path", "encoding", csv_rows(F.col("text"), separator).alias("rows"))
    body = rows.select("path", "encoding", F.col("rows")[0].alias("head"), F.posexplode("rows").alias("row", "cells")).filter("row > 0")
    at = lambda n: F.try_element_at("cells", F.nullif(F.array_position("head", n), F.lit(0)).cast("int"))
    return body.select("path", "encoding", "row", *(at(n).alias(n) for n in names))


# Numbers of standard object types.
TYPE_NUMBERS = {0: "AI", 1: "AO", 2: "AV", 3: "BI", 4: "BO", 5: "BV", 8: "Dev", 13: "MSI", 14: "MSO", 19: "MSV"}
#: Columns of an object list and a part of the header cell that names each.
OBJECT_COLUMNS = {
    "keyname": "keyname", "name": "object-name", "type": "object-type", "inst": "object-instance", "descr": "description", "low": "min-present-value",
    "high": "max-present-value", "settable": "settable", "unit_code": "unit", "state_ref": "state-text",
}


def read_object_list(spark: SparkSession, folder: str, stem: str, fallback: str = "windows-1252") -> tuple[DataFrame, DataFrame]:
    """(device rows, object rows) of a four-file object list: body, state texts, units and object types.

    Each file is decoded and cut by its own encoding and separator.  The body's columns are
    found by their header cells, so their order and number don't matter; rows without a
    numeric type and instance are no objects.  Codes that a dictionary lacks leave a null, a
    state has as many texts as its row.  Objects are ordered by type and instance.
    """

    def cells(name: str) -> DataFrame:
        texts = _texts(spark, f"{folder}/{name}.csv", fallback)
        return texts.select(F.posexplode(csv_rows(F.col("text"), separator_of(F.col("text")))).alias("row", "cells"))

    number = lambda c: c.try_cast("double").try_cast("int")
    rows = cells(stem)
    heads = rows.filter(F.startswith(F.trim(F.col("cells")[0]), F.lit("#")) & F.contains(F.lower(F.array_join("cells", " ")), F.lit("keyname")))
    head = heads.agg(F.min_by(F.struct(F.transform("cells", lambda c: F.trim(F.replace(F.lower(c), F.lit("#"), F.lit("")))).alias("names"), "row"), "row").alias("head")).select("head.names", F.col("head.row").alias("head_row"))
    body = rows.crossJoin(F.broadcast(head)).filter((F.col("row") > F.col("head_row")) & ~F.startswith(F.col("cells")[0], F.lit("#")))  # one head row
    place = lambda part: F.array_position(F.transform("names", lambda n: F.contains(n, F.lit(part))), True)
    at = lambda part: F.nullif(F.try_element_at("cells", F.nullif(place(part), F.lit(0)).cast("int")), F.lit(""))
    body = body.select(*(at(part).alias(c) for c, part in OBJECT_COLUMNS.items()))
    body = body.withColumns({c: number(F.col(c)) for c in ("type", "inst", "unit_code", "state_ref")} | {c: F.col(c).try_cast("double") for c in ("low", "high")})
    body = body.filter("type is not null and inst is not null")
    coded = lambda name, key: cells(name).select(number(F.col("cells")[0]).alias(key), "row", F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))).alias("rest")).filter(F.col(key).isNotNull())
    units = coded(f"{stem}-Units", "unit_code").groupBy("unit_code").agg(F.max_by(F.col("rest")[0], "row").alias("unit"))
    texts = coded(f"{stem}-StateTexts", "state_ref").groupBy("state_ref").agg(F.max_by(F.filter("rest", lambda x: x != ""), "row").alias("states"))
    kinds = F.create_map(*(F.lit(x) for kv in TYPE_NUMBERS.items() for x in kv))
    joined = body.join(units, "unit_code", "left").join(texts, "state_ref", "left")
    joined = joined.withColumn("kind", F.coalesce(F.try_element_at(kinds, F.col("type")), F.concat(F.lit("T"), F.col("type").cast("string"))))
    return joined.filter("type = 8"), joined.filter("type <> 8").orderBy("kind", "inst")


def read_documents(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """One row per JSON document file, the last written of each key."""
    docs = spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("__at", F.col("_metadata.file_modification_time")).withColumn("__path", F.col("_metadata.file_path"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("__at"), F.desc("__path")))
    return docs.withColumn("__p", place).filter("__p = 1").drop("__p", "__at", "__path")


def cells_from(spark: SparkSession, path: str, decode: Callable[[bytes], Iterator[tuple[int, int, int, int, str]]]) -> DataFrame:
    """Long-form cells (path, page, tab, row, col, val) of binary documents, by a decoder of one file's bytes."""

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(p, *cell) for p, c in zip(frame["path"], frame["content"], strict=True) for cell in decode(bytes(c))]
            yield pd.DataFrame(rows, columns=["path", "page", "tab", "row", "col", "val"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(cells, CELLS)


def transposed(cells: DataFrame, labels: list[str]) -> DataFrame:
    """Tables in which one column is one record: (path, page, tab, col) with a column per row label of column 0."""
    names = cells.filter("col = 0").select("path", "page", "tab", "row", F.col("val").alias("label"))
    body = cells.filter("col > 0").join(names, ["path", "page", "tab", "row"])
    return body.groupBy("path", "page", "tab", "col").pivot("label", labels).agg(F.first("val"))
