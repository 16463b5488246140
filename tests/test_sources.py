"""Adapters and streams over small files."""

import json

from pyspark.sql import functions as F

from tessera.sources import adapters
from tessera.streaming.windows import ingest_new


def test_encodings_are_told_apart_file_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfname,unit\n\xc3\xa9t\xc3\xa9,\xe2\x84\x83\n")
    (tmp_path / "b.csv").write_bytes("unit,name\n℃,급기\n".encode("cp949"))
    (tmp_path / "c.csv").write_bytes(b"name,unit,more\n\"a, b\",kW,1\n")
    found = adapters.read_csv(spark, str(tmp_path), "name string, unit string").collect()
    assert {(r.encoding, r.name, r.unit) for r in found} == {("utf-8-sig", "été", "℃"), ("windows-949", "급기", "℃"), ("ascii", "a, b", "kW")}


def test_cells_of_any_number_with_quotes_and_line_breaks(spark, tmp_path):
    wide = ",".join(f"h{k}" for k in range(200)) + "\r\n" + ",".join(str(k) for k in range(200)) + "\r\n"
    (tmp_path / "w.csv").write_text(wide + '"two\nlines","say ""hi""",5" pipe, "x" ,,\n')
    rows = adapters.read_csv(spark, str(tmp_path), "h0 string, h1 string, h2 string, h3 string, h4 string, h199 string, none string").orderBy("row").collect()
    assert [tuple(r)[3:] for r in rows] == [("0", "1", "2", "3", "4", "199", None), ("two\nlines", 'say "hi"', '5" pipe', "x", "", None, None)]


def test_object_list_by_header_cells(spark, tmp_path):
    names = "#keyname,object-name,device obj.-instance,object-instance,object-type,description,unit-code,state-text-reference,settable"
    rows = ['k1,"Température; air",1,7,0,d,62,,N', "k2,Mode,1,3,19,,,4,Y", "k3,Odd,1,1,77,,,,", "#k4,gone,1,1,0,,,,", "k5,no number,1,x,0,,,,", "k0,Device,1,1,8,,,,"]
    (tmp_path / "y.csv").write_bytes("\n".join(["PROJECT_NAME,x", names, *rows]).encode("cp1252"))
    (tmp_path / "y-Units.csv").write_text("#code;text\n62;degC\n")
    (tmp_path / "y-StateTexts.csv").write_text("4;" + ";".join(f"s{k}" for k in range(12)) + "\n")
    device, objects = adapters.read_object_list(spark, str(tmp_path), "y")
    assert [r.name for r in device.collect()] == ["Device"]
    found = [(r.kind, r.inst, r["name"], r.unit, len(r.states or [])) for r in objects.collect()]
    assert found == [("AI", 7, "Température; air", "degC", 0), ("MSV", 3, "Mode", None, 12), ("T77", 1, "Odd", None, 0)]


def test_separator_ties_give_the_comma(spark):
    rows = spark.createDataFrame([("a;b;c,d",), ("a;b,c",), ("",)], "t string").select(adapters.separator_of(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == [";", ",", ","]


def test_object_list(spark, tmp_path):
    (tmp_path / "x.csv").write_text("# comment\n#keyname;device obj.-instance;object-name;object-type;object-instance;description;min-present-value;max-present-value;settable;unit-code;state-text-reference\nd;1;Device;8;1\nk1;1;Temp;0;7;d;0;50;N;62;\nk2;1;Mode;19;3;d;;;Y;;4\nk3;1;Other;0;2;d;;;Y;99;\n")
    (tmp_path / "x-Units.csv").write_text("62;degC\n")
    (tmp_path / "x-StateTexts.csv").write_text("4;off;on\n")
    device, objects = adapters.read_object_list(spark, str(tmp_path), "x")
    assert [r.name for r in device.collect()] == ["Device"]
    assert [(r.kind, r.inst, r.unit, r.states) for r in objects.collect()] == [("AI", 2, None, None), ("AI", 7, "degC", None), ("MSV", 3, None, ["off", "on"])]


def test_ledger_and_documents(spark, tmp_path):
    for k, body in enumerate(["a", "b", "a"]):
        (tmp_path / f"{k}.json").write_text(json.dumps({"id": body, "n": k}))
    ledger = adapters.content_ledger(spark, str(tmp_path))
    assert ledger.count() == 3 and adapters.new_files(ledger, ledger.filter("path like '%1.json'")).count() == 2
    docs = adapters.read_documents(spark, str(tmp_path), "id string, n int", "id").collect()
    assert sorted(r.id for r in docs) == ["a", "b"]


def test_cells_and_transposed_tables(spark, tmp_path):
    (tmp_path / "t.bin").write_bytes(b"name|a|b\nunit|kW|V")

    def decode(content):
        for r, line in enumerate(content.decode().split("\n")):
            for c, v in enumerate(line.split("|")):
                yield 1, 0, r, c, v

    found = adapters.transposed(adapters.cells_from(spark, str(tmp_path), decode), ["name", "unit"]).collect()
    assert {(r["name"], r.unit) for r in found} == {("a", "kW"), ("b", "V")}


def test_ingest_adds_each_key_once(spark, tmp_path):
    source, ledger, state = (str(tmp_path / x) for x in ("in", "ledger", "state"))
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    first.write.parquet(source)
    assert ingest_new(spark, source, "k int, v string", "k", ledger, state) == 2
    spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string").write.mode("append").parquet(source)
    assert ingest_new(spark, source, "k int, v string", "k", ledger, state) == 1
    assert sorted(r.k for r in spark.read.parquet(ledger).collect()) == [1, 2, 3]
