"""Queries over texts and cells: scalar functions, sources, notes, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators.order import first_wins
from tessera.operators.publish import ratio_tally, with_children
from tessera.plans.registry import query
from tessera.sources.tables import load


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (SELECT doc_id, trim(regexp_replace(line, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS line FROM l)
SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, max(length(line))::BIGINT AS longest FROM c WHERE line <> '' GROUP BY doc_id""")
def clean_text_lines(spark: SparkSession, d: str) -> DataFrame:
    """White space canonicalised line by line."""
    lines = load(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    clean = lines.select("doc_id", S.clean_text(F.col("line")).alias("line")).filter("line <> ''")
    return clean.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.max(F.length("line")).cast("long").alias("longest"))


@query(r"""
SELECT role, count(*) AS n, count(*) FILTER (length(text) < 3) AS short, count(*) FILTER (regexp_matches(lower(trim(text)), '^(name|unit|note|ok|yes|no|thanks)[.!]?$')) AS header
FROM conversations GROUP BY role""")
def junk_row_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose whole text is a header word or too short."""
    c = load(spark, d, "conversations")
    junk = F.lower(F.trim("text")).rlike("^(name|unit|note|ok|yes|no|thanks)[.!]?$")
    return c.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("text") < 3).alias("short"), F.count_if(junk).alias("header"))


_OBJECTS = """
SELECT l_orderkey, l_linenumber, CASE l_partkey % 6
  WHEN 0 THEN 'AI-' || l_suppkey WHEN 1 THEN 'av: ' || l_suppkey WHEN 2 THEN 'MI[' || l_suppkey || ']'
  WHEN 3 THEN 'Analog Input, ' || l_suppkey WHEN 4 THEN 'multi-state value ' || l_suppkey ELSE 'see note ' || l_suppkey END AS raw
FROM lineitem"""


@query(f"""
WITH r AS ({_OBJECTS}),
p AS (SELECT *, CASE WHEN regexp_matches(raw, '^AI') THEN 'AI' WHEN regexp_matches(raw, '^av') THEN 'AV' WHEN regexp_matches(raw, '^MI') THEN 'MSI'
  WHEN regexp_matches(raw, '^Analog') THEN 'AI' WHEN regexp_matches(raw, '^multi') THEN 'MSV' END AS type,
  CASE WHEN NOT regexp_matches(raw, '^see') THEN CAST(regexp_extract(raw, '([0-9]+)', 1) AS INT) END AS inst FROM r)
SELECT type, count(*) AS n, min(inst) AS low, max(inst) AS high, count(DISTINCT inst) AS n_inst FROM p GROUP BY type""")
def object_ids(spark: SparkSession, d: str) -> DataFrame:
    """Object ids in five spellings parsed and tallied."""
    raw = spark.sql(_OBJECTS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=load(spark, d, "lineitem")).select(S.object_id(F.col("raw")).alias("x")).select("x.type", "x.inst")
    return raw.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.min("inst").alias("low"), F.max("inst").alias("high"), F.countDistinct("inst").alias("n_inst"))


@query(r"""
WITH r AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '3x' || lpad(CAST(p_size AS VARCHAR), 4, '0') WHEN 1 THEN 'D' || upper(lpad(to_hex(p_size), 3, '0'))
  WHEN 2 THEN CAST(p_partkey AS VARCHAR) ELSE 'n/a' END AS raw FROM part)
SELECT p_partkey, raw, CAST(CASE p_partkey % 4 WHEN 0 THEN 30000 + CAST(right(raw, 4) AS INT) WHEN 1 THEN CAST('0x' || right(raw, 3) AS INT)
  WHEN 2 THEN CASE WHEN length(raw) <= 6 THEN CAST(raw AS INT) END END AS BIGINT) AS address FROM r""")
def register_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Modbus references, hexadecimal registers and plain numbers as absolute addresses."""
    p = load(spark, d, "part")
    k = F.col("p_partkey") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit("3x"), F.lpad(F.col("p_size").cast("string"), 4, "0")))
        .when(k == 1, F.concat(F.lit("D"), F.lpad(F.hex("p_size"), 3, "0")))
        .when(k == 2, F.col("p_partkey").cast("string"))
        .otherwise("n/a")
    )
    return p.select("p_partkey", raw.alias("raw")).withColumn("address", S.register_address(F.col("raw")))


_UNITS = "'°C', 'percent', 'PSI', 'Hours', 'Pressure, Fluidic', '0 = Off 1 = On', 'none', 'L/s', 'furlong', 'KWH'"


@query(f"""
WITH u AS (SELECT p_partkey, [{_UNITS}][p_partkey % 10 + 1] AS unit, p_retailprice FROM part)
SELECT unit, CASE unit WHEN '°C' THEN 'degC' WHEN 'percent' THEN 'percent' WHEN 'PSI' THEN 'psi' WHEN 'Hours' THEN 'h' WHEN 'L/s' THEN 'Lps' WHEN 'KWH' THEN 'kWh' END AS canon,
  CASE WHEN unit = 'none' THEN 'unitless' WHEN unit LIKE '%=%' THEN 'states' WHEN unit = 'furlong' THEN 'unknown' WHEN unit LIKE 'Pressure%' THEN 'group' ELSE 'ok' END AS state,
  CASE unit WHEN '°C' THEN 'temperature' WHEN 'percent' THEN 'ratio' WHEN 'PSI' THEN 'pressure' WHEN 'Hours' THEN 'time' WHEN 'L/s' THEN 'airflow' WHEN 'KWH' THEN 'energy' END AS quantity,
  count(*) AS n FROM u GROUP BY unit""")
def canonical_units(spark: SparkSession, d: str) -> DataFrame:
    """Unit spellings with their code, state and physical quantity."""
    units = F.array(*(F.lit(x.strip().strip("'")) for x in _UNITS.replace("Pressure, Fluidic", "Pressure; Fluidic").split(",")))
    rows = load(spark, d, "part").select(F.replace(F.element_at(units, (F.col("p_partkey") % 10 + 1).cast("int")), F.lit(";"), F.lit(",")).alias("unit"))
    tally = rows.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    unit = F.col("unit")
    return tally.select("unit", S.canonical_unit(unit).alias("canon"), S.unit_state(unit).alias("state"), S.quantity(unit).alias("quantity"), "n")


@query(r"""
WITH r AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_suppkey || '~' || (s_suppkey + 10) WHEN 1 THEN '-' || s_suppkey || ' to ' || s_nationkey || '.5' WHEN 2 THEN s_suppkey || ' - ' || (s_suppkey * 2) ELSE '0 - DRV-' || s_suppkey END AS cell, s_nationkey FROM supplier)
SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 3 THEN cell END AS raw,
  CASE s_suppkey % 4 WHEN 0 THEN s_suppkey WHEN 1 THEN -s_suppkey WHEN 2 THEN s_suppkey END::DOUBLE AS min,
  CASE s_suppkey % 4 WHEN 0 THEN s_suppkey + 10 WHEN 1 THEN s_nationkey + 0.5 WHEN 2 THEN s_suppkey * 2 END::DOUBLE AS max FROM r""")
def value_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Ranges with plain numbers at both ends; a reference at one end is no range."""
    s, k, n = load(spark, d, "supplier"), F.col("s_suppkey"), F.col("s_nationkey")
    cell = (
        F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit("~"), (k + 10).cast("string")))
        .when(k % 4 == 1, F.concat(F.lit("-"), k.cast("string"), F.lit(" to "), n.cast("string"), F.lit(".5")))
        .when(k % 4 == 2, F.concat(k.cast("string"), F.lit(" - "), (k * 2).cast("string")))
        .otherwise(F.concat(F.lit("0 - DRV-"), k.cast("string")))
    )
    return s.select("s_suppkey", S.parse_range(cell).alias("x")).select("s_suppkey", "x.raw", "x.min", "x.max")


@query(r"""
WITH t AS (SELECT doc_id, source, list_transform(regexp_extract_all(regexp_replace(replace(text, ',', ''), '([0-9])\s*-\s*([0-9])', '\1 \2', 'g'), '-?[0-9]+(\.[0-9]+)?'), lambda x: TRY_CAST(x AS DOUBLE)) AS v FROM documents),
m AS (SELECT source, len(v) AS n, list_min(v) AS low, list_max(v) AS high FROM t)
SELECT source, CAST(sum(n) AS BIGINT) AS n_numbers, count(*) FILTER (n > 0) AS n_docs, min(low) AS low, max(high) AS high FROM m GROUP BY source""")
def range_summary(spark: SparkSession, d: str) -> DataFrame:
    """Numbers in texts with their span per source."""
    v = load(spark, d, "documents").select("source", S.numbers(F.col("text")).alias("v"))
    m = v.select("source", F.size("v").alias("n"), F.array_min("v").alias("low"), F.array_max("v").alias("high"))
    return m.groupBy("source").agg(F.sum("n").alias("n_numbers"), F.count_if(F.col("n") > 0).alias("n_docs"), F.min("low").alias("low"), F.max("high").alias("high"))


_STATES = "CASE p_size % 3 WHEN 0 THEN '0 = Off 1 = ' || p_type WHEN 1 THEN '1: ' || p_type ELSE p_name || ' 0=Auto, 1=' || p_type || ', 2=' || split_part(p_name, ' ', 1) END"


@query(rf"""
WITH s AS (SELECT p_partkey, {_STATES} AS note FROM part),
e AS (SELECT p_partkey, regexp_extract_all(note, '(-?[0-9]+)\s*[=:]\s*([A-Za-z][A-Za-z ]*)', 1) AS c, regexp_extract_all(note, '(-?[0-9]+)\s*[=:]\s*([A-Za-z][A-Za-z ]*)', 2) AS l FROM s)
SELECT p_partkey, i AS place, c[i] AS code, trim(l[i]) AS label FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM e WHERE len(c) >= 2)""")
def enum_states(spark: SparkSession, d: str) -> DataFrame:
    """Enumerations in notes as child rows; fewer than two entries are none."""
    notes = load(spark, d, "part").select("p_partkey", F.expr(_STATES).alias("note"))
    found = with_children(notes, ["p_partkey"], S.enum_states(F.col("note")), ["code", "label"])
    return found.withColumn("place", F.col("place").cast("long"))


_NOTE = "'range ' || p_size || ' · ' || p_type || ' · code ' || p_brand || ' · range ' || (p_size + 5) || CASE WHEN p_size % 2 = 0 THEN ' · writable' ELSE '' END"


@query(f"""
WITH n AS (SELECT p_partkey, string_split({_NOTE}, ' · ') AS p FROM part)
SELECT p_partkey, array_to_string(list_transform(list_filter(p, lambda x: starts_with(x, 'range ')), lambda x: trim(x[7:])), ' / ') AS range_raw,
  array_to_string(list_transform(list_filter(p, lambda x: starts_with(x, 'code ')), lambda x: trim(x[6:])), ' / ') AS code,
  array_to_string(list_filter(p, lambda x: NOT starts_with(x, 'range ') AND NOT starts_with(x, 'code ') AND NOT starts_with(x, 'writable')), ' · ') AS descr,
  list_contains(p, 'writable') AS writable FROM n""")
def note_decompose(spark: SparkSession, d: str) -> DataFrame:
    """Notes cut into tagged parts; a repeated tag is joined, the rest stays a description."""
    n = load(spark, d, "part").select("p_partkey", F.expr(_NOTE).alias("note"))
    note = F.col("note")
    return n.select(
        "p_partkey", S.note_parts(note, "range ").alias("range_raw"), S.note_parts(note, "code ").alias("code"),
        S.note_rest(note, ["range ", "code ", "writable"]).alias("descr"), F.array_contains(F.split(note, " · "), "writable").alias("writable"),
    )


@query(r"""
WITH n AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN '0=' || l_returnflag ELSE 'kW' END AS unit, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus || ' 0=' || l_returnflag ELSE '' END AS note FROM lineitem),
m AS (SELECT CASE WHEN unit NOT LIKE '%=%' THEN unit END AS unit, CASE WHEN unit NOT LIKE '%=%' THEN note WHEN note = '' THEN unit WHEN contains(note, unit) THEN note ELSE note || ' · ' || unit END AS note FROM n)
SELECT unit, note, count(*) AS n FROM m GROUP BY unit, note""")
def misplaced_states(spark: SparkSession, d: str) -> DataFrame:
    """State texts in the unit column go to the note, once."""
    k = F.col("l_linenumber")
    raw = load(spark, d, "lineitem").select(
        F.when(k % 3 == 0, F.concat(F.lit("0="), "l_returnflag")).otherwise("kW").alias("unit"), F.when(k % 2 == 0, F.concat("l_linestatus", F.lit(" 0="), "l_returnflag")).otherwise("").alias("note")
    )
    moved = raw.select(S.unit_or_note(F.col("unit"), F.col("note")).alias("x")).select("x.unit", "x.note")
    return moved.groupBy("unit", "note").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS with_k, min(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS low, max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS high FROM events GROUP BY event_type""")
def json_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of polymorphic JSON cells as text."""
    k = F.get_json_object("props", "$.k")
    return load(spark, d, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count(k).alias("with_k"), F.min(k.try_cast("long")).alias("low"), F.max(k.try_cast("long")).alias("high")
    )


@query(r"""
SELECT page_id, coalesce(CASE WHEN page_id % 7 = 0 THEN 'renamed-' || page_id END, replace(url_decode(list_last(string_split(regexp_replace(url, '[?#].*$', ''), '/'))), ' ', '_')) AS name FROM pages""")
def local_names(spark: SparkSession, d: str) -> DataFrame:
    """File names for URLs: renames first, else the decoded last part."""
    p = load(spark, d, "pages")
    renamed = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("renamed-"), F.col("page_id").cast("string")))
    return p.select("page_id", F.coalesce(renamed, S.local_name(F.col("url"), {})).alias("name"))


@query("SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents")
def file_hash(spark: SparkSession, d: str) -> DataFrame:
    """Content digest and size of every document (A03, EP-33)."""
    return load(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("long").alias("n_bytes"))


@query(r"""
WITH k AS (SELECT s_suppkey, lower(trim(regexp_replace(s_name || '-' || s_nationkey, '[^A-Za-z0-9_]+', '-', 'g'), '-')) AS model, s_suppkey % 3 AS kind, s_nationkey FROM supplier)
SELECT model, model || '|i' || s_nationkey || '|' || CASE kind WHEN 0 THEN 'AI-' || s_suppkey WHEN 1 THEN 'mb' || s_suppkey ELSE 'row' || s_suppkey END AS point_key FROM k""")
def point_keys(spark: SparkSession, d: str) -> DataFrame:
    """Model slugs and point keys with a three-way fallback of the identifier."""
    k = F.col("s_suppkey")
    s = load(spark, d, "supplier").withColumn("model", S.slug(F.col("s_name"), F.col("s_nationkey").cast("string")))
    bacnet, modbus = F.when(k % 3 == 0, F.concat(F.lit("AI-"), k.cast("string"))), F.when(k % 3 == 1, F.concat(F.lit("mb"), k.cast("string")))
    ident = F.coalesce(bacnet, modbus, F.concat(F.lit("row"), k.cast("string")))
    return s.select("model", F.concat_ws("|", "model", F.concat(F.lit("i"), F.col("s_nationkey").cast("string")), ident).alias("point_key"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'AI' END AS type, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey % 3 ELSE l_partkey % 5 END AS BIGINT) AS inst,
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'no object type' END AS gaps FROM lineitem""")
def nested_points(spark: SparkSession, d: str) -> DataFrame:
    """Flat rows routed into protocol blocks and flattened again; an instance of 0 is a value."""
    even = F.col("l_linenumber") % 2 == 0
    blocks = F.struct(
        F.when(even, F.struct(F.lit("AI").alias("objectType"), (F.col("l_suppkey") % 3).alias("instance"))).alias("bacnet"), F.when(~even, F.struct((F.col("l_partkey") % 5).alias("address"))).alias("modbus")
    )
    gaps = F.filter(F.array(F.when(~even, F.lit("no object type"))), lambda x: x.isNotNull())
    nested = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", blocks.alias("blocks"), gaps.alias("gaps"))
    return nested.select("l_orderkey", "l_linenumber", F.col("blocks.bacnet.objectType").alias("type"), F.coalesce("blocks.bacnet.instance", "blocks.modbus.address").alias("inst"), F.array_join("gaps", ",").alias("gaps"))


@query(r"""
WITH t AS (SELECT page_id, string_split(regexp_replace(html, '<[^>]*>', chr(10), 'g'), chr(10)) AS l FROM pages),
x AS (SELECT page_id, unnest(l) AS line FROM t), c AS (SELECT page_id, trim(regexp_replace(line, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS line FROM x)
SELECT page_id, count(*) AS n_lines, count(DISTINCT line) AS n_distinct, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM c WHERE line <> '' GROUP BY page_id""")
def page_text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Text lines of pages between tags."""
    lines = load(spark, d, "pages").select("page_id", F.explode(F.split(F.regexp_replace("html", "<[^>]*>", "\n"), "\n")).alias("line"))
    clean = lines.select("page_id", S.clean_text(F.col("line")).alias("line")).filter("line <> ''")
    return clean.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("line").alias("n_distinct"), F.sum(F.length("line")).alias("n_chars"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
m AS (SELECT *, contains(line, ' | ') AS is_row FROM l),
g AS (SELECT *, CAST(sum(CASE WHEN is_row THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS island FROM m)
SELECT doc_id, island AS island, count(*) AS n_rows, CAST(max(len(string_split(line, ' | '))) AS BIGINT) AS n_cells, CAST(min(pos) AS BIGINT) AS first_line FROM g WHERE is_row GROUP BY doc_id, island""")
def markdown_tables(spark: SparkSession, d: str) -> DataFrame:
    """Runs of lines with cell bars as tables."""
    from pyspark.sql import Window

    lines = load(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("is_row", F.contains("line", F.lit(" | ")))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    island = lines.withColumn("island", F.sum(F.when(F.col("is_row"), 0).otherwise(1)).over(w)).filter("is_row")
    return island.groupBy("doc_id", "island").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.size(F.split("line", r" \| "))).cast("long").alias("n_cells"), F.min("pos").cast("long").alias("first_line")
    )


@query("""
WITH s AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'gone' WHEN 'O' THEN 'alive' ELSE 'blocked' END AS state, o_custkey, o_orderkey, o_totalprice FROM orders),
a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM s WHERE state = 'alive' AND o_totalprice > 20000)
SELECT c.o_custkey, a.o_orderkey AS first_alive, c.n AS n_candidates, c.blocked AS n_blocked
FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (state = 'blocked') AS blocked FROM s GROUP BY o_custkey) c LEFT JOIN a ON a.o_custkey = c.o_custkey AND a.r = 1""")
def probe_first_alive(spark: SparkSession, d: str) -> DataFrame:
    """Per series the first candidate that is alive and large enough."""
    status = F.col("o_orderstatus")
    s = load(spark, d, "orders").withColumn("state", F.when(status == "F", "gone").when(status == "O", "alive").otherwise("blocked"))
    alive = first_wins(s.filter("state = 'alive' AND o_totalprice > 20000"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("first_alive"))
    counts = s.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("state") == "blocked").alias("n_blocked"))
    return counts.join(alive, "o_custkey", "left").select("o_custkey", "first_alive", "n_candidates", "n_blocked")


@query("""
WITH n AS (SELECT doc_id, sha256(text) AS h FROM documents), known AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE lang = 'en')
SELECT h AS sha256, min(doc_id) AS first_doc, count(*) AS n FROM n WHERE h NOT IN (SELECT h FROM known) GROUP BY h""")
def incremental_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Content not yet in the ledger, once per digest."""
    docs = load(spark, d, "documents").select("doc_id", "lang", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    known = docs.filter("lang = 'en'").select("sha256").distinct()
    return docs.join(known, "sha256", "left_anti").groupBy("sha256").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT lang, count(*) AS n, count(*) FILTER (n_chars < 200) AS short, round(100.0::DOUBLE * count(*) FILTER (n_chars < 200) / count(*), 1) AS short_pct, count(*) FILTER (text LIKE '%###%') AS marked, round(100.0::DOUBLE * count(*) FILTER (text LIKE '%###%') / count(*), 1) AS marked_pct
FROM documents GROUP BY lang""")
def field_survey(spark: SparkSession, d: str) -> DataFrame:
    """Counts and shares of defects per language."""
    return ratio_tally(load(spark, d, "documents"), ["lang"], {"short": F.col("n_chars") < 200, "marked": F.contains("text", F.lit("###"))})


@query(r"""
WITH v AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey || ' (' || s_nationkey || ')' ELSE CAST(s_nationkey AS VARCHAR) END AS raw, s_nationkey FROM supplier)
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey ELSE s_nationkey END::DOUBLE AS first, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END::DOUBLE AS second FROM v""")
def dual_values(spark: SparkSession, d: str) -> DataFrame:
    """`50 (10)` as two readings of one value."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    raw = F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(" ("), n, F.lit(")"))).otherwise(n)
    return load(spark, d, "supplier").select("s_suppkey", S.dual_value(raw).alias("x")).select("s_suppkey", "x.first", "x.second")
