"""Queries over candidate files, text lines, requirements, unit records and release plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import lines, match, order, reconcile
from tessera.plans.registry import query
from tessera.sources import candidates
from tessera.sources.tables import load

_REVS, _DATES = ("a", "b"), ("2024", "2023")


@query("""
WITH s AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'list' WHEN 1 THEN 'series' ELSE 'page' END AS kind FROM supplier),
c AS (
  SELECT s_suppkey AS source, 'http://l/' || s_suppkey || '/' || k AS series, 0 AS ord, 'http://l/' || s_suppkey || '/' || k AS url FROM s, (VALUES (1), (2)) v(k) WHERE kind = 'list'
  UNION ALL SELECT s_suppkey, 'http://s/' || s_suppkey || '/' || k, o, 'http://s/' || s_suppkey || '/' || k || '-' || r || '-' || y || '.pdf' FROM s, (VALUES (7), (8), (9)) v(k), (VALUES (0, 'a', '2024'), (1, 'a', '2023'), (2, 'b', '2024'), (3, 'b', '2023')) m(o, r, y) WHERE kind = 'series'),
a AS (SELECT *, CASE WHEN length(url) % 5 = 0 THEN 403 WHEN (source + ord) % 3 = 0 THEN 200 ELSE 404 END AS status, 900 * (1 + source % 40) AS n_bytes FROM c),
g AS (SELECT source, series, min(CASE WHEN status = 200 AND n_bytes > 1000 THEN ord END) AS first, bool_or(status = 403) AS blocked FROM a GROUP BY source, series)
SELECT g.source, g.series, a.url, CASE WHEN a.url IS NOT NULL THEN 'alive' WHEN blocked THEN 'blocked' ELSE 'missing' END AS state FROM g LEFT JOIN a ON a.source = g.source AND a.series = g.series AND a.ord = g.first""")
def enumerated_sources(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of lists and series, and the first of each series that answers."""
    key = F.col("s_suppkey")
    kind = F.when(key % 3 == 0, "list").when(key % 3 == 1, "series").otherwise("page")
    urls = F.array(*(F.concat(F.lit("http://l/"), key.cast("string"), F.lit(f"/{k}")) for k in (1, 2)))
    registry = load(spark, d, "supplier").select(key.alias("source"), kind.alias("kind"), urls.alias("urls"), F.concat(F.lit("http://s/"), key.cast("string"), F.lit("/")).alias("base"), F.array(*map(F.lit, (7, 8, 9))).alias("numbers"))
    found = candidates.enumerate_sources(registry, _REVS, _DATES)
    status = F.when(F.length("url") % 5 == 0, 403).when((F.col("source") + F.col("ord")) % 3 == 0, 200).otherwise(404)
    answers = found.select("url", status.alias("status"), (900 * (1 + F.col("source") % 40)).alias("n_bytes"))
    return candidates.first_alive(found, answers, 1000)


_READERS = [("mail", r"^.*?([A-Za-z0-9._]+)@([A-Za-z0-9.-]+).*$", 1, 2), ("number first", "^([0-9]+) +(.+)$", 1, 2), ("heading", r"^(#+) *(.+)$", 1, 2), ("mark", r"^(-+)$", 1, 0)]


@query(r"""
WITH l AS (SELECT doc_id, CAST(unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS INT) AS pos, unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents),
c AS (SELECT doc_id, pos, trim(regexp_replace(raw, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS line FROM l),
n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM c WHERE line <> '' AND pos >= 1),
r AS (SELECT doc_id, pos, line, next, CASE WHEN regexp_matches(line, '^.*?([A-Za-z0-9._]+)@([A-Za-z0-9.-]+).*$') THEN 'mail' WHEN regexp_matches(line, '^([0-9]+) +(.+)$') THEN 'number first' WHEN regexp_matches(line, '^(#+) *(.+)$') THEN 'heading' WHEN regexp_matches(line, '^(-+)$') THEN 'mark' END AS reader FROM n)
SELECT doc_id, pos, reader, CASE reader WHEN 'mail' THEN regexp_extract(line, '^.*?([A-Za-z0-9._]+)@([A-Za-z0-9.-]+).*$', 1) WHEN 'number first' THEN regexp_extract(line, '^([0-9]+) +(.+)$', 1) WHEN 'heading' THEN regexp_extract(line, '^(#+) *(.+)$', 1) ELSE line END AS code,
  CASE reader WHEN 'mail' THEN regexp_extract(line, '^.*?([A-Za-z0-9._]+)@([A-Za-z0-9.-]+).*$', 2) WHEN 'number first' THEN trim(regexp_extract(line, '^([0-9]+) +(.+)$', 2)) WHEN 'heading' THEN trim(regexp_extract(line, '^(#+) *(.+)$', 2)) ELSE coalesce(next, '') END AS name FROM r WHERE reader IS NOT NULL""")
def line_readings(spark: SparkSession, d: str) -> DataFrame:
    """Four independent readers over a document's lines below its header band."""
    rows = lines.text_lines(load(spark, d, "documents"), ["doc_id"], "text", crop=1)
    return lines.readings(rows, ["doc_id"], _READERS).select("doc_id", "pos", "reader", "code", "name")


@query("""
WITH n AS (SELECT o_custkey AS doc, o_orderkey AS k, CASE o_orderkey % 3 WHEN 1 THEN '(' || o_orderstatus || 'V) Objects List' ELSE o_orderkey || ' ' || o_orderpriority || ' point' END AS line FROM orders),
f AS (SELECT *, CASE WHEN k % 3 = 1 THEN line END AS cap FROM n),
g AS (SELECT *, last_value(cap IGNORE NULLS) OVER (PARTITION BY doc ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM f)
SELECT doc, k AS pos, substr(c, 2, 2) AS type, CAST(split_part(line, ' ', 1) AS INT) AS inst, substr(line, length(split_part(line, ' ', 1)) + 2) AS name FROM g WHERE cap IS NULL""")
def section_typed_ids(spark: SparkSession, d: str) -> DataFrame:
    """Bare numbers take the type of the caption above them."""
    key = F.col("o_orderkey")
    line = F.when(key % 3 == 1, F.concat(F.lit("("), F.col("o_orderstatus"), F.lit("V) Objects List"))).otherwise(F.concat_ws(" ", key.cast("string"), "o_orderpriority", F.lit("point")))
    rows = load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), key.alias("pos"), line.alias("line"))
    return lines.section_typed(rows, ["doc"], r"^\(([A-Z]{2})\) Objects List$", "^([0-9]+) (.+)$")


@query("""
WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN '# ' || (event_id % 3) WHEN 'view' THEN 'label:' || (event_id % 4) ELSE 'v' || (event_id % 5) END AS line FROM events),
s AS (SELECT *, last_value(CASE WHEN starts_with(line, '#') THEN line END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM e),
n AS (SELECT user_id, event_id, section, line, lead(line) OVER (PARTITION BY user_id ORDER BY event_id) AS value FROM s WHERE NOT starts_with(line, '#'))
SELECT DISTINCT user_id, section, line AS label, value FROM n WHERE starts_with(line, 'label') AND NOT starts_with(value, 'label')""")
def section_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A label answered by the next line, under the section it stands in."""
    k = lambda n: (F.col("event_id") % n).cast("string")
    line = F.when(F.col("event_type") == "signup", F.concat(F.lit("# "), k(3))).when(F.col("event_type") == "view", F.concat(F.lit("label:"), k(4))).otherwise(F.concat(F.lit("v"), k(5)))
    rows = load(spark, d, "events").select("user_id", F.col("event_id").alias("pos"), line.alias("line"))
    is_label = F.startswith("line", F.lit("label"))
    return lines.label_values(rows, ["user_id"], F.startswith("line", F.lit("#")), is_label, ~is_label).select("user_id", "section", "label", "value")


@query("""
SELECT p_brand, CAST(p_partkey AS VARCHAR) AS number, p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN 'number' WHEN p_partkey % 3 = 1 THEN 'choice' ELSE 'text' END AS kind, CAST(p_size AS VARCHAR) AS "default",
  CASE WHEN p_partkey % 3 = 0 THEN p_size::DOUBLE END AS low, CASE WHEN p_partkey % 3 = 0 THEN p_size + 10.0::DOUBLE END AS high, CASE WHEN p_partkey % 2 = 0 THEN 'kW' END AS unit, p_type || ' is set here and more' AS description FROM part""")
def parameter_fields(spark: SparkSession, d: str) -> DataFrame:
    """Numbered parameter blocks with kind, default, range, unit and description."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    span = F.when(k % 3 == 0, F.concat(F.lit("Range: "), size, F.lit(" – "), (F.col("p_size") + 10).cast("string"))).when(k % 3 == 1, "Range: 0 = Off 1 = On")
    block = F.array(F.concat_ws(" ", k.cast("string"), "p_name"), F.concat_ws(" ", "p_type", F.lit("is set")), F.concat(F.lit("Default: "), size), span, F.when(k % 2 == 0, "Unit: kW"), F.lit("here and more"))
    rows = load(spark, d, "part").select("p_brand", "p_partkey", F.posexplode(F.filter(block, lambda x: x.isNotNull())).alias("at", "line"))
    rows = rows.select("p_brand", (F.col("p_partkey") * 10 + F.col("at")).alias("pos"), "line")
    return lines.parameters(rows, ["p_brand"], "^([0-9]+) (.+)$")


@query("""
WITH p AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS r FROM nation)
SELECT n_regionkey, 1 AS tab, CAST(r AS INT) AS row, c AS col, CASE c WHEN 0 THEN 'key' ELSE 'name' END AS head, CASE c WHEN 0 THEN CAST(n_nationkey AS VARCHAR) ELSE n_name END AS val FROM p, (VALUES (0), (1)) v(c)""")
def markdown_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of Markdown tables with the header above the rule."""
    n = load(spark, d, "nation")
    body = n.select("n_regionkey", (F.col("n_nationkey") + 10).alias("pos"), F.concat(F.lit("| "), F.col("n_nationkey").cast("string"), F.lit(" | "), "n_name", F.lit(" |")).alias("line"))
    top = F.array(*(F.struct(F.lit(k).alias("pos"), F.lit(t).alias("line")) for k, t in ((0, "text above"), (2, "| key | name |"), (3, "|:---|---|"))))
    heads = n.select("n_regionkey").distinct().select("n_regionkey", F.explode(top).alias("x")).select("n_regionkey", "x.pos", "x.line")
    # The lines of a table follow each other: places are made dense first.
    rows = heads.unionByName(body).withColumn("pos", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("pos")))
    return lines.markdown_rows(rows, ["n_regionkey"])


@query("""
WITH n AS (SELECT DISTINCT l_suppkey AS doc, CASE WHEN l_partkey % 4 = 0 THEN 'nciTemp' ELSE 'nvoTemp' END || (l_partkey % 7) AS name, CAST(l_partkey % 5 AS INT) AS inst, l_returnflag AS flag FROM lineitem)
SELECT doc, CASE WHEN starts_with(name, 'nci') THEN 'NCI' ELSE 'NV' END AS type, inst, name, CASE min(flag) WHEN 'A' THEN 'Recv' ELSE 'Send' END AS direction FROM n GROUP BY doc, inst, name""")
def deduplicated_variables(spark: SparkSession, d: str) -> DataFrame:
    """Network variables with type and direction, the first of each type, number and name (A10)."""
    k = F.col("l_partkey")
    name = F.concat(F.when(k % 4 == 0, "nciTemp").otherwise("nvoTemp"), (k % 7).cast("string"))
    rows = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc"), name.alias("name"), (k % 5).cast("int").alias("inst"), "l_returnflag")
    typed = rows.withColumn("type", F.when(F.startswith("name", F.lit("nci")), "NCI").otherwise("NV"))
    first = typed.groupBy("doc", "type", "inst", "name").agg(F.min("l_returnflag").alias("flag"))
    return first.select("doc", "type", "inst", "name", F.when(F.col("flag") == "A", "Recv").otherwise("Send").alias("direction"))


@query("""
WITH c AS (SELECT l_orderkey AS doc, count(*) AS n, avg((l_tax > 0.02)::INT) AS typed, bool_or(l_returnflag = 'R') AS lon, count(*) FILTER (l_linestatus = 'O') AS sections FROM lineitem GROUP BY l_orderkey)
SELECT doc, CASE WHEN lon AND n >= 4 THEN 'lontalk' WHEN n >= 4 AND typed > 0.8 THEN 'table' WHEN sections > n / 2 THEN 'section' WHEN n > 0 THEN 'table' END AS reader FROM c""")
def reader_choice(spark: SparkSession, d: str) -> DataFrame:
    """Which reader's result is taken: by key words and enough rows, then by typed rows, else the larger."""
    c = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("l_tax") > 0.02).cast("int")).alias("typed"), F.bool_or(F.col("l_returnflag") == "R").alias("lon"), F.count_if(F.col("l_linestatus") == "O").alias("sections")
    )
    reader = F.when(F.col("lon") & (F.col("n") >= 4), "lontalk").when((F.col("n") >= 4) & (F.col("typed") > 0.8), "table").when(F.col("sections") > F.col("n") / 2, "section").when(F.col("n") > 0, "table")
    return c.select("doc", reader.alias("reader"))


@query("""
WITH s AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS source, page_id, html FROM pages)
SELECT source, count(*) AS n_files, CAST(sum(octet_length(encode(coalesce(html, '')))) AS BIGINT) AS n_bytes, count(DISTINCT sha256(coalesce(html, ''))) AS n_contents FROM s GROUP BY source""")
def files_by_source(spark: SparkSession, d: str) -> DataFrame:
    """The files of each source with sizes and distinct contents."""
    html = F.coalesce("html", F.lit(""))
    rows = load(spark, d, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("source"), F.octet_length(html).alias("b"), F.sha2(html.cast("binary"), 256).alias("digest"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_files"), F.sum("b").cast("long").alias("n_bytes"), F.countDistinct("digest").alias("n_contents"))


@query("""
WITH u AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'the value is only valid while the unit is running at all' WHEN 1 THEN 'Default: ' || p_size WHEN 2 THEN '5 - 30 degC temperature range' WHEN 3 THEN 'kW' ELSE 'Pressure, Fluidic' END AS unit, p_type AS note FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 5 IN (3, 4) THEN unit END AS unit, CASE WHEN p_partkey % 5 IN (3, 4) THEN note ELSE note || ' · ' || unit END AS note FROM u""")
def unit_or_note(spark: SparkSession, d: str) -> DataFrame:
    """What stands in a unit's place but is prose, a default or a range goes to the note."""
    k = F.col("p_partkey") % 5
    unit = F.when(k == 0, "the value is only valid while the unit is running at all").when(k == 1, F.concat(F.lit("Default: "), F.col("p_size").cast("string"))).when(k == 2, "5 - 30 degC temperature range").when(k == 3, "kW").otherwise("Pressure, Fluidic")
    return load(spark, d, "part").select("p_partkey", S.unit_or_note(unit, F.col("p_type")).alias("x")).select("p_partkey", "x.unit", "x.note")


_HEADERS = {"Cooling cap.": "capacity", "Air Flow": "airflow", "Weight (lb)": "weight", "Amps": "current", "Notes": None, "Total Power": "power"}


@query(f"""
WITH h AS (SELECT [{", ".join(f"'{x}'" for x in _HEADERS)}][p_partkey % {len(_HEADERS)} + 1] AS header FROM part)
SELECT header, CASE {" ".join(f"WHEN header = '{h}' THEN '{q}'" for h, q in _HEADERS.items() if q)} END AS quantity, count(*) AS n FROM h GROUP BY header""")
def header_quantities(spark: SparkSession, d: str) -> DataFrame:
    """The physical quantity that a column's header names."""
    header = F.element_at(F.array(*map(F.lit, _HEADERS)), (F.col("p_partkey") % len(_HEADERS) + 1).cast("int"))
    tally = load(spark, d, "part").groupBy(header.alias("header")).agg(F.count(F.lit(1)).alias("n"))
    return match.first_match(tally, "header", S.HEADER_QUANTITIES, "quantity").select("header", "quantity", "n")


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Set point 20 °F' WHEN 1 THEN 'from 5°C up' ELSE p_name END AS fixed FROM part""")
def fixed_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Degree signs behind their letter put before it."""
    raw = F.when(F.col("p_partkey") % 3 == 0, "Set point 20 F°").when(F.col("p_partkey") % 3 == 1, "from 5C° up").otherwise(F.col("p_name"))
    return load(spark, d, "part").select("p_partkey", S.degrees_fixed(raw).alias("fixed"))


@query("""
WITH r(name, field, context, exclude) AS (VALUES ('flow', 'widget', 'red|cold', 'large'), ('size', 'gear', '', 'small'), ('colour', 'nothing', '', '')),
h AS (SELECT name, p_brand, p_type, bool_or(p_size > 25) AS strong FROM part, r WHERE regexp_matches(p_name, field) AND (context = '' OR regexp_matches(p_name, context)) AND NOT (exclude <> '' AND regexp_matches(p_name, exclude)) GROUP BY name, p_brand, p_type),
w AS (SELECT p_brand, name FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN r)
SELECT w.p_brand, w.name, CASE WHEN bool_or(strong) THEN 'matched' WHEN count(h.p_type) > 0 THEN 'candidate' ELSE 'missing' END AS status, count(h.p_type) AS n_kinds FROM w LEFT JOIN h ON h.name = w.name AND h.p_brand = w.p_brand GROUP BY w.p_brand, w.name""")
def requirement_status(spark: SparkSession, d: str) -> DataFrame:
    """Requirements by field, context and exclusion: matched by a strong source, candidate by any, else missing."""
    rules = [("flow", "widget", "red|cold", "large"), ("size", "gear", "", "small"), ("colour", "nothing", "", "")]
    return match.requirement_status(load(spark, d, "part"), "p_brand", "p_type", "p_name", F.col("p_size") > 25, rules)


@query("""
WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'input' WHEN 'error' THEN 'output' END AS mark, event_type, value FROM events),
p AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'output') AS phase FROM e),
f AS (SELECT user_id, phase || ' ' || event_type AS item, value, row_number() OVER (PARTITION BY user_id, phase, event_type ORDER BY event_id) AS r FROM p WHERE mark IS NULL)
SELECT user_id, item, round(value, 6) AS value FROM f WHERE r = 1""")
def rating_items(spark: SparkSession, d: str) -> DataFrame:
    """Lines named by the phase that was last announced; the first value of each item stays."""
    e = load(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    marked = e.withColumn("mark", F.when(F.col("event_type") == "signup", "input").when(F.col("event_type") == "error", "output"))
    phased = order.forward_fill(marked, "mark", ["user_id"], ["event_id"], "phase").filter(F.col("mark").isNull())
    items = phased.withColumn("item", F.concat_ws(" ", F.coalesce("phase", F.lit("output")), "event_type"))
    return order.first_wins(items, ["user_id", "item"], ["event_id"]).select("user_id", "item", F.round("value", 6).alias("value"))


@query("""
WITH u AS (SELECT c_custkey, c_nationkey AS class, CASE c_custkey % 3 WHEN 0 THEN c_custkey || ' Ton' WHEN 1 THEN c_custkey || ' Tons' ELSE 'EER ' || c_custkey END AS raw FROM customer)
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_custkey || ' Tons' WHEN 1 THEN c_custkey || ' Tons' ELSE CAST(c_custkey AS VARCHAR) END AS value, CASE WHEN class % 5 = 0 THEN 'refused' WHEN c_custkey % 3 = 1 THEN 'same' ELSE 'write' END AS action FROM u""")
def sync_actions(spark: SparkSession, d: str) -> DataFrame:
    """Unit values in one notation; units without a class are refused, unchanged ones not written."""
    k = F.col("c_custkey").cast("string")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(k, F.lit(" Ton"))).when(F.col("c_custkey") % 3 == 1, F.concat(k, F.lit(" Tons"))).otherwise(F.concat(F.lit("EER "), k))
    units = load(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("class"), raw.alias("raw"))
    return reconcile.sync_plan(units, "class", "raw", S.one_notation(F.col("raw"))).select("c_custkey", "value", "action")


@query("""
WITH t AS (SELECT p_partkey AS tab, p_brand AS model, CASE p_partkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 6 WHEN 4 THEN 4 END AS rung, p_name AS code FROM part),
b AS (SELECT model, min(rung) AS rung FROM t GROUP BY model)
SELECT t.model, t.rung, t.code, count(*) AS n FROM t JOIN b ON b.model = t.model AND b.rung = t.rung GROUP BY t.model, t.rung, t.code""")
def recognised_units(spark: SparkSession, d: str) -> DataFrame:
    """Of six ways to find a model's unit codes the first that finds any is taken, with all its codes."""
    k = F.col("p_partkey") % 7
    shapes = [(1, k == 0), (2, k == 2), (3, k == 1), (4, k == 4), (5, F.lit(False)), (6, k == 3)]
    return reconcile.first_rung(load(spark, d, "part"), "p_brand", "p_name", shapes).select(F.col("p_brand").alias("model"), "rung", F.col("p_name").alias("code"), "n")


@query("""
WITH s AS (SELECT o_custkey AS doc, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, count(*) AS n, count(DISTINCT o_orderpriority) AS k, arg_max(o_orderpriority, (o_orderpriority_n, o_orderpriority)) AS dominant
  FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS o_orderpriority_n FROM orders) GROUP BY o_custkey)
SELECT doc || CASE WHEN k > 1 THEN '-' || lower(left(dominant, 1)) ELSE '' END AS interface, doc, CAST(CAST(first_at AS DATE) AS VARCHAR) AS from_page, CAST(CAST(last_at AS DATE) AS VARCHAR) AS to_page, dominant AS family, n, n = k AS bijective FROM s""")
def interface_records(spark: SparkSession, d: str) -> DataFrame:
    """Interfaces with an id suffix, the span they come from, the dominant family and whether names pair one to one."""
    per = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("doc"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    s = per.groupBy("doc").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.max_by("o_orderpriority", F.struct("n", "o_orderpriority")).alias("family"))
    suffix = F.when(F.col("k") > 1, F.concat(F.lit("-"), F.lower(F.substring("family", 1, 1)))).otherwise("")
    day = lambda c: F.to_date(c).cast("string")
    return s.select(F.concat(F.col("doc").cast("string"), suffix).alias("interface"), "doc", day("a").alias("from_page"), day("b").alias("to_page"), "family", "n", (F.col("n") == F.col("k")).alias("bijective"))


@query("""
WITH i AS (SELECT doc_id, source, lang, n_chars FROM documents), g AS (SELECT source, count(*) AS n, count(lang) AS named, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT lang) AS k FROM i GROUP BY source)
SELECT coalesce(source, '') AS model, CASE WHEN k = 1 THEN min_lang ELSE k || ' labels' END AS label, n, CASE WHEN named < n THEN (n - named) || ' without label' ELSE '' END AS gap FROM g JOIN (SELECT source AS s, min(lang) AS min_lang FROM i GROUP BY source) ON s IS NOT DISTINCT FROM source""")
def registration_plan(spark: SparkSession, d: str) -> DataFrame:
    """Segments become models with a label, a count and the text of their gap."""
    g = load(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("lang").alias("named"), F.countDistinct("lang").alias("k"), F.min("lang").alias("first"))
    label = F.when(F.col("k") == 1, F.col("first")).otherwise(F.concat(F.col("k").cast("string"), F.lit(" labels")))
    gap = F.when(F.col("named") < F.col("n"), F.concat((F.col("n") - F.col("named")).cast("string"), F.lit(" without label"))).otherwise("")
    return g.select(F.coalesce("source", F.lit("")).alias("model"), label.alias("label"), "n", gap.alias("gap"))


@query("""
WITH a AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE l_partkey % 4 WHEN 0 THEN 'AI-' || l_linenumber WHEN 1 THEN 'abc' ELSE 'name ' || l_suppkey END AS ours, CASE l_partkey % 3 WHEN 0 THEN 'name ' || l_suppkey ELSE 'NAME  ' || l_suppkey END AS theirs FROM lineitem)
SELECT k, count(*) AS n, count(*) FILTER (usable) AS compared, count(*) FILTER (usable AND lower(regexp_replace(ours, ' +', ' ', 'g')) = lower(regexp_replace(theirs, ' +', ' ', 'g'))) AS agree FROM (SELECT *, length(ours) >= 4 AND NOT regexp_matches(ours, '^[A-Z]{2}-[0-9]+$') AS usable FROM a) GROUP BY k""")
def usable_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    """Two readings compared on names that say something: short ones and bare ids are skipped."""
    k = F.col("l_partkey")
    ours = F.when(k % 4 == 0, F.concat(F.lit("AI-"), F.col("l_linenumber").cast("string"))).when(k % 4 == 1, "abc").otherwise(F.concat(F.lit("name "), F.col("l_suppkey").cast("string")))
    theirs = F.concat(F.when(k % 3 == 0, "name ").otherwise("NAME  "), F.col("l_suppkey").cast("string"))
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), ours.alias("ours"), theirs.alias("theirs"))
    usable = (F.length("ours") >= 4) & S.object_id(F.col("ours"))["type"].isNull()
    same = F.lower(S.clean_text(F.col("ours"))) == F.lower(S.clean_text(F.col("theirs")))
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if(usable).alias("compared"), F.count_if(usable & same).alias("agree"))


@query("""
WITH c AS (SELECT c_mktsegment AS concept, c_nationkey % 3 AS profile, left(c_name, 12) AS label FROM customer),
g AS (SELECT concept, count(DISTINCT profile) AS n_profiles, count(DISTINCT label) AS n_names, count(*) AS n FROM c GROUP BY concept)
SELECT row_number() OVER (ORDER BY n DESC, concept) AS place, concept, n, n_profiles, n_names > 1 AS split FROM g""")
def concept_order(spark: SparkSession, d: str) -> DataFrame:
    """Shared concepts by size, with a flag where profiles name them differently."""
    c = load(spark, d, "customer").select(F.col("c_mktsegment").alias("concept"), (F.col("c_nationkey") % 3).alias("profile"), F.substring("c_name", 1, 12).alias("label"))
    g = c.groupBy("concept").agg(F.countDistinct("profile").alias("n_profiles"), F.countDistinct("label").alias("n_names"), F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "concept")).cast("long")  # one row per concept
    return g.select(place.alias("place"), "concept", "n", "n_profiles", (F.col("n_names") > 1).alias("split"))


@query("""
WITH r AS (SELECT item_id, left(text, 8) AS id, CASE WHEN item_id % 3 = 0 THEN '' ELSE 'why' END AS why, CASE item_id % 4 WHEN 0 THEN 'store' WHEN 1 THEN 'feature' WHEN 2 THEN 'store,feature' ELSE '' END AS holds FROM benchmark),
d AS (SELECT id FROM r GROUP BY id HAVING count(*) > 1)
SELECT id AS entity, 'dup-id' AS code, CAST(count(*) AS BIGINT) AS n FROM r WHERE id IN (SELECT id FROM d) GROUP BY id
UNION ALL SELECT id, 'no-why', count(*) FROM r WHERE why = '' GROUP BY id
UNION ALL SELECT id, 'store-xor-feature', count(*) FROM r WHERE holds IN ('store,feature', '') GROUP BY id""")
def requirement_gate(spark: SparkSession, d: str) -> DataFrame:
    """Requirement definitions: repeated ids, no reason, neither or both of storage and features."""
    k = F.col("item_id")
    holds = F.when(k % 4 == 0, "store").when(k % 4 == 1, "feature").when(k % 4 == 2, "store,feature").otherwise("")
    r = load(spark, d, "benchmark").select(F.substring("text", 1, 8).alias("id"), (k % 3 == 0).alias("no_why"), holds.alias("holds"))
    of = r.groupBy(F.col("id").alias("entity")).agg(F.count(F.lit(1)).alias("n"), F.count_if("no_why").alias("no_why"), F.count_if(F.col("holds").isin("store,feature", "")).alias("xor"))
    codes = F.array(F.struct(F.lit("dup-id").alias("code"), F.when(F.col("n") > 1, F.col("n")).otherwise(0).alias("n")), F.struct(F.lit("no-why").alias("code"), F.col("no_why").alias("n")), F.struct(F.lit("store-xor-feature").alias("code"), F.col("xor").alias("n")))
    return of.select("entity", F.explode(codes).alias("x")).select("entity", "x.code", "x.n").filter("n > 0")


@query("""
SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT doc_id % 4) AS n_slices FROM documents GROUP BY source""")
def merged_slices(spark: SparkSession, d: str) -> DataFrame:
    """Slices scanned apart and merged: sums of the slices' tallies equal those of the whole."""
    docs = load(spark, d, "documents").select("doc_id", "source", "n_chars")
    parts = [docs.filter(F.pmod("doc_id", F.lit(4)) == k).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")) for k in range(4)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return merged.groupBy("source").agg(F.sum("n").alias("n"), F.sum("chars").cast("long").alias("chars"), F.count(F.lit(1)).alias("n_slices"))


@query("""
WITH t AS (SELECT l_orderkey AS model, l_linenumber AS idx, CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS risk FROM lineitem)
SELECT model, idx, risk, row_number() OVER (PARTITION BY model ORDER BY risk, idx) AS place FROM t""")
def risk_queue(spark: SparkSession, d: str) -> DataFrame:
    """What is checked first in every model: transposed ratings, then the rest, in order."""
    risk = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_linestatus") == "O", 1).otherwise(2)
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("model"), F.col("l_linenumber").alias("idx"), risk.alias("risk"))
    place = F.row_number().over(Window.partitionBy("model").orderBy("risk", "idx")).cast("long")
    return rows.select("model", "idx", "risk", place.alias("place"))


_TERMS = [("warm", "the|der"), ("count", "und|and"), ("rare", "zzyzx")]


@query(f"""
WITH i(item, term) AS (VALUES {", ".join(f"('{i}', '{t}')" for i, t in _TERMS)}),
p AS (SELECT item, doc_id, regexp_matches(lower(left(text, 200)), '(^|[^a-z])(' || term || ')([^a-z]|$)') AS head, regexp_matches(lower(text), '(^|[^a-z])(' || term || ')([^a-z]|$)') AS body, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits FROM documents, i),
h AS (SELECT item, doc_id, CASE WHEN head AND digits >= 40 THEN 2 ELSE 1 END AS grade, digits FROM p WHERE body),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY grade DESC, digits DESC, doc_id) AS place FROM h),
v AS (SELECT item, max(grade) AS grade FROM h GROUP BY item)
SELECT i.item, CASE v.grade WHEN 2 THEN 'table' WHEN 1 THEN 'weak' ELSE 'not in table' END AS verdict, r.doc_id, r.place FROM i LEFT JOIN v ON v.item = i.item LEFT JOIN r ON r.item = i.item AND r.place <= 8""")
def item_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Whether each item stands in a table, weakly or not at all, with its eight best pages."""
    docs = load(spark, d, "documents").select("doc_id", F.lower("text").alias("t"), F.length(F.regexp_replace("text", "[^0-9]", "")).alias("digits"))
    whole = lambda term: f"(^|[^a-z])({term})([^a-z]|$)"
    found = [F.when(F.col("t").rlike(whole(t)), F.struct(F.lit(i).alias("item"), F.when(F.substring("t", 1, 200).rlike(whole(t)) & (F.col("digits") >= 40), 2).otherwise(1).alias("grade"))) for i, t in _TERMS]
    hits = docs.select("doc_id", "digits", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select("x.item", "x.grade", "doc_id", "digits")
    verdicts = hits.groupBy("item").agg(F.max("grade").alias("best"))
    pages = match.top_inputs(hits.withColumn("rank", -F.col("grade")).withColumn("order", -F.col("digits")), "item", "rank", ["order", "doc_id"]).select("item", "doc_id", F.col("place").cast("long").alias("place"))
    items = spark.createDataFrame([(i,) for i, _ in _TERMS], "item string")
    verdict = F.when(F.col("best") == 2, "table").when(F.col("best") == 1, "weak").otherwise("not in table")
    return items.join(verdicts, "item", "left").join(pages, "item", "left").select("item", verdict.alias("verdict"), "doc_id", "place")


@query("""
WITH n AS (SELECT CASE p_partkey % 5 WHEN 0 THEN 'AI' WHEN 1 THEN 'NV' WHEN 2 THEN 'MB' WHEN 3 THEN 'NCI' ELSE '??' END AS type, CASE WHEN p_partkey % 3 = 0 THEN 'furlong' ELSE 'kPa' END AS unit FROM part),
b AS (SELECT CASE type WHEN 'AI' THEN 'bacnet' WHEN 'NV' THEN 'lon' WHEN 'NCI' THEN 'lon' WHEN 'MB' THEN 'modbus' ELSE 'none' END AS block, type = '??' AS lost, unit = 'furlong' AS gap FROM n)
SELECT block, count(*) AS n, count(*) FILTER (lost) AS lost, count(*) FILTER (gap OR lost) AS gaps FROM b GROUP BY block""")
def routing_selfcheck(spark: SparkSession, d: str) -> DataFrame:
    """Where routed points went, how many lost their number and how many have gaps."""
    k = F.col("p_partkey")
    kind = F.when(k % 5 == 0, "AI").when(k % 5 == 1, "NV").when(k % 5 == 2, "MB").when(k % 5 == 3, "NCI").otherwise("??")
    x = load(spark, d, "part").select(S.routed(kind, F.col("p_size"), F.when(k % 3 == 0, "furlong").otherwise("kPa")).alias("x")).select("x.*")
    lost = F.coalesce("bacnet_instance", "lon_index", "modbus_address").isNull()
    return x.groupBy(F.coalesce("block", F.lit("none")).alias("block")).agg(F.count(F.lit(1)).alias("n"), F.count_if(lost).alias("lost"), F.count_if(F.col("gaps") != "").alias("gaps"))


@query("""
WITH t AS (SELECT p_partkey, p_brand, p_type, p_name, CASE WHEN p_name = 'red widget' THEN 50 ELSE 0 END + CASE WHEN contains(p_name, 'gear') THEN 30 ELSE 0 END + CASE WHEN regexp_matches(p_name, 'w.?i.?d.?g') THEN 20 ELSE 0 END + CASE WHEN p_type = 'PROMO' THEN 6 ELSE 0 END AS score,
  CASE WHEN regexp_matches(p_name, 'widget') THEN 'capacity' WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'electrical' WHEN p_size < 20 THEN 'dimension' ELSE 'other' END AS category FROM part)
SELECT p_partkey, p_brand, category, score, row_number() OVER (PARTITION BY p_brand, category ORDER BY score DESC, p_partkey) AS place FROM t""")
def ranked_tables(spark: SparkSession, d: str) -> DataFrame:
    """All raw tables of a brand by category and relevance."""
    name = F.col("p_name")
    points = [(name == "red widget", 50), (F.contains(name, F.lit("gear")), 30), (name.rlike("w.?i.?d.?g"), 20), (F.col("p_type") == "PROMO", 6)]
    score = sum((F.when(c, n).otherwise(0) for c, n in points), F.lit(0))
    category = F.when(name.rlike("widget"), "capacity").when(F.col("p_type").isin("ECONOMY", "STANDARD"), "electrical").when(F.col("p_size") < 20, "dimension").otherwise("other")
    rows = load(spark, d, "part").select("p_partkey", "p_brand", category.alias("category"), score.alias("score"))
    place = F.row_number().over(Window.partitionBy("p_brand", "category").orderBy(F.desc("score"), "p_partkey")).cast("long")
    return rows.withColumn("place", place)


#: Nine independent readers of point lines; where no group is given for the name it stands on the next line.
POINT_READERS = [
    ("lontalk", "^(nv[io]|nci)([A-Z][A-Za-z0-9]*)$", 2, 0), ("bacnet", "^((?:A|B|MS)[IOV]-[0-9]+)$", 1, 0), ("reversed", "^([0-9]+-(?:A|B)[IOV])$", 1, 0),
    ("type first", "^((?:A|B)[IOV] [0-9]+) (.+)$", 1, 2), ("name first", "^(.+) ((?:A|B)[IOV]-?[0-9]+)$", 2, 1), ("wide register", "^([34][0-9]{5}) (.+)$", 1, 2),
    ("register", "^([34][0-9]{4}) (.+)$", 1, 2), ("hex register", "^([0-9A-F]{4}h) (.+)$", 1, 2), ("bare id", "^([0-9]{1,6})$", 1, 0),
]
_FORMS = ["'nvoTemp' || s", "'AI-' || s", "s || '-BV'", "'AO ' || s || ' ' || n", "n || ' BI' || s", "'4' || lpad(s, 5, '0') || ' ' || n", "'3' || lpad(s, 4, '0') || ' ' || n", "lpad(s, 4, '0') || 'h ' || n", "s"]
_CODES = ["'Temp' || s", "'AI-' || s", "s || '-BV'", "'AO ' || s", "'BI' || s", "'4' || lpad(s, 5, '0')", "'3' || lpad(s, 4, '0')", "lpad(s, 4, '0') || 'h'", "s"]


@query(f"""
WITH p AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS s, p_name AS n, p_partkey % 9 AS k FROM part)
SELECT p_partkey, CASE k {" ".join(f"WHEN {k} THEN '{r[0]}'" for k, r in enumerate(POINT_READERS))} END AS reader, CASE k {" ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(_CODES))} END AS code, n AS name FROM p""")
def point_line_readings(spark: SparkSession, d: str) -> DataFrame:
    """Nine forms of point lines read by nine readers; codes alone take the next line as name."""
    own = F.expr("CASE k " + " ".join(f"WHEN {k} THEN {f}" for k, f in enumerate(_FORMS)) + " END")
    p = load(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("s"), F.col("p_name").alias("n"), (F.col("p_partkey") % 9).alias("k"))
    both = F.filter(F.array(own, F.when(F.col("k").isin(0, 1, 2, 8), F.col("n"))), lambda x: x.isNotNull())
    rows = p.select("p_partkey", F.posexplode(both).alias("pos", "line"))
    return lines.readings(rows, ["p_partkey"], POINT_READERS).select("p_partkey", "reader", "code", "name")
