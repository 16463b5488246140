"""Queries that scan raw cells, check points, interfaces and units, and compare with standards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import gates, graph, match, publish, scan
from tessera.plans.registry import query
from tessera.sources.tables import load

POINT_LIST = scan.Family("point list", [("id", "object id"), ("id", "id"), ("name", "point name"), ("name", "name"), ("unit", "unit"), ("note", "remark")])
REGISTERS = scan.Family("registers", [("id", "register"), ("name", "description"), ("unit", "unit"), ("note", "remark")], default_type="AV")

#: A brand's parts as a table of cells: a banner, a header (of two layouts), then rows; every seventh id is missing.
_CELLS = """
WITH p AS (SELECT p_brand AS doc, CAST(length(p_brand) % 2 AS INT) AS swap, p_partkey, p_name, p_size, p_type, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INT) + 1 AS r FROM part),
d AS (SELECT DISTINCT doc, swap FROM p),
v AS (
  SELECT doc, 0 AS r, 0 AS k, 'Controller ' || doc AS val FROM d
  UNION ALL SELECT doc, 1, 0, 'Object ID' FROM d UNION ALL SELECT doc, 1, 1, 'Point Name' FROM d UNION ALL SELECT doc, 1, 2, 'Units' FROM d UNION ALL SELECT doc, 1, 3, 'Remarks' FROM d UNION ALL SELECT doc, 1, 4, 'Price' FROM d
  UNION ALL SELECT doc, r, 0, CASE p_partkey % 7 WHEN 0 THEN '-' WHEN 1 THEN 'Analog Input, ' || p_size ELSE 'BV-' || p_size END FROM p
  UNION ALL SELECT doc, r, 1, CASE WHEN p_partkey % 11 = 0 THEN 'Name' WHEN p_partkey % 13 = 0 THEN ' ' ELSE '  ' || p_name END FROM p
  UNION ALL SELECT doc, r, 2, CASE p_partkey % 3 WHEN 0 THEN 'kW' WHEN 1 THEN '0 = Off 1 = On' ELSE 'N/A' END FROM p
  UNION ALL SELECT doc, r, 3, p_type FROM p UNION ALL SELECT doc, r, 4, CAST(p_size AS VARCHAR(9)) FROM p)
SELECT v.doc, 1 AS page, 0 AS tab, r AS row, CASE WHEN swap = 1 AND k < 2 THEN 1 - k ELSE k END AS col, val FROM v JOIN d ON v.doc = d.doc"""
_EXPECTED = """
WITH p AS (SELECT p_brand AS doc, p_partkey, p_name, p_size, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part),
s AS (SELECT *, CASE WHEN p_partkey % 7 = 1 THEN 'AI' ELSE 'BV' END AS type, CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 13 = 0 THEN 'no name' WHEN p_partkey % 11 = 0 THEN 'header again' WHEN p_partkey % 7 = 0 THEN 'no id' END AS skip FROM p),
f AS (SELECT *, CASE WHEN skip IS NULL AND row_number() OVER (PARTITION BY doc, type, p_size, skip IS NULL ORDER BY r) > 1 THEN 'repeat' ELSE skip END AS reason FROM s)"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_CELLS.replace("FROM part)", "FROM {part})").replace("VARCHAR(9)", "STRING"), part=load(spark, d, "part"))


@query(_EXPECTED + """
SELECT doc, CAST(r + 1 AS INT) AS row, type, p_size AS inst, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN 'kW' END AS unit,
  CASE WHEN p_partkey % 3 = 1 THEN p_type || ' · 0 = Off 1 = On' ELSE p_type END AS note FROM f WHERE reason IS NULL""")
def table_scan(spark: SparkSession, d: str) -> DataFrame:
    """Cells of raw tables to points: header row below a banner, aliases, ids, units, first of repeats."""
    points, _, _ = scan.scan(_cells(spark, d), POINT_LIST)
    return points.select("doc", "row", "type", "inst", "name", "unit", "note")


@query(_EXPECTED + """
SELECT 'point list' AS family, doc, reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY doc, reason""")
def table_scan_skips(spark: SparkSession, d: str) -> DataFrame:
    """Rows that are no points, counted by reason."""
    return scan.scan(_cells(spark, d), POINT_LIST)[1]


@query("SELECT DISTINCT p_brand AS doc, 'Price' AS \"column\", CAST(1 AS BIGINT) AS n FROM part")
def table_scan_unknown(spark: SparkSession, d: str) -> DataFrame:
    """Header cells that no field takes."""
    return scan.scan(_cells(spark, d), POINT_LIST)[2]


_REGISTER_CELLS = """
WITH s AS (SELECT s_nationkey, s_suppkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS r FROM supplier),
d AS (SELECT DISTINCT s_nationkey FROM s)
SELECT 'n' || s_nationkey AS doc, 1 AS page, 0 AS tab, 0 AS row, 0 AS col, 'Description' AS val FROM d
UNION ALL SELECT 'n' || s_nationkey, 1, 0, 0, 1, 'Register' FROM d
UNION ALL SELECT 'n' || s_nationkey, 1, 0, CAST(r AS INT), 0, s_name FROM s
UNION ALL SELECT 'n' || s_nationkey, 1, 0, CAST(r AS INT), 1, CASE WHEN s_suppkey % 5 = 0 THEN 'x' ELSE CAST(s_suppkey AS VARCHAR(9)) END FROM s"""


@query("SELECT 'n' || s_nationkey AS doc, 'AV' AS type, CAST(s_suppkey AS INT) AS inst, s_name AS name FROM supplier WHERE s_suppkey % 5 <> 0")
def register_scan(spark: SparkSession, d: str) -> DataFrame:
    """A second family: bare register numbers take the family's type."""
    cells = spark.sql(_REGISTER_CELLS.replace("FROM supplier", "FROM {supplier}").replace("VARCHAR(9)", "STRING"), supplier=load(spark, d, "supplier"))
    return scan.scan(cells, REGISTERS)[0].select("doc", "type", "inst", "name")


TYPED = scan.Family("typed points", [("objtype", "object type"), ("instance", "instance"), ("name", "point name")], keys=("objtype",))
_TYPED_CELLS = """
WITH c AS (SELECT c_nationkey, c_custkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer),
d AS (SELECT DISTINCT c_nationkey FROM c),
h AS (SELECT 0 AS k, 'Point  Name' AS val UNION ALL SELECT 1, 'Object Type' UNION ALL SELECT 2, 'INSTANCE')
SELECT 'c' || c_nationkey AS doc, 1 AS page, 0 AS tab, 0 AS row, k AS col, val FROM d CROSS JOIN h
UNION ALL SELECT 'c' || c_nationkey, 1, 0, CAST(r AS INT), 0, c_name FROM c
UNION ALL SELECT 'c' || c_nationkey, 1, 0, CAST(r AS INT), 1, CASE c_custkey % 4 WHEN 0 THEN 'Analog Value' WHEN 1 THEN 'BI' WHEN 2 THEN 'multi-state Output' ELSE 'Schedule' END FROM c
UNION ALL SELECT 'c' || c_nationkey, 1, 0, CAST(r AS INT), 2, CAST(c_custkey % 50 AS VARCHAR(9)) FROM c"""


@query("""
WITH t AS (SELECT 'c' || c_nationkey AS doc, CASE c_custkey % 4 WHEN 0 THEN 'AV' WHEN 1 THEN 'BI' WHEN 2 THEN 'MSO' END AS type, CAST(c_custkey % 50 AS INT) AS inst, c_custkey, c_name AS name FROM customer),
f AS (SELECT *, row_number() OVER (PARTITION BY doc, type, inst ORDER BY c_custkey) AS r FROM t WHERE type IS NOT NULL)
SELECT doc, type, inst, name FROM f WHERE r = 1""")
def typed_scan(spark: SparkSession, d: str) -> DataFrame:
    """A third family: the type in a column of its own, the number in another."""
    cells = spark.sql(_TYPED_CELLS.replace("FROM customer", "FROM {customer}").replace("VARCHAR(9)", "STRING"), customer=load(spark, d, "customer"))
    return scan.scan(cells, TYPED)[0].select("doc", "type", "inst", "name")


_SIDES = {"degF": "IP", "deg. C": "SI", "percent": "both", "CFM": "IP", "kPa": "SI", "L/S": "SI", "furlong": None, "Voltage": "both"}


@query(f"""
WITH u AS (SELECT [{", ".join(f"'{u}'" for u in _SIDES)}][p_partkey % {len(_SIDES)} + 1] AS unit FROM part)
SELECT unit, CASE {" ".join(f"WHEN unit = '{u}' THEN '{x}'" for u, x in _SIDES.items() if x)} END AS side, count(*) AS n FROM u GROUP BY unit""")
def unit_sides(spark: SparkSession, d: str) -> DataFrame:
    """The unit system of spellings."""
    unit = F.element_at(F.array(*map(F.lit, _SIDES)), (F.col("p_partkey") % len(_SIDES) + 1).cast("int"))
    tally = load(spark, d, "part").select(unit.alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    return tally.select("unit", S.unit_side(F.col("unit")).alias("side"), "n")


@query("""
WITH q AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM benchmark),
s AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS t FROM documents),
ours AS (SELECT item_id, unnest(t) AS x FROM q), theirs AS (SELECT doc_id, unnest(t) AS x FROM s),
k AS (SELECT item_id, doc_id, count(*) AS k FROM ours JOIN theirs USING (x) GROUP BY item_id, doc_id),
j AS (SELECT item_id, doc_id, k / (len(q.t) + len(s.t) - k)::DOUBLE AS score FROM k JOIN q USING (item_id) JOIN s USING (doc_id)),
b AS (SELECT item_id, max(score) AS score FROM j GROUP BY item_id),
w AS (SELECT item_id, score, min(doc_id) AS doc_id, count(*) AS n_best FROM j JOIN b USING (item_id, score) GROUP BY item_id, score),
v AS (SELECT q.item_id, coalesce(w.doc_id, (SELECT min(doc_id) FROM documents)) AS doc_id, coalesce(score, 0) AS score, coalesce(n_best, (SELECT count(*) FROM documents)) AS n_best FROM q LEFT JOIN w USING (item_id)),
r AS (SELECT *, CASE WHEN score < 0.6 THEN 'only-ours' WHEN score < 0.75 OR n_best > 1 THEN 'ambiguous' WHEN score >= 0.999 THEN 'exact' ELSE 'hit' END AS verdict FROM v)
SELECT 'item' AS kind, item_id AS id, verdict, round(score, 9) AS score FROM r
UNION ALL SELECT 'document', doc_id, 'only-standard', NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r WHERE verdict IN ('hit', 'exact'))""")
def standard_diff(spark: SparkSession, d: str) -> DataFrame:
    """Items against the sets that are most like them: hit, exact, ambiguous on a tie, ours alone; sets nobody claims."""
    items, docs = load(spark, d, "benchmark"), load(spark, d, "documents")
    best = match.nearest_sets(items.select("item_id", S.tokens(F.col("text")).alias("q")), docs.select("doc_id", S.tokens(F.col("text")).alias("t")), "item_id", "q", "doc_id", "t")
    score = F.col("score")
    verdict = F.when(score < 0.6, "only-ours").when((score < 0.75) | (F.col("n_best") > 1), "ambiguous").when(score >= 0.999, "exact").otherwise("hit")
    judged = best.withColumn("verdict", verdict)
    claimed = judged.filter(F.col("verdict").isin("hit", "exact")).select("doc_id").distinct()
    free = docs.select("doc_id").join(claimed, "doc_id", "left_anti")
    ours = judged.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), "verdict", F.round("score", 9).alias("score"))
    return ours.unionByName(free.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit("only-standard").alias("verdict"), F.lit(None).cast("double").alias("score")))


@query("""
WITH RECURSIVE n AS (SELECT DISTINCT replace(p_name, ' ', '-') AS name, p_type FROM part),
e AS (SELECT name AS child, lower(p_type) AS parent FROM n UNION SELECT name, unnest(string_split(name, '-')) FROM n UNION SELECT lower(p_type), 'kind' FROM n UNION VALUES ('widget', 'thing'), ('gear', 'thing')),
c AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e WHERE parent <> child UNION SELECT c.node, e.parent, c.depth + 1 FROM c JOIN e ON e.child = c.ancestor AND e.parent <> e.child)
SELECT node, ancestor, min(depth) AS depth FROM c GROUP BY node, ancestor""")
def compound_closure(spark: SparkSession, d: str) -> DataFrame:
    """Supertypes of hyphenated names, their parts included."""
    names = load(spark, d, "part").select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("child"), F.lower("p_type").alias("parent")).distinct()
    more = names.select(F.col("parent").alias("child"), F.lit("kind").alias("parent")).distinct()
    own = spark.createDataFrame([("widget", "thing"), ("gear", "thing")], "child string, parent string")
    return graph.closure(graph.with_parts(names.unionByName(more).unionByName(own)))


@query("SELECT p_brand, p_name, count(DISTINCT p_size) AS n_instances, count(*) AS n FROM part GROUP BY p_brand, p_name HAVING count(DISTINCT p_size) >= 3")
def repeated_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that stand at three instances or more of one document."""
    return load(spark, d, "part").groupBy("p_brand", "p_name").agg(F.countDistinct("p_size").alias("n_instances"), F.count(F.lit(1)).alias("n")).filter("n_instances >= 3")


@query("""
WITH c AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY p_brand, p_name), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_name) AS place FROM c)
SELECT p_brand, place, p_name AS label, n FROM r WHERE place <= 3
UNION ALL SELECT p_brand, 4, '… ' || count(*) || ' more', CAST(sum(n) AS BIGINT) FROM r WHERE place > 3 GROUP BY p_brand""")
def top_with_remainder(spark: SparkSession, d: str) -> DataFrame:
    """The three most frequent names of a brand and what is left as one row."""
    counts = load(spark, d, "part").groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return publish.top_and_rest(counts, "p_brand", "p_name", "n", 3)


@query("""
WITH h AS (
  SELECT 'part' AS kind, CAST(p_partkey AS VARCHAR) AS ref, p_name AS label FROM part WHERE contains(lower(p_name), 're')
  UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name FROM customer WHERE contains(lower(c_name), 're')
  UNION ALL SELECT 'turn', conv_id || '-' || turn, left(text, 20) FROM conversations WHERE contains(lower(text), 're'))
SELECT kind, ref, label FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ref, label) AS r FROM h) WHERE r <= 5""")
def capped_search(spark: SparkSession, d: str) -> DataFrame:
    """A needle in several tables, five hits a kind."""
    part, customer, turns = (load(spark, d, t) for t in ("part", "customer", "conversations"))
    ref = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return publish.search([("part", part, F.col("p_partkey"), F.col("p_name")), ("customer", customer, F.col("c_custkey"), F.col("c_name")), ("turn", turns, ref, F.col("text"))], "re", cap=5, label_chars=20)


@query("""
WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || ' mm' WHEN 1 THEN p_name WHEN 2 THEN '-' ELSE CAST(p_size AS VARCHAR) || '.5' END AS label FROM part)
SELECT p_partkey, label, row_number() OVER (ORDER BY label = '-', CASE WHEN regexp_matches(label, '^[0-9]') THEN CAST(regexp_extract(label, '^[0-9]+(\\.[0-9]+)?') AS DOUBLE) END NULLS LAST, label, p_partkey) AS place FROM p QUALIFY place <= 40""")
def natural_order_page(spark: SparkSession, d: str) -> DataFrame:
    """The first page of labels in natural order: leading numbers by value, absent ones last."""
    k = F.col("p_partkey") % 4
    label = F.when(k == 0, F.concat(F.col("p_size").cast("string"), F.lit(" mm"))).when(k == 1, F.col("p_name")).when(k == 2, "-").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    rows = load(spark, d, "part").select("p_partkey", label.alias("label")).orderBy(*S.natural_order(F.col("label")), "p_partkey").limit(40)
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*S.natural_order(F.col("label")), "p_partkey")).cast("long"))


@query("""
WITH a AS (SELECT l_orderkey AS k, min(l_partkey) AS part FROM lineitem GROUP BY l_orderkey), b AS (SELECT o_orderkey AS k, o_orderpriority AS other FROM orders),
j AS (SELECT left(other, 1) AS family, p_name AS ours, CASE k % 3 WHEN 0 THEN p_name || ' ' || other WHEN 1 THEN split_part(p_name, ' ', 1) ELSE other END AS theirs FROM a JOIN b USING (k) JOIN part ON part = p_partkey)
SELECT family, count(*) AS n, count(*) FILTER (starts_with(lower(ours), lower(theirs)) OR starts_with(lower(theirs), lower(ours))) AS agree, count(*) FILTER (length(theirs) < 4) AS too_short FROM j GROUP BY family""")
def prefix_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    """A second reading of names agrees if one is the start of the other, per family."""
    ours = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_partkey").alias("p_partkey"))
    both = ours.join(load(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority"), "k").join(load(spark, d, "part").select("p_partkey", "p_name"), "p_partkey")
    k = F.col("k") % 3
    theirs = F.when(k == 0, F.concat_ws(" ", "p_name", "o_orderpriority")).when(k == 1, F.split("p_name", " ")[0]).otherwise(F.col("o_orderpriority"))
    read = both.select(F.substring("o_orderpriority", 1, 1).alias("family"), F.lower("p_name").alias("ours"), F.lower(theirs).alias("theirs"))
    agree = F.startswith("ours", F.col("theirs")) | F.startswith("theirs", F.col("ours"))
    return read.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.count_if(agree).alias("agree"), F.count_if(F.length("theirs") < 4).alias("too_short"))


_TITLES = [("pump", "pump|large"), ("chiller", "chill|cold"), ("fan", "fan|hot")]
_EVIDENCE = [("air", ("red", "blue", "gear"), 2), ("field", ("widget", "small", "green"), 2)]


@query(f"""
WITH h AS (SELECT p_partkey, p_name, {", ".join("(" + " + ".join(f"regexp_matches(p_name, '{p}')::INT" for p in pats) + f") AS h{k}" for k, (_, pats, _) in enumerate(_EVIDENCE))} FROM part)
SELECT p_partkey, CASE WHEN h0 >= 2 AND h0 >= h1 THEN 'air' WHEN h1 >= 2 THEN 'field' {" ".join(f"WHEN regexp_matches(p_name, '(?i){p}') THEN '{c}'" for c, p in _TITLES)} END AS class,
  CASE WHEN greatest(h0, h1) >= 2 THEN 'evidence: ' || CAST(greatest(h0, h1) AS INT) {" ".join(f"WHEN regexp_matches(p_name, '(?i){p}') THEN 'title: ' || regexp_extract(p_name, '(?i){p}')" for _, p in _TITLES)} ELSE 'not enough evidence' END AS reason FROM h""")
def classified_equipment(spark: SparkSession, d: str) -> DataFrame:
    """Class by evidence, else by title, else none, with the reason."""
    part = load(spark, d, "part").select("p_partkey", "p_name")
    return match.by_evidence_or_title(part, "p_name", "p_name", _EVIDENCE, _TITLES).select("p_partkey", "class", "reason")


_NAMES, _KINDS = [("cold", "refrigeration"), ("hot", "heating"), ("red|blue", "paint")], {"ECONOMY": "heating", "PROMO": "paint"}


@query(f"""
WITH n AS (SELECT p_partkey, CASE {" ".join(f"WHEN regexp_matches(p_name, '(?i){p}') THEN '{c}'" for p, c in _NAMES)} END AS by_name, CASE p_type WHEN 'ECONOMY' THEN 'heating' WHEN 'PROMO' THEN 'paint' END AS by_kind FROM part)
SELECT coalesce(by_name, by_kind) AS class, CASE WHEN by_name <> by_kind THEN 'vendor says ' || by_kind WHEN coalesce(by_name, by_kind) IS NULL THEN 'no class' END AS gap, count(*) AS n FROM n GROUP BY 1, 2""")
def product_classes(spark: SparkSession, d: str) -> DataFrame:
    """Product names before the vendor's category; a disagreement is kept as a gap."""
    named = match.first_match(load(spark, d, "part").select("p_name", "p_type"), "p_name", _NAMES, "by_name").withColumn("by_kind", S.lookup(F.col("p_type"), _KINDS))
    found = F.coalesce("by_name", "by_kind")
    gap = F.when(F.col("by_name") != F.col("by_kind"), F.concat(F.lit("vendor says "), F.col("by_kind"))).when(found.isNull(), "no class")
    return named.groupBy(found.alias("class"), gap.alias("gap")).agg(F.count(F.lit(1)).alias("n"))


_ROWS = [("r1", "cold.*gear|red.*gear"), ("r2", "^hot"), ("r3", "widget.*small|gear.*large")]


@query("""
WITH n AS (SELECT DISTINCT p_brand, p_name FROM part),
s1 AS (SELECT p_brand, min(p_name) AS i FROM n WHERE regexp_matches(p_name, 'cold.*gear|red.*gear') GROUP BY p_brand),
s2 AS (SELECT p_brand, min(n.p_name) AS i FROM n LEFT JOIN s1 USING (p_brand) WHERE regexp_matches(p_name, '^hot') AND p_name IS DISTINCT FROM s1.i GROUP BY p_brand),
s3 AS (SELECT p_brand, min(n.p_name) AS i FROM n LEFT JOIN s1 USING (p_brand) LEFT JOIN s2 USING (p_brand) WHERE regexp_matches(p_name, 'widget.*small|gear.*large') AND p_name IS DISTINCT FROM s1.i AND p_name IS DISTINCT FROM s2.i GROUP BY p_brand),
l3 AS (SELECT n.p_brand, min(n.p_name) AS i FROM n LEFT JOIN s1 USING (p_brand) LEFT JOIN s2 USING (p_brand) LEFT JOIN s3 USING (p_brand)
  WHERE s3.i IS NULL AND (regexp_matches(p_name, '(^|[^0-9a-z])widget') AND regexp_matches(p_name, '(^|[^0-9a-z])small') OR regexp_matches(p_name, '(^|[^0-9a-z])gear') AND regexp_matches(p_name, '(^|[^0-9a-z])large'))
  AND p_name IS DISTINCT FROM s1.i AND p_name IS DISTINCT FROM s2.i GROUP BY n.p_brand),
b AS (SELECT DISTINCT p_brand FROM n)
SELECT p_brand, 'r1' AS rule, s1.i AS item, CASE WHEN s1.i IS NULL THEN 'missing' ELSE 'matched' END AS status FROM b LEFT JOIN s1 USING (p_brand)
UNION ALL SELECT p_brand, 'r2', s2.i, CASE WHEN s2.i IS NULL THEN 'missing' ELSE 'matched' END FROM b LEFT JOIN s2 USING (p_brand)
UNION ALL SELECT p_brand, 'r3', coalesce(s3.i, l3.i), CASE WHEN s3.i IS NOT NULL THEN 'matched' WHEN l3.i IS NOT NULL THEN 'loose' ELSE 'missing' END FROM b LEFT JOIN s3 USING (p_brand) LEFT JOIN l3 USING (p_brand)""")
def two_pass_templates(spark: SparkSession, d: str) -> DataFrame:
    """Template rows claim names in order; a second, loose pass serves the rows that the first left."""
    names = load(spark, d, "part").select("p_brand", "p_name").distinct()
    return match.assign_templates(names, "p_brand", "p_name", _ROWS).select("p_brand", "rule", "item", "status")


def _rules(codes: list[tuple[str, str, str, str]]) -> list[gates.Rule]:
    """Rules from (code, level, condition, message) in SQL."""
    spark_text = lambda text: F.expr(text.replace("regexp_matches(", "regexp_like(").replace("AS VARCHAR", "AS STRING"))
    return [gates.Rule(code, level, spark_text(when), spark_text(message)) for code, level, when, message in codes]


def _union(codes: list[tuple[str, str, str, str]], entity: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT {entity} AS {name}, '{level}' AS level, '{code}' AS code, {message} AS message FROM f WHERE {when}" for code, level, when, message in codes)


_POINT_CODES = [
    ("required", "E", "coalesce(name, '') = ''", "'name'"),
    ("bad-type", "E", "type NOT IN ('AI', 'AO', 'BV')", "type"),
    ("unit-prose", "E", "length(unit) > 12", "unit"),
    ("unit-unknown", "W", "unit <> '' AND length(unit) <= 12 AND unit NOT IN ('kW', 'degC', 'percent') AND lower(unit) NOT IN ('pressure', 'flow')", "unit"),
    ("unit-group", "I", "lower(unit) IN ('pressure', 'flow')", "unit"),
    ("name-bleed", "W", "length(name) > 60", "left(name, 20)"),
    ("name-junk", "W", "regexp_matches(name, '^[^A-Za-z]+$')", "name"),
    ("subscript-split", "W", "regexp_matches(name, '(^| )CO 2( |$)')", "name"),
    ("name-is-id", "I", "name = type || '-' || inst", "name"),
    ("points-unaddressed", "I", "inst IS NULL", "'no instance'"),
    ("condition-in-note", "I", "regexp_matches(lower(note), '^(if|only|when) ')", "note"),
    ("raw-address-hidden", "E", "regexp_matches(note, '[34]x[0-9]{4}')", "note"),
]


#: Flat points made from parts, with faults of every kind.
_POINTS = """
SELECT p_brand AS model, CASE p_partkey % 9 WHEN 0 THEN 'XX' WHEN 1 THEN 'AO' WHEN 2 THEN 'BV' ELSE 'AI' END AS type, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size END AS inst,
  CASE p_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN '1234' WHEN 2 THEN 'CO 2 ' || p_name WHEN 3 THEN CASE p_partkey % 9 WHEN 0 THEN 'XX' WHEN 1 THEN 'AO' WHEN 2 THEN 'BV' ELSE 'AI' END || '-' || p_size
    WHEN 4 THEN p_name || ' and a long run of further words of the cell beside it, up to its end' ELSE p_name END AS name,
  CASE p_partkey % 6 WHEN 0 THEN 'kW' WHEN 1 THEN 'furlong' WHEN 2 THEN 'Pressure' WHEN 3 THEN 'see the table below' WHEN 4 THEN '' ELSE 'degC' END AS unit,
  CASE p_partkey % 8 WHEN 0 THEN 'Only with option ' || p_size WHEN 1 THEN 'see 3x0004' ELSE p_type END AS note FROM part"""


@query(f"WITH f AS ({_POINTS}) {_union(_POINT_CODES, 'model', 'model')}")
def point_gate(spark: SparkSession, d: str) -> DataFrame:
    """The row-level codes of the point gate, all in one pass."""
    points = spark.sql(_POINTS.replace("FROM part", "FROM {part}"), part=load(spark, d, "part"))
    return gates.findings(points, F.col("model"), _rules(_POINT_CODES)).select(F.col("entity").alias("model"), "level", "code", "message")


@query(f"""
WITH f AS ({_POINTS}), d AS (SELECT model, type, inst, count(*) AS n FROM f WHERE inst IS NOT NULL GROUP BY model, type, inst HAVING count(*) > 1),
r AS (SELECT model, name, count(DISTINCT inst) AS n FROM f WHERE name <> '' GROUP BY model, name HAVING count(DISTINCT inst) >= 3)
SELECT model, 'E' AS level, 'dup-instance' AS code, type || '-' || inst AS message FROM d
UNION ALL SELECT model, 'W', 'name-repeat', name FROM r
UNION ALL SELECT p_brand, 'E', 'orphan', CAST(count(*) AS VARCHAR) FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO', 'STANDARD', 'LARGE', 'SMALL', 'MEDIUM') GROUP BY p_brand""")
def model_gate(spark: SparkSession, d: str) -> DataFrame:
    """Codes that need a model's points together: repeated instances and names, unknown kinds."""
    part = load(spark, d, "part")
    points = spark.sql(_POINTS.replace("FROM part", "FROM {part}"), part=part)
    again = gates.duplicates(points.filter("inst is not null"), ["model"], ["type", "inst"]).select("model", F.lit("E").alias("level"), F.lit("dup-instance").alias("code"), F.concat_ws("-", "type", F.col("inst").cast("string")).alias("message"))
    names = points.filter("name <> ''").groupBy("model", "name").agg(F.countDistinct("inst").alias("n")).filter("n >= 3").select("model", F.lit("W").alias("level"), F.lit("name-repeat").alias("code"), F.col("name").alias("message"))
    kinds = part.filter(~F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD", "LARGE", "SMALL", "MEDIUM")).groupBy(F.col("p_brand").alias("model")).agg(F.count(F.lit(1)).cast("string").alias("message"))
    return again.unionByName(names).unionByName(kinds.select("model", F.lit("E").alias("level"), F.lit("orphan").alias("code"), "message"))


_INTERFACE_CODES = [
    ("iface-required", "E", "coalesce(title, '') = ''", "'title'"),
    ("iface-family", "E", "family NOT IN ('bacnet', 'modbus', 'lon')", "family"),
    ("iface-status", "E", "status NOT IN ('F', 'O')", "status"),
    ("iface-count", "E", "n_points <> declared AND n_points > 0", "n_points || ' of ' || declared"),
    ("iface-empty", "W", "n_points = 0", "'no point'"),
    ("iface-protocol", "E", "family = 'lon' AND status = 'F'", "family"),
    ("iface-excluded", "I", "regexp_matches(title, '^1-')", "title"),
    ("iface-ok", "I", "n_points = declared AND family IN ('bacnet', 'modbus')", "CAST(n_points AS VARCHAR)"),
]


_INTERFACES = """
SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'bacnet' WHEN 1 THEN 'modbus' WHEN 2 THEN 'lon' WHEN 3 THEN 'bacnet' ELSE 'n2' END AS family, o_orderstatus AS status,
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS title, coalesce(n, 0) AS n_points, CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE coalesce(n, 0) END AS declared
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""


@query(f"WITH f AS ({_INTERFACES}) {_union(_INTERFACE_CODES, 'CAST(id AS VARCHAR)', 'interface')}")
def interface_gate(spark: SparkSession, d: str) -> DataFrame:
    """The codes of the interface gate, all in one pass over the interfaces."""
    text = _INTERFACES.replace("FROM orders", "FROM {orders}").replace("FROM lineitem", "FROM {lineitem}")
    interfaces = spark.sql(text, orders=load(spark, d, "orders"), lineitem=load(spark, d, "lineitem"))
    return gates.findings(interfaces, F.col("id"), _rules(_INTERFACE_CODES)).select(F.col("entity").alias("interface"), "level", "code", "message")


_UNIT_FIELDS = ("cooling", "power", "voltage")
_UNIT_CODES = [
    ("units-class", "E", "class NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')", "class"),
    ("units-missing", "E", "n_fields = 0 AND status = 'verified'", "'no field'"),
    ("units-none", "I", "n_fields = 0 AND status <> 'verified'", "'no field'"),
    ("units-status", "E", "status NOT IN ('verified', 'extracted', 'manual')", "status"),
    ("units-field", "E", "extra <> ''", "extra"),
    ("units-blob", "E", "length(value) > 20", "value"),
    ("units-source", "E", "source IS NULL", "'no source'"),
    ("units-stale", "W", "balance < 0", "CAST(unit_no AS VARCHAR)"),
    ("units-ok", "I", "n_fields > 0 AND status = 'verified' AND source IS NOT NULL", "CAST(n_fields AS VARCHAR)"),
]
_UNITS_SQL = """
SELECT c_custkey AS unit_no, c_mktsegment AS class, CASE c_custkey % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'extracted' WHEN 2 THEN 'manual' ELSE 'guess' END AS status, c_acctbal AS balance,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS source, c_name || CASE WHEN c_custkey % 11 = 0 THEN ' and more text' ELSE '' END AS value,
  CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'cooling,colour' ELSE 'power,voltage' END AS fields, CASE c_custkey % 3 WHEN 0 THEN 0 ELSE 2 END AS n_fields FROM customer"""


@query(f"WITH f AS (SELECT *, CASE WHEN fields = 'cooling,colour' THEN 'colour' ELSE '' END AS extra FROM ({_UNITS_SQL})) {_union(_UNIT_CODES, 'CAST(unit_no AS VARCHAR)', 'unit')}")
def unit_gate(spark: SparkSession, d: str) -> DataFrame:
    """The codes of the curated-unit gate."""
    units = spark.sql(_UNITS_SQL.replace("FROM customer", "FROM {customer}"), customer=load(spark, d, "customer"))
    named = F.filter(F.split("fields", ","), lambda x: x != "")
    units = units.withColumn("extra", F.array_join(F.array_except(named, F.array(*map(F.lit, _UNIT_FIELDS))), ","))
    return gates.findings(units, F.col("unit_no"), _rules(_UNIT_CODES)).select(F.col("entity").alias("unit"), "level", "code", "message")


@query("""
WITH a AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)
SELECT doc_id, length(text) <= 60 AND len(regexp_extract_all(text, '[0-9]+([.,][0-9]+)*')) <= 8 AS plausible FROM a""")
def plausible_values(spark: SparkSession, d: str) -> DataFrame:
    """Cells short and plain enough to be one value."""
    return load(spark, d, "documents").filter("text is not null").select("doc_id", S.plausible_value(F.col("text")).alias("plausible"))


@query("""
WITH n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'AI' WHEN 1 THEN 'NV' WHEN 2 THEN 'MB' WHEN 3 THEN 'NCI' ELSE '??' END AS type, p_size AS inst, CASE p_partkey % 3 WHEN 0 THEN 'degF' WHEN 1 THEN 'kPa' ELSE '%' END AS unit FROM part)
SELECT p_partkey, CASE type WHEN 'AI' THEN 'bacnet' WHEN 'NV' THEN 'lon' WHEN 'NCI' THEN 'lon' WHEN 'MB' THEN 'modbus' END AS block,
  CASE WHEN type = 'AI' THEN inst END AS bacnet_instance, CASE WHEN type IN ('NV', 'NCI') THEN inst END AS lon_index, CASE WHEN type = 'MB' THEN inst END AS modbus_address,
  CASE WHEN unit IN ('degF', '%') THEN unit END AS unit_ip, CASE WHEN unit IN ('kPa', '%') THEN unit END AS unit_si, CASE WHEN type = '??' THEN 'type' ELSE '' END AS gaps FROM n""")
def routed_points(spark: SparkSession, d: str) -> DataFrame:
    """Flat points routed to blocks by their type, units to the sides of their system, what has no place to gaps."""
    k = F.col("p_partkey")
    kind = F.when(k % 5 == 0, "AI").when(k % 5 == 1, "NV").when(k % 5 == 2, "MB").when(k % 5 == 3, "NCI").otherwise("??")
    unit = F.when(k % 3 == 0, "degF").when(k % 3 == 1, "kPa").otherwise("%")
    flat = load(spark, d, "part").select("p_partkey", kind.alias("type"), F.col("p_size").alias("inst"), unit.alias("unit"))
    return flat.select("p_partkey", S.routed(F.col("type"), F.col("inst"), F.col("unit")).alias("x")).select("p_partkey", "x.*")


@query("""
WITH old AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS kinds FROM events WHERE event_id % 2 = 0 GROUP BY user_id), new AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS kinds FROM events WHERE event_id % 3 = 0 GROUP BY user_id)
SELECT user_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(old.kinds, []), coalesce(new.kinds, [])))), ',') AS synced, array_to_string(list_sort(list_intersect(coalesce(old.kinds, []), coalesce(new.kinds, []))), ',') AS pruned
FROM old FULL JOIN new USING (user_id)""")
def synced_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases old and new together, and what a requested prune leaves."""
    kinds = lambda n, name: load(spark, d, "events").filter(F.col("event_id") % n == 0).groupBy("user_id").agg(F.collect_set("event_type").alias(name))
    both = kinds(2, "old").join(kinds(3, "new"), "user_id", "full_outer")
    old, new = (F.coalesce(c, F.array().cast("array<string>")) for c in ("old", "new"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return both.select("user_id", joined(F.array_union(old, new)).alias("synced"), joined(F.array_intersect(old, new)).alias("pruned"))


@query("""
WITH l AS (SELECT l_orderkey AS code, l_linenumber AS n, l_quantity AS a, l_discount AS b, l_tax AS c, l_returnflag = 'A' AS continued FROM lineitem)
SELECT code, CASE WHEN bool_and(continued) THEN 'continued only' WHEN max(n) <= 3 AND count(DISTINCT a) <= 1 THEN 'sparse' WHEN count(DISTINCT a) > 1 OR count(DISTINCT b) > 1 THEN 'conflict' ELSE 'same' END AS verdict, count(*) AS n FROM l GROUP BY code""")
def duplicate_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one code: in conflict, sparse, from continued tables only, or the same."""
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("code"), "l_linenumber", "l_quantity", "l_discount", (F.col("l_returnflag") == "A").alias("continued"))
    seen = rows.groupBy("code").agg(F.bool_and("continued").alias("only"), F.max("l_linenumber").alias("fields"), F.countDistinct("l_quantity").alias("a"), F.countDistinct("l_discount").alias("b"), F.count(F.lit(1)).alias("n"))
    verdict = F.when(F.col("only"), "continued only").when((F.col("fields") <= 3) & (F.col("a") <= 1), "sparse").when((F.col("a") > 1) | (F.col("b") > 1), "conflict").otherwise("same")
    return seen.select("code", verdict.alias("verdict"), "n")
