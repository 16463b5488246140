"""Queries for headers and blocks, further cell functions, golden records and viewer rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions import scalar as S
from tessera.operators import headers, order
from tessera.plans.registry import query
from tessera.sources.tables import load

_ALIASES = [("name", "widget", 1), ("name", "gear", 2), ("unit", "red", 1), ("unit", "cold", 2), ("unit", "gear", 3)]


@query(f"""
WITH a(field, alias, ord) AS (VALUES {", ".join(f"('{f}', '{x}', {o})" for f, x, o in _ALIASES)}),
c AS (SELECT p_brand, p_partkey, replace(lower(p_name), ' ', '') AS cell FROM part),
h AS (SELECT p_brand, field, p_partkey, row_number() OVER (PARTITION BY p_brand, field ORDER BY ord, p_partkey) AS r FROM c JOIN a ON contains(cell, alias))
SELECT p_brand, field, p_partkey FROM h WHERE r = 1""")
def column_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Header cells resolved to fields by alias order, then position."""
    aliases = spark.createDataFrame(_ALIASES, "field string, alias string, ord int")
    return headers.resolve_columns(load(spark, d, "part"), ["p_brand"], "p_partkey", "p_name", aliases)


def _lacking(target: str) -> str:
    letters = sorted(set(target))
    return " + ".join(f"greatest({target.count(x)} - (length(b) - length(replace(b, '{x}', ''))), 0)" for x in letters)


@query(f"""
WITH t AS (SELECT p_name, regexp_replace(lower(reverse(p_name)), '[^a-z]', '', 'g') AS b FROM part)
SELECT p_name, ({_lacking("coldgear")}) <= 1 AND length(b) <= 16 AS scrambled, count(*) AS n FROM t GROUP BY 1, 2""")
def scrambled_headers(spark: SparkSession, d: str) -> DataFrame:
    """Headers recognised by their letters whatever the order."""
    p = load(spark, d, "part").select("p_name", headers.is_scrambled(F.reverse("p_name"), "cold gear").alias("scrambled"))
    return p.groupBy("p_name", "scrambled").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH h AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS a1, split_part(p_name, ' ', 2) AS b1, p_type AS a2, CASE WHEN p_size % 2 = 0 THEN '' ELSE split_part(p_name, ' ', 2) END AS b2 FROM part)
SELECT p_partkey, a1 || ' ' || a2 AS c1, b1 AS c2 FROM h""")
def stacked_headers(spark: SparkSession, d: str) -> DataFrame:
    """Two header rows joined column by column without repeats."""
    first, second = (F.split_part("p_name", F.lit(" "), F.lit(k)) for k in (1, 2))
    rows = F.array(F.array(first, second), F.array(F.col("p_type"), F.when(F.col("p_size") % 2 == 0, "").otherwise(second)))
    h = load(spark, d, "part").select("p_partkey", headers.merge_stacked(rows).alias("h"))
    return h.select("p_partkey", F.col("h")[0].alias("c1"), F.col("h")[1].alias("c2"))


@query("""
SELECT l_orderkey, count(*) FILTER (l_quantity > 25 AND l_discount < 0.05) >= 2 AS swapped FROM lineitem GROUP BY l_orderkey""")
def repaired_headers(spark: SparkSession, d: str) -> DataFrame:
    """Tables whose columns hold each other's kind of value in two rows or more."""
    return headers.swapped_columns(load(spark, d, "lineitem"), ["l_orderkey"], F.col("l_quantity") > 25, F.col("l_discount") < 0.05)


@query("""
SELECT c_custkey, CASE WHEN lower(c_name) <> lower('Customer#' || c_custkey) THEN c_name END AS raw FROM customer""")
def raw_differences(spark: SparkSession, d: str) -> DataFrame:
    """The raw cell only where it differs from the shown one."""
    shown = F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string"))
    return load(spark, d, "customer").select("c_custkey", headers.raw_if_different(F.col("c_name"), shown).alias("raw"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
b AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^(The|Le|Der|Los) ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS block FROM l)
SELECT doc_id, CAST(block AS BIGINT) AS block, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM b GROUP BY doc_id, block""")
def parameter_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Lines cut into blocks at header lines."""
    lines = load(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    b = headers.blocks(lines, ["doc_id"], "pos", F.col("line").rlike("^(The|Le|Der|Los) "))
    return b.groupBy("doc_id", F.col("block").cast("long").alias("block")).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query("""
WITH n AS (SELECT DISTINCT replace(c_name, '#', '') AS name FROM customer), w AS (SELECT DISTINCT c_name AS word FROM customer UNION SELECT DISTINCT s_name FROM supplier),
u AS (SELECT regexp_replace(lower(word), '[^a-z0-9]', '', 'g') AS k, min(word) AS word FROM w GROUP BY 1 HAVING count(*) = 1)
SELECT name, coalesce(word, name) AS restored FROM n LEFT JOIN u ON k = regexp_replace(lower(name), '[^a-z0-9]', '', 'g')""")
def restored_names(spark: SparkSession, d: str) -> DataFrame:
    """Lost marks put back where exactly one page word fits."""
    c = load(spark, d, "customer").select("c_name")
    words = c.select(F.col("c_name").alias("word")).unionByName(load(spark, d, "supplier").select(F.col("s_name").alias("word")))
    return headers.restore_typography(c.select(F.replace("c_name", F.lit("#"), F.lit("")).alias("name")), "name", words, "word")


@query("""
WITH f(idx, factor) AS (VALUES (0, '1'), (1, '0.1'), (2, '1/60'), (3, '10'))
SELECT p_partkey, p_size AS raw, CASE p_partkey % 5 WHEN 0 THEN p_size * 1.0::DOUBLE WHEN 1 THEN p_size * 0.1::DOUBLE WHEN 2 THEN p_size * (1.0::DOUBLE / 60.0::DOUBLE) WHEN 3 THEN p_size * 10.0::DOUBLE END AS value FROM part""")
def scaled_values(spark: SparkSession, d: str) -> DataFrame:
    """Raw values by the factor of a conversion index; an unknown index gives none."""
    f = spark.createDataFrame([(0, "1"), (1, "0.1"), (2, "1/60"), (3, "10")], "idx int, factor string")
    parts = F.split("factor", "/")
    scale = parts[0].cast("double") / F.coalesce(F.try_element_at(parts, F.lit(2)).cast("double"), F.lit(1.0))
    p = load(spark, d, "part").withColumn("idx", (F.col("p_partkey") % 5).cast("int"))
    return p.join(F.broadcast(f.select("idx", scale.alias("scale"))), "idx", "left").select("p_partkey", F.col("p_size").alias("raw"), (F.col("p_size") * F.col("scale")).alias("value"))


@query("""
SELECT n_nationkey, list_reduce(list_transform(string_split(upper(n_name) || ' ab', ''), lambda c: CASE WHEN ascii(c) > 32 THEN chr(ascii(c) - 1) ELSE c END), lambda a, b: a || b) AS decoded FROM nation""")
def shifted_names(spark: SparkSession, d: str) -> DataFrame:
    """Text of a font whose code points above the blank are shifted by one."""
    return load(spark, d, "nation").select("n_nationkey", S.shifted_back(F.concat(F.upper("n_name"), F.lit(" ab"))).alias("decoded"))


@query("""
WITH t AS (SELECT p_partkey, p_name || CASE WHEN p_size % 3 = 0 THEN ' (Continued)' ELSE '' END AS title FROM part)
SELECT regexp_replace(title, '(?i)\\s*\\(continued\\)\\s*$', '') AS base, count(*) AS n, count(*) FILTER (regexp_matches(title, '(?i)\\(continued\\)\\s*$')) AS continued FROM t GROUP BY 1""")
def continued_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles without their continuation mark."""
    title = F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" (Continued)"))).otherwise(F.col("p_name"))
    t = load(spark, d, "part").select(title.alias("title"))
    return t.groupBy(L.base_title(F.col("title")).alias("base")).agg(F.count(F.lit(1)).alias("n"), F.count_if(L.is_continued(F.col("title"))).alias("continued"))


@query("""
WITH n AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '0: ' || p_type || ' 1: off' WHEN 1 THEN p_name || ' 5 = ' || p_type ELSE p_type END AS note FROM part)
SELECT p_partkey, trim(regexp_replace(regexp_replace(note, '[0-9]+\\s*[:=]\\s*[A-Za-z]*', ' ', 'g'), ' +', ' ', 'g')) AS text FROM n""")
def match_texts(spark: SparkSession, d: str) -> DataFrame:
    """Numbered options taken out of a note before it is matched."""
    k = F.col("p_size") % 3
    note = F.when(k == 0, F.concat(F.lit("0: "), "p_type", F.lit(" 1: off"))).when(k == 1, F.concat("p_name", F.lit(" 5 = "), "p_type")).otherwise(F.col("p_type"))
    return load(spark, d, "part").select("p_partkey", S.clean_text(F.regexp_replace(note, r"[0-9]+\s*[:=]\s*[A-Za-z]*", " ")).alias("text"))


@query("""
WITH c AS (SELECT l_orderkey, list_sort(list_distinct(list(l_linenumber))) AS codes, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, len(codes) = hi - lo + 1 AND len(codes) >= 2 AS complete FROM c""")
def complete_enums(spark: SparkSession, d: str) -> DataFrame:
    """Enumerations that explain every code of their range."""
    c = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("codes"))
    whole = F.forall(F.sequence(F.array_min("codes"), F.array_max("codes")), lambda x: F.array_contains("codes", x))
    return c.select("l_orderkey", (whole & (F.size("codes") >= 2)).alias("complete"))


@query("""
WITH p AS (SELECT s_suppkey, s_nationkey, CASE s_suppkey % 4 WHEN 0 THEN s_nationkey || ' Ton' WHEN 1 THEN 'EER: ' || s_nationkey ELSE CAST(s_nationkey AS VARCHAR) END AS value FROM supplier)
SELECT s_suppkey, regexp_replace(regexp_replace(value, '^EER:? *', ''), '^([0-9.]+) Ton$', '\\1 Tons') AS value, s_suppkey % 3 <> 0 AS accepted FROM p""")
def normalised_entries(spark: SparkSession, d: str) -> DataFrame:
    """Notation of proposals made alike; rows without a class are refused."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    raw = F.when(k % 4 == 0, F.concat(n, F.lit(" Ton"))).when(k % 4 == 1, F.concat(F.lit("EER: "), n)).otherwise(n)
    value = F.regexp_replace(F.regexp_replace(raw, "^EER:? *", ""), r"^([0-9.]+) Ton$", "$1 Tons")
    return load(spark, d, "supplier").select("s_suppkey", value.alias("value"), (k % 3 != 0).alias("accepted"))


@query("""
WITH r AS (SELECT l_partkey, 1 AS rung, max(l_extendedprice) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 UNION ALL SELECT l_partkey, 2, max(l_extendedprice) FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1
  UNION ALL SELECT l_partkey, 3, max(l_extendedprice) FROM lineitem GROUP BY 1),
w AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY rung) AS k FROM r)
SELECT l_partkey, rung, v FROM w WHERE k = 1""")
def recognition_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Each unit's value from the first rung of a ladder that gives one."""
    li = load(spark, d, "lineitem").groupBy("l_partkey").agg(*(F.max(F.when(c, F.col("l_extendedprice"))).alias(f"r{k}") for k, c in ((1, F.col("l_returnflag") == "R"), (2, F.col("l_returnflag") == "A"), (3, F.lit(True)))))
    rung = F.when(F.col("r1").isNotNull(), 1).when(F.col("r2").isNotNull(), 2).otherwise(3)
    return li.select("l_partkey", rung.alias("rung"), F.coalesce("r1", "r2", "r3").alias("v"))


@query("""
WITH k AS (SELECT unnest(string_split(p_name, ' ')) AS label, p_brand FROM part)
SELECT label, count(DISTINCT p_brand) AS n_models, count(*) AS n FROM k WHERE NOT regexp_matches(label, 'widget|gear') GROUP BY label""")
def proposed_features(spark: SparkSession, d: str) -> DataFrame:
    """Labels that no pattern covers, by distinct models."""
    k = load(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("label"), "p_brand").filter(~F.col("label").rlike("widget|gear"))
    return k.groupBy("label").agg(F.countDistinct("p_brand").alias("n_models"), F.count(F.lit(1)).alias("n"))


@query("""
WITH g AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1, 2),
w AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM g)
SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n_points, min(lo) AS first_page, max(hi) AS last_page, max(CASE WHEN r = 1 THEN o_orderpriority END) AS family FROM w GROUP BY o_custkey""")
def interface_build(spark: SparkSession, d: str) -> DataFrame:
    """Interfaces with their page span, point count and dominant family."""
    g = load(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    return g.groupBy("o_custkey").agg(F.sum("n").alias("n_points"), F.min("lo").alias("first_page"), F.max("hi").alias("last_page"), F.min_by("o_orderpriority", F.struct(-F.col("n"), "o_orderpriority")).alias("family"))


@query("""
SELECT o_custkey, max(o_orderdate) FILTER (o_orderstatus = 'F') < max(o_orderdate) AS stale FROM orders GROUP BY o_custkey HAVING count(*) FILTER (o_orderstatus = 'F') > 0""")
def stale_artefacts(spark: SparkSession, d: str) -> DataFrame:
    """Artefacts older than their newest input."""
    o = load(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("made"), F.max("o_orderdate").alias("newest"))
    return o.filter("made is not null").select("o_custkey", (F.col("made") < F.col("newest")).alias("stale"))


@query("""
SELECT source, count(DISTINCT regexp_extract(line, '^[A-Za-z]+ [a-z]+')) AS n_rows FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '^[A-Za-z]+ [a-z]+') GROUP BY source""")
def extraction_yardstick(spark: SparkSession, d: str) -> DataFrame:
    """Distinct row-like starts of lines whatever the header."""
    lines = load(spark, d, "documents").select("source", F.explode(F.split("text", "\n")).alias("line"))
    start = F.regexp_extract("line", "^[A-Za-z]+ [a-z]+", 0)
    return lines.filter(start != "").groupBy("source").agg(F.countDistinct(start).alias("n_rows"))


@query("""
WITH s AS (SELECT p_brand, p_partkey, (CASE WHEN p_type = 'PROMO' THEN 50 ELSE 0 END) + (CASE WHEN contains(p_name, 'red') THEN 30 ELSE 0 END) + (CASE WHEN p_size > 25 THEN 6 ELSE 0 END) AS score FROM part)
SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS INT) AS place FROM s""")
def table_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Every table of a unit with its additive score and place; none is dropped (N05, without the category cascade)."""
    score = F.when(F.col("p_type") == "PROMO", 50).otherwise(0) + F.when(F.contains("p_name", F.lit("red")), 30).otherwise(0) + F.when(F.col("p_size") > 25, 6).otherwise(0)
    s = load(spark, d, "part").select("p_brand", "p_partkey", score.alias("score"))
    w = Window.partitionBy("p_brand").orderBy(F.desc("score"), "p_partkey")
    return s.withColumn("place", F.row_number().over(w))


@query("""
WITH s AS (SELECT p_brand, p_partkey, (CASE WHEN p_type = 'PROMO' THEN 50 ELSE 0 END) + (CASE WHEN contains(p_name, 'red') THEN 30 ELSE 0 END) + (CASE WHEN p_size > 25 THEN 6 ELSE 0 END) AS score FROM part),
w AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS r FROM s)
SELECT p_brand, p_partkey, score, CAST(r AS INT) AS place FROM w WHERE score > 0""")
def table_relevance(spark: SparkSession, d: str) -> DataFrame:
    """The rows of table_ranking that score at all."""
    return table_ranking(spark, d).filter("score > 0")


@query("""
SELECT coalesce(lang, 'all') AS lang, count(*) AS n, count(DISTINCT source) AS n_sources FROM documents GROUP BY GROUPING SETS ((lang), ())""")
def totals_and_parts(spark: SparkSession, d: str) -> DataFrame:
    """Totals beside the parts they are made of."""
    text = "SELECT coalesce(lang, 'all') AS lang, count(*) AS n, count(DISTINCT source) AS n_sources FROM {documents} GROUP BY GROUPING SETS ((lang), ())"
    return spark.sql(text, documents=load(spark, d, "documents"))


@query("""
WITH e AS (SELECT 'p' || p_partkey AS src, 'b' || p_brand AS dst, 'vendor' AS kind FROM part UNION ALL SELECT DISTINCT 's' || l_suppkey, 'p' || l_partkey, 'supplies' FROM lineitem)
SELECT kind, count(*) AS n_edges, count(DISTINCT src) AS n_sources, count(DISTINCT dst) AS n_targets FROM e GROUP BY kind""")
def vault_edges(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges of the catalogue as tables."""
    vendor = load(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("src"), F.concat(F.lit("b"), "p_brand").alias("dst"), F.lit("vendor").alias("kind"))
    li = load(spark, d, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"), F.lit("supplies").alias("kind")).distinct()
    return vendor.unionByName(li).groupBy("kind").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("src").alias("n_sources"), F.countDistinct("dst").alias("n_targets"))


@query("""
WITH s AS (SELECT user_id, event_type, ts, value, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS next_ts, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events)
SELECT user_id, event_type, count(*) AS n_versions, count(*) FILTER (next_ts IS NULL) AS n_open, count(*) FILTER (prev IS NOT NULL AND prev <> value) AS n_changes FROM s GROUP BY user_id, event_type""")
def snapshot_versions(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping snapshots of one key as versions (M snapshot series, J17)."""
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    s = load(spark, d, "events").withColumn("next_ts", F.lead("ts").over(w)).withColumn("prev", F.lag("value").over(w))
    changed = F.col("prev").isNotNull() & (F.col("prev") != F.col("value"))
    return s.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_versions"), F.count_if(F.col("next_ts").isNull()).alias("n_open"), F.count_if(changed).alias("n_changes"))


@query("""
WITH RECURSIVE p AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 9 THEN c_custkey // 10 END AS parent FROM customer),
t AS (SELECT id, 1 AS depth FROM p WHERE parent IS NULL UNION ALL SELECT p.id, t.depth + 1 FROM p JOIN t ON p.parent = t.id WHERE t.depth < 3)
SELECT depth, count(*) AS n, CAST(min(id) AS BIGINT) AS first_id FROM t GROUP BY depth""")
def category_tree(spark: SparkSession, d: str) -> DataFrame:
    """A category tree down to depth three (EP-01 to EP-04)."""
    from tessera.operators.graph import expand

    key = F.col("c_custkey")
    nodes = load(spark, d, "customer").select(key.alias("id"), F.when(key > 9, F.floor(key / 10)).alias("parent"))
    roots = nodes.filter("parent is null").select(F.col("id").cast("string").alias("node"))
    edges = nodes.filter("parent is not null").select(F.col("parent").cast("string").alias("parent"), F.col("id").cast("string").alias("child"))
    t = expand(edges, roots, 2)
    return t.groupBy((F.col("depth") + 1).alias("depth")).agg(F.count(F.lit(1)).alias("n"), F.min(F.col("node").cast("long")).alias("first_id"))


@query("""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, unnest(range(0, len(string_split(text, ' ')))) AS i FROM conversations),
f AS (SELECT conv_id, w, min(turn * 1000000 + i) AS pos FROM l WHERE regexp_matches(w, '^[A-Z][a-z]+$') GROUP BY conv_id, w)
SELECT conv_id, count(*) AS n_names, arg_min(left(w, 24), pos) AS first_name FROM f GROUP BY conv_id""")
def segment_names(spark: SparkSession, d: str) -> DataFrame:
    """Distinct names in order of appearance, cut to 24 characters."""
    words = load(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("i", "w")).filter(F.col("w").rlike("^[A-Z][a-z]+$"))
    firsts = words.groupBy("conv_id", "w").agg(F.min(F.col("turn") * 1000000 + F.col("i")).alias("at"))
    return firsts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_names"), F.min_by(F.substring("w", 1, 24), "at").alias("first_name"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_linestatus || ' on' WHEN l_returnflag = 'N' THEN 'no ' || l_linestatus ELSE l_linestatus END AS zero, CASE WHEN l_returnflag = 'N' THEN l_linestatus ELSE CASE WHEN l_returnflag = 'A' THEN l_linestatus || ' on' ELSE l_linestatus END END AS chosen FROM lineitem""")
def bit_names(spark: SparkSession, d: str) -> DataFrame:
    """Of a bit's two labels the one that is not negated."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    zero = F.when(flag == "A", F.concat(status, F.lit(" on"))).when(flag == "N", F.concat(F.lit("no "), status)).otherwise(status)
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", zero.alias("zero"), L.positive_label(zero).alias("chosen"))


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus <> 'O' AS finished, CASE WHEN o_orderstatus = 'O' THEN CAST(count(*) FILTER (o_orderstatus = 'O') OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS place FROM orders""")
def verification_list(spark: SparkSession, d: str) -> DataFrame:
    """Every item of each model: open ones with their place, finished ones kept and flagged."""
    open_ = F.col("o_orderstatus") == "O"
    n = order.numbered(load(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], open_, "place")
    return n.select("o_custkey", "o_orderkey", (~open_).alias("finished"), F.col("place").cast("long").alias("place"))


@query("""
WITH a AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders WHERE o_orderstatus = 'O')
SELECT o_custkey, CAST(place AS BIGINT) AS place, o_orderkey FROM a""")
def verification_queue(spark: SparkSession, d: str) -> DataFrame:
    """The open items of each model in their order; verification_list has the finished ones too."""
    n = order.numbered(load(spark, d, "orders").filter("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderkey"], F.lit(True), "place")
    return n.select("o_custkey", F.col("place").cast("long").alias("place"), "o_orderkey")


@query("""
SELECT n_name, r_name, count(c_custkey) AS n_customers FROM nation LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, r_name""")
def lookup_join(spark: SparkSession, d: str) -> DataFrame:
    """Left lookups of declared keys."""
    nation, region, customer = (load(spark, d, t) for t in ("nation", "region", "customer"))
    n = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").join(customer.select("c_custkey", "c_nationkey"), nation.n_nationkey == F.col("c_nationkey"), "left")
    return n.groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("n_customers"))


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'nci' ELSE 'nvi' END || l_linestatus AS snvt, l_linenumber % 2 = 0 AS send FROM lineitem)
SELECT CASE WHEN starts_with(snvt, 'nci') THEN 'NCI' ELSE 'NV' END AS type, CASE WHEN send THEN 'Send' ELSE 'Recv' END AS direction, count(*) AS n FROM v GROUP BY 1, 2""")
def network_variables(spark: SparkSession, d: str) -> DataFrame:
    """Network variables typed by their name, directed by their header."""
    snvt = F.concat(F.when(F.col("l_returnflag") == "R", "nci").otherwise("nvi"), "l_linestatus")
    kind = F.when(F.startswith(snvt, F.lit("nci")), "NCI").otherwise("NV")
    direction = F.when(F.col("l_linenumber") % 2 == 0, "Send").otherwise("Recv")
    return load(spark, d, "lineitem").groupBy(kind.alias("type"), direction.alias("direction")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1""")
def json_documents(spark: SparkSession, d: str) -> DataFrame:
    """JSON documents read by a declared schema."""
    parsed = load(spark, d, "events").select("user_id", F.from_json("props", "k bigint").alias("x"))
    return parsed.groupBy(F.col("x.k").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users"))


@query("""
SELECT l_suppkey, l_partkey, rank() OVER w AS place, round(percent_rank() OVER w, 9) AS share, ntile(4) OVER (PARTITION BY l_suppkey ORDER BY q DESC, l_partkey) AS quarter
FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) WINDOW w AS (PARTITION BY l_suppkey ORDER BY q DESC)""")
def ranking_windows(spark: SparkSession, d: str) -> DataFrame:
    """Ranks, shares and quarters inside a group."""
    q = load(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("q"))
    quarter = F.ntile(4).over(Window.partitionBy("l_suppkey").orderBy(F.desc("q"), "l_partkey"))
    return q.select("l_suppkey", "l_partkey", F.rank().over(w).cast("long").alias("place"), F.round(F.percent_rank().over(w), 9).alias("share"), quarter.cast("long").alias("quarter"))


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'kW' WHEN 1 THEN 'A' WHEN 2 THEN 'V' WHEN 3 THEN 'rpm' END AS unit FROM part""")
def label_units(spark: SparkSession, d: str) -> DataFrame:
    """Units from labels: brackets, a comma or a key word."""
    k = F.col("p_size") % 5
    label = F.when(k == 0, F.concat("p_name", F.lit(" (kW)"))).when(k == 1, "Rated current").when(k == 2, F.concat("p_type", F.lit(", V"))).when(k == 3, "Speed [rpm]").otherwise("p_name")
    return load(spark, d, "part").select("p_partkey", S.label_unit(label).alias("unit"))


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'range' WHEN 1 THEN 'states' ELSE 'note' END AS kind, CASE WHEN p_size % 3 = 0 THEN p_size::DOUBLE END AS low, CASE WHEN p_size % 3 = 0 THEN p_size + 5.0::DOUBLE END AS high, CASE WHEN p_size % 3 = 0 THEN 0.1::DOUBLE END AS scale FROM part""")
def explained_values(spark: SparkSession, d: str) -> DataFrame:
    """Value cells as states, one range with a scale, or a note."""
    k, size = F.col("p_size") % 3, F.col("p_size")
    cell = F.when(k == 0, F.concat(size.cast("string"), F.lit(" ~ "), (size + 5).cast("string"), F.lit(" x10"))).when(k == 1, F.concat(F.lit("0 = Off / 1 = "), "p_type")).otherwise(F.concat(F.lit("1~2 / "), "p_name"))
    return load(spark, d, "part").select("p_partkey", S.explained_value(cell).alias("x")).select("p_partkey", "x.kind", "x.low", "x.high", "x.scale")


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'CO' || (p_size % 10) || ' ' || lower(p_type) || ' NO' || ((p_size + 3) % 10) ELSE 'CO ' || lower(p_type) || ' NO' END AS text FROM part""")
def subscript_rejoin(spark: SparkSession, d: str) -> DataFrame:
    """Digits of a line of their own put back where their numbers agree."""
    size = F.col("p_size")
    text = F.concat(F.lit("CO "), F.lower("p_type"), F.lit(" NO"))
    digits = F.when(size % 2 == 0, F.concat((size % 10).cast("string"), F.lit(" "), ((size + 3) % 10).cast("string"))).otherwise("7")
    return load(spark, d, "part").select("p_partkey", S.rejoin_subscripts(text, digits, ["CO", "NO"]).alias("text"))


@query("""
SELECT s_suppkey, s_name || CASE WHEN s_acctbal > 5000 THEN ' / large' WHEN s_acctbal < 0 THEN ' / debt' ELSE '' END AS label, CASE WHEN s_nationkey < 5 THEN 'chiller' WHEN s_nationkey < 10 THEN 'rooftop' ELSE 'other' END AS subtype FROM supplier""")
def selector_labels(spark: SparkSession, d: str) -> DataFrame:
    """Display labels and subtypes by cascades."""
    label = L.display_label(F.col("s_name"), [(F.col("s_acctbal") > 5000, "large"), (F.col("s_acctbal") < 0, "debt")])
    subtype = L.cascade([(F.col("s_nationkey") < 5, "chiller"), (F.col("s_nationkey") < 10, "rooftop")], "other")
    return load(spark, d, "supplier").select("s_suppkey", label.alias("label"), subtype.alias("subtype"))


@query("""
SELECT CASE WHEN o_orderpriority LIKE '1%' AND o_orderstatus <> 'P' THEN 'verified' WHEN o_orderstatus = 'P' THEN 'manual' ELSE 'extracted' END AS status, count(*) AS n, count(DISTINCT o_custkey) AS n_models FROM orders GROUP BY 1""")
def promoted_status(spark: SparkSession, d: str) -> DataFrame:
    """Proposals promoted to verified for chosen codes; confirmed ones keep their status."""
    o = load(spark, d, "orders")
    stored = F.when(F.col("o_orderstatus") == "P", "manual").otherwise("extracted")
    status = L.promoted(stored, F.startswith("o_orderpriority", F.lit("1")))
    return o.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_models"))


@query("""
WITH m AS (SELECT p_brand, p_type, min(p_size) AS lo, max(p_size) AS hi, count(*) AS n FROM part GROUP BY 1, 2),
w AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_type) AS r FROM m)
SELECT p_brand, p_type, CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || ' – ' || hi END AS span, n FROM w WHERE r <= 8""")
def matrix_summary(spark: SparkSession, d: str) -> DataFrame:
    """The first eight quantities of a matrix with their value ranges."""
    m = load(spark, d, "part").groupBy("p_brand", "p_type").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"), F.count(F.lit(1)).alias("n"))
    first = m.withColumn("r", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_type"))).filter("r <= 8")
    span = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat(F.col("lo").cast("string"), F.lit(" – "), F.col("hi").cast("string")))
    return first.select("p_brand", "p_type", span.alias("span"), "n")
