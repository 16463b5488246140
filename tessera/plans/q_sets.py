"""Queries over tag sets that hand tags down, names restored from their page, workbooks and linked notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import graph, headers
from tessera.plans.registry import query
from tessera.scratch import scratch
from tessera.sources.sheets import register
from tessera.sources.tables import load


@query("""
WITH RECURSIVE p AS (SELECT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS n, lower(p_type) AS t FROM part),
nouns AS (SELECT n, coalesce(lead(n) OVER (ORDER BY n), min(n) OVER ()) AS nxt FROM (SELECT DISTINCT n FROM p)),
names AS (SELECT a, n FROM (SELECT a, n, count(*) AS k FROM p GROUP BY a, n) WHERE k >= (SELECT count(*) / count(DISTINCT a || ' ' || n) FROM p)),
f AS (
  SELECT a || '-' || n AS root, a, n, CAST(NULL AS VARCHAR) AS carry, [a || '-' || n] AS chain, [] :: VARCHAR[] AS path, 0 AS depth FROM names
  UNION ALL
  SELECT f.root, m.a, o.nxt, coalesce(f.a, f.carry), list_append(f.chain, coalesce(m.a || '-' || m.n, o.nxt)), list_append(f.path, array_to_string(list_sort(list_filter([f.a, o.nxt, 'equip'], lambda x: x IS NOT NULL)), ' ')), f.depth + 1
  FROM f JOIN nouns o ON o.n = f.n LEFT JOIN names m ON m.a = f.a AND m.n = o.nxt
  WHERE f.depth < 12 AND NOT list_contains(f.chain, coalesce(m.a || '-' || m.n, o.nxt))),
e AS (
  SELECT f.*, [f.a, o.nxt, 'equip'] AS proto, coalesce(m.a || '-' || m.n, o.nxt) AS target, false AS leaf FROM f JOIN nouns o ON o.n = f.n LEFT JOIN names m ON m.a = f.a AND m.n = o.nxt
  UNION ALL
  SELECT f.*, [t, 'point'], NULL, true FROM f JOIN (SELECT DISTINCT a, n, t FROM p) q ON q.n = f.n AND q.a = f.a
  UNION ALL
  SELECT f.*, [t, 'point'], NULL, true FROM f JOIN (SELECT DISTINCT n, t FROM p) q ON q.n = f.n AND f.a IS NULL)
SELECT root, array_to_string(path, '/') AS path, array_to_string(list_sort(list_filter(proto, lambda x: x IS NOT NULL)), ' ') AS label, leaf AS is_leaf,
  array_to_string(list_sort(list_distinct(list_filter(list_append(proto, carry), lambda x: x IS NOT NULL))), ' ') AS tags, target, depth,
  CASE WHEN leaf THEN NULL WHEN list_contains(chain, target) THEN 'cycle' WHEN depth >= 12 THEN 'depth' END AS gap
FROM e""")
def carried_expansion(spark: SparkSession, d: str) -> DataFrame:
    """Trees of equipment by tag sets: each child set is resolved to its most specific definition, and qualities are handed down."""
    words = F.split("p_name", " ")
    p = load(spark, d, "part").select(words[0].alias("a"), words[1].alias("n"), F.lower("p_type").alias("t"))
    kinds = p.groupBy("a", "n").agg(F.count(F.lit(1)).alias("k"))
    names = kinds.crossJoin(F.broadcast(kinds.agg((F.sum("k") / F.count(F.lit(1))).alias("mean")))).filter("k >= mean").select("a", "n", F.concat_ws("-", "a", "n").alias("def"))  # one row of one mean
    nouns = p.select("n").distinct()
    order = Window.partitionBy(F.lit(0)).orderBy("n")
    following = nouns.select("n", F.coalesce(F.lead("n").over(order), F.min("n").over(Window.partitionBy(F.lit(0)))).alias("next"))
    point, equip = F.lit("point"), F.lit("equip")
    with_next = names.join(following, "n")
    protos = with_next.select("def", F.array("a", "next", equip).alias("tags"))
    protos = protos.unionByName(following.select(F.col("n").alias("def"), F.array("next", equip).alias("tags")))
    protos = protos.unionByName(names.join(p.select("a", "n", "t").distinct(), ["a", "n"]).select("def", F.array("t", point).alias("tags")))
    protos = protos.unionByName(p.select("n", "t").distinct().select(F.col("n").alias("def"), F.array("t", point).alias("tags"))).unionByName(names.select("def", F.array(F.lit("point")).alias("tags")))
    definitions = names.select("def", F.explode(F.array("a", "n")).alias("part")).unionByName(nouns.select(F.col("n").alias("def"), F.col("n").alias("part"))).unionByName(p.select(F.col("a").alias("def"), F.col("a").alias("part")).distinct())
    ancestors = names.select(F.col("def").alias("node"), F.explode(F.array("n", equip)).alias("ancestor")).unionByName(nouns.select(F.col("n").alias("node"), equip.alias("ancestor")))
    ancestors = ancestors.unionByName(p.select(F.col("a").alias("node"), F.lit("quality").alias("ancestor")).distinct())
    flatten = names.select("def", F.lit("quality").alias("choice")).unionByName(nouns.select(F.col("n").alias("def"), F.lit("quality").alias("choice")))
    return graph.expand_sets(protos, definitions, ancestors, flatten, names.select("def"), wildcards=(("point",),), max_depth=12)


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey % 5 AS kind FROM customer)
SELECT k // 10 AS page, k AS id, CASE kind WHEN 0 THEN 'S2_HI_' || k WHEN 1 THEN 'COND_FAN_VSD_K' || k WHEN 2 THEN 'AB ' || k WHEN 3 THEN 'SNVT_count_f' || k ELSE 'NOT THERE ' || k END AS restored, kind NOT IN (2, 4) AS found FROM c""")
def page_restored_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that lost their underscores, put back from runs of one to three words of their own page; ambiguous ones stay."""
    k = F.col("c_custkey")
    text = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    key, kind = k.cast("string"), k % 5
    c = load(spark, d, "customer").select(F.expr("c_custkey div 10").alias("page"), k.alias("id"), kind.alias("kind"), key.alias("key"))
    cases = lambda values: F.coalesce(*(F.when(F.col("kind") == n, v) for n, v in enumerate(values)))
    key = F.col("key")
    written = cases([F.array(text("S2_HI_", key)), F.array(F.lit("COND_FAN_"), F.lit("VSD_"), text("K", key)), F.array(text("A_B", key), text("AB_", key)), F.array(text("SNVT_count_f", key)), F.array(F.lit("elsewhere"))])
    words = c.select("page", "id", F.posexplode(written).alias("i", "word")).select("page", (F.col("id") * 3 + F.col("i")).alias("pos"), "word")
    mangled = cases([text("S2 HI ", key), text("CONDFANVSDK", key), text("AB ", key), text("_ SNVT count f", key, " _"), text("NOT THERE ", key)])
    return headers.restored_by_page(c.select("page", "id", mangled.alias("name")), words, ["page"], "name").select("page", "id", "restored", "found")


@query("""
SELECT 'parts' AS sheet, col, CAST(count(*) AS BIGINT) AS n, sha256(string_agg(value, '|' ORDER BY value)) AS digest
FROM (SELECT unnest([0, 1, 2, 3]) AS col, unnest([CAST(p_partkey AS VARCHAR), p_name || ' <&"é' || chr(10) || 'x', p_brand, CAST(p_size AS VARCHAR)]) AS value FROM part) GROUP BY col""")
def workbook_cells(spark: SparkSession, d: str) -> DataFrame:
    """Parts written as workbooks and read back as cells, without the header rows."""
    register(spark)
    folder = scratch(spark, "workbooks")
    text = F.concat("p_name", F.lit(' <&"é\nx'))
    load(spark, d, "part").select("p_partkey", text.alias("p_name"), "p_brand", "p_size").write.format("sheet_cells").option("sheet", "parts").mode("append").save(folder)
    cells = spark.read.format("sheet_cells").option("sheet", "parts").load(folder).filter("row > 0")
    values = F.array_join(F.array_sort(F.collect_list("value")), "|")
    return cells.groupBy("sheet", "col").agg(F.count(F.lit(1)).alias("n"), F.sha2(values.cast("binary"), 256).alias("digest"))


@query("""
WITH n AS (
  SELECT 'nation ' || n_nationkey AS node, 'nation' AS kind, n_name AS text, ['region ' || n_regionkey] AS links FROM nation UNION ALL
  SELECT 'region ' || r_regionkey, 'region', r_name, (SELECT list('nation ' || n_nationkey ORDER BY n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) FROM region UNION ALL
  SELECT 'supplier ' || s_suppkey, 'supplier', s_name, ['nation ' || s_nationkey] FROM supplier)
SELECT node || '.md' AS file, '---' || chr(10) || 'kind: ' || kind || chr(10) || '---' || chr(10) || '# ' || node || chr(10) || chr(10) || replace(text, '#', '#') || chr(10) || chr(10) || coalesce(array_to_string(list_transform(links, lambda x: '- [[' || x || ']]'), chr(10)) || chr(10), '') AS note FROM n""")
def linked_notes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a graph written as linked notes and read back as files."""
    register(spark)
    folder = scratch(spark, "notes")
    name = lambda kind, key: F.concat(F.lit(f"{kind} "), F.col(key).cast("string"))
    nation, region, supplier = (load(spark, d, t) for t in ("nation", "region", "supplier"))
    below = nation.groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda k: F.concat(F.lit("nation "), k.cast("string"))).alias("links"))
    nodes = nation.select(name("nation", "n_nationkey").alias("node"), F.lit("nation").alias("kind"), F.col("n_name").alias("text"), F.array(name("region", "n_regionkey")).alias("links"))
    nodes = nodes.unionByName(region.join(below, F.col("r_regionkey") == F.col("n_regionkey"), "left").select(name("region", "r_regionkey").alias("node"), F.lit("region").alias("kind"), F.col("r_name").alias("text"), "links"))
    nodes = nodes.unionByName(supplier.select(name("supplier", "s_suppkey").alias("node"), F.lit("supplier").alias("kind"), F.col("s_name").alias("text"), F.array(name("nation", "s_nationkey")).alias("links")))
    nodes.write.format("linked_notes").mode("append").save(folder)
    notes = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    file = F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("%20"), F.lit(" "))
    return notes.select(file.alias("file"), F.col("value").alias("note"))
