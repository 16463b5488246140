"""Queries of the gates that decide from several tables of a model; their SQL is written apart from the library's rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import gates, reconcile
from tessera.plans.registry import query
from tessera.scratch import spread
from tessera.sources.tables import load


@query("""
WITH o AS (SELECT o_custkey AS model, o_orderstatus AS type, o_orderkey AS inst, o_orderpriority AS name FROM orders),
n AS (SELECT model, count(*) AS n FROM o GROUP BY model),
m AS (
  SELECT c_custkey AS k, coalesce(n, 0) AS n, c_custkey % 6 = 0 AS by_hand, c_custkey % 4 = 0 AS no_gap, c_custkey % 3 = 0 AS has_spec, c_custkey % 5 <> 0 AS checked, c_custkey % 10 = 1 AS image,
    floor(coalesce(n, 0) * (c_custkey % 3) / 2) AS b, CASE WHEN c_custkey % 7 = 0 AND floor(coalesce(n, 0) * (c_custkey % 3) / 2) > 0 THEN 1 ELSE 0 END AS off
  FROM customer LEFT JOIN n ON model = c_custkey),
x AS (SELECT CAST(k AS VARCHAR) AS entity, *, CAST(CAST(b AS BIGINT) AS VARCHAR) || '/' || n AS share FROM m),
e AS (
  SELECT model AS k, type || '-' || inst AS key, inst % 27 = 0 AS wrong, inst % 27 <> 0 AND inst % 18 = 9 AS missing FROM o WHERE inst % 9 = 0),
g AS (SELECT k, count(*) AS n, count(*) FILTER (wrong) AS w, min(key) FILTER (wrong) AS fw, count(*) FILTER (missing) AS s, min('Z' || substr(key, 2)) FILTER (missing) AS fs FROM e GROUP BY k),
f AS (
  SELECT entity, 'W' AS level, 'crosscheck-unverifiable' AS code, 'image only' AS message FROM x WHERE n > 0 AND checked AND image
  UNION ALL SELECT entity, 'W', 'crosscheck-thin', share FROM x WHERE n > 0 AND checked AND NOT image AND b < n / 2
  UNION ALL SELECT entity, 'W', 'crosscheck-none', share FROM x WHERE n > 0 AND checked AND NOT image AND b = 0
  UNION ALL SELECT entity, 'E', 'crosscheck', off || ' order' FROM x WHERE n > 0 AND checked AND NOT image AND b > 0 AND (b - off) / b < 0.98
  UNION ALL SELECT entity, 'I', 'crosscheck-ok', share FROM x WHERE n > 0 AND checked AND NOT image AND b > 0 AND (b - off) / b >= 0.98
  UNION ALL SELECT entity, 'W', 'no-crosscheck', 'one reading only' FROM x WHERE n > 0 AND NOT checked AND NOT by_hand
  UNION ALL SELECT CAST(k AS VARCHAR), 'E', 'known-good', w || ' ' || fw FROM g WHERE w > 0
  UNION ALL SELECT CAST(k AS VARCHAR), 'W', 'known-good-missing', s || ' ' || fs FROM g WHERE s > 0
  UNION ALL SELECT CAST(k AS VARCHAR), 'I', 'known-good-ok', CAST(n AS VARCHAR) FROM g WHERE w = 0 AND s = 0
  UNION ALL SELECT entity, 'W', 'no-known-good', 'no way to check' FROM x LEFT JOIN g ON g.k = x.k WHERE g.k IS NULL AND NOT checked AND x.n > 0
  UNION ALL SELECT entity, 'I', CASE k % 9 WHEN 0 THEN 'spec-ok' WHEN 3 THEN 'spec-variants' ELSE 'spec-flat' END, '2 ' || 2 * (k % 8) FROM x WHERE has_spec
  UNION ALL SELECT entity, CASE WHEN k % 4 = 3 THEN 'W' ELSE 'I' END, CASE WHEN k % 4 = 3 THEN 'spec-nocore' ELSE 'spec-core' END, CASE k % 4 WHEN 0 THEN 'power' WHEN 1 THEN 'current, power' WHEN 2 THEN 'power, voltage' ELSE 'nothing to simulate with' END FROM x WHERE has_spec
  UNION ALL SELECT entity, 'W', 'no-spec', 'points only' FROM x WHERE NOT has_spec AND n > 0
  UNION ALL SELECT entity, 'W', 'spec-source-unfit', 'leaflet 2: for installers' FROM x WHERE has_spec AND k % 5 = 2
  UNION ALL SELECT entity, 'I', 'no-gap-note', 'no note on what is missing' FROM x WHERE no_gap AND NOT has_spec
  UNION ALL SELECT entity, 'I', 'manual', CAST(n AS VARCHAR) FROM x WHERE by_hand AND n > 0)
SELECT entity AS model, level, code, message FROM f""")
def layered_gate(spark: SparkSession, d: str) -> DataFrame:
    """Codes that need a model's points, second readings, confirmed points, ratings and record together."""
    orders = load(spark, d, "orders").select(F.col("o_custkey").alias("model"), F.col("o_orderstatus").alias("type"), F.col("o_orderkey").alias("inst"), F.col("o_orderpriority").alias("name"))
    k, n = F.col("model"), F.col("n_points")
    models = load(spark, d, "customer").select(F.col("c_custkey").alias("model")).join(orders.groupBy("model").agg(F.count(F.lit(1)).alias("n_points")), "model", "left")
    models = models.select("model", F.coalesce("n_points", F.lit(0)).alias("n_points"), F.when(k % 6 == 0, "manual").otherwise("reader").alias("extractor"), F.when(k % 4 != 0, "no price").alias("gap"), (k % 3 == 0).alias("has_spec"))
    both = F.floor(n * (k % 3) / 2)
    checks = models.filter(k % 5 != 0).select("model", F.when(k % 10 == 1, "image only").alias("unverifiable"), both.alias("n_both"), (both - F.when((k % 7 == 0) & (both > 0), 1).otherwise(0)).alias("n_agree"), F.lit("order").alias("example"))
    inst = F.col("inst")
    expected = orders.filter(inst % 9 == 0).select("model", F.when((inst % 27 != 0) & (inst % 18 == 9), "Z").otherwise(F.col("type")).alias("type"), "inst", F.when(inst % 27 == 0, "no such name").otherwise(F.upper("name")).alias("part"))
    form = F.when(k % 9 == 0, "table").when(k % 9 == 3, "variant").otherwise("flat")
    quantities = F.array(F.when(k % 4 == 3, "flow").otherwise("power"), F.when(k % 4 == 1, "current").when(k % 4 == 2, "voltage"))
    specs = models.filter("has_spec").select("model", form.alias("form"), (k % 8).alias("rows"), F.concat(F.lit("leaflet "), (k % 5).cast("string")).alias("source"), F.explode(quantities).alias("quantity"))
    unfit = models.select(F.lit("leaflet 2").alias("source"), F.lit("for installers").alias("reason")).distinct()
    found = [gates.crosscheck_findings(models, checks), gates.known_good_findings(models, orders, expected, checks), gates.spec_findings(models, specs, unfit), gates.record_findings(models)]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.select(F.col("entity").alias("model"), "level", "code", "message")


@query("""
WITH c AS (SELECT o_custkey AS m, count(*) AS n FROM orders GROUP BY o_custkey),
g AS (SELECT m, n, CASE m % 6 WHEN 0 THEN 'human' WHEN 1 THEN 'sample' WHEN 2 THEN 'machine' WHEN 3 THEN 'weak' WHEN 4 THEN 'blind' ELSE 'machine' END AS grade FROM c),
t AS (SELECT count(*) FILTER (grade NOT IN ('weak', 'blind')) AS ok, count(*) AS all_, coalesce(sum(n) FILTER (grade NOT IN ('weak', 'blind')), 0) AS okp, coalesce(sum(n), 0) AS allp, count(*) FILTER (grade IN ('weak', 'blind')) AS thin, coalesce(sum(n) FILTER (grade IN ('weak', 'blind')), 0) AS thinp FROM g),
i AS (SELECT l_suppkey AS s, max(l_shipdate) AS newest_at, arg_max(l_orderkey, (l_shipdate, CAST(l_orderkey AS VARCHAR))) AS newest FROM lineitem GROUP BY l_suppkey),
v AS (SELECT s_suppkey AS s, CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE make_timestamp(CASE s_suppkey % 4 WHEN 0 THEN 1990 ELSE 2020 END, 1, 1, 0, 0, 0) END AS built FROM supplier),
p AS (SELECT p_type AS profile, p_brand AS model, p_name AS name, max(p_size) > 25 AS hit, min(p_partkey) % 2 = 0 AS required FROM part GROUP BY p_type, p_brand, p_name),
q AS (SELECT profile, model, count(*) FILTER (hit) AS h, count(*) AS a, coalesce(list(name ORDER BY name) FILTER (required AND NOT hit), []) AS missed FROM p GROUP BY profile, model),
r AS (SELECT *, h / a AS ratio, row_number() OVER (PARTITION BY profile ORDER BY h / a) - 1 AS pl, count(*) OVER (PARTITION BY profile) AS n FROM q),
z AS (SELECT profile, ratio AS middle FROM r WHERE pl = n // 2)
SELECT 'all' AS entity, 'I' AS level, 'verified-count' AS code, ok || '/' || all_ || ' ' || okp || '/' || allp AS message FROM t WHERE all_ > 0
UNION ALL SELECT 'all', 'W', 'verified-thin', thin || ' ' || thinp FROM t WHERE thin > 0
UNION ALL SELECT CAST(v.s AS VARCHAR), 'I', 'review-missing', 'not built' FROM v WHERE built IS NULL
UNION ALL SELECT CAST(v.s AS VARCHAR), 'W', 'review-stale', CAST(newest AS VARCHAR) FROM v JOIN i ON i.s = v.s WHERE built < newest_at
UNION ALL SELECT model, CASE WHEN profile = 'PROMO' THEN 'I' ELSE 'W' END, 'template-required', profile || ' ' || len(missed) || ' ' || array_to_string(missed[1:5], ', ') FROM q WHERE len(missed) > 0
UNION ALL SELECT model, CASE WHEN r.profile = 'PROMO' THEN 'I' ELSE 'W' END, 'template-thin', r.profile || ' ' || h || '/' || a FROM r JOIN z ON z.profile = r.profile WHERE ratio < 0.5 * middle""")
def coverage_gate(spark: SparkSession, d: str) -> DataFrame:
    """Codes over all models: confirmed and unconfirmed ones, stale artefacts, template rows that nothing serves."""
    k = F.col("model")
    grade = F.element_at(F.array(*map(F.lit, ("human", "sample", "machine", "weak", "blind", "machine"))), (k % 6 + 1).cast("int"))
    grades = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("model")).agg(F.count(F.lit(1)).alias("n_points")).withColumn("grade", grade)
    s = F.col("s_suppkey")
    built = F.when(s % 4 != 1, F.make_timestamp(F.when(s % 4 == 0, 1990).otherwise(2020), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    artefacts = load(spark, d, "supplier").select(s.cast("string").alias("artefact"), built.alias("built_at"))
    inputs = load(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("artefact"), F.col("l_orderkey").cast("string").alias("input"), F.col("l_shipdate").cast("timestamp").alias("changed_at"))
    part = load(spark, d, "part").groupBy(F.col("p_type").alias("profile"), F.col("p_brand").alias("model"), F.col("p_name").alias("name"))
    cover = part.agg((F.max("p_size") > 25).alias("hit"), (F.min("p_partkey") % 2 == 0).alias("required"))
    notes = cover.select("profile", F.when(F.col("profile") == "PROMO", "known gaps").alias("note")).distinct()
    return gates.verified_findings(grades).unionByName(gates.review_findings(artefacts, inputs)).unionByName(gates.template_findings(cover, notes))


@query("""
WITH r AS (SELECT l_orderkey AS o, l_suppkey AS s, l_quantity AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem),
v AS (SELECT *, CAST(CAST(q AS BIGINT) AS VARCHAR) AS a, CASE WHEN s % 7 = 0 THEN 'misread' ELSE CAST(CAST(q AS BIGINT) AS VARCHAR) END AS b, s % 5 <> 0 AS there FROM r)
SELECT o AS l_orderkey, count(*) FILTER (there) AS n_both, count(*) FILTER (there AND a = b) AS n_agree, count(*) FILTER (NOT there) AS n_first, CAST(1 AS BIGINT) AS n_second, arg_min('k' || n || ': ' || a || ' | ' || b, n) FILTER (there AND a <> b) AS example FROM v GROUP BY o""")
def second_readings(spark: SparkSession, d: str) -> DataFrame:
    """An order's lines read twice, the second time with gaps, errors and one line too many, put side by side."""
    lines = spread(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"), ["l_orderkey"], 250_000)
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = lines.select("l_orderkey", "l_suppkey", F.col("l_quantity").cast("long").cast("string").alias("value"), F.row_number().over(order).alias("pos")).withColumn("key", F.concat(F.lit("k"), F.col("pos").cast("string")))
    seen = lines.filter(F.col("l_suppkey") % 5 != 0).withColumn("value", F.when(F.col("l_suppkey") % 7 == 0, "misread").otherwise(F.col("value")))
    more = lines.groupBy("l_orderkey").agg((F.max("pos") + 1).alias("pos")).select("l_orderkey", F.lit("other").alias("value"), "pos", F.lit("k0").alias("key"))
    both = seen.select("l_orderkey", "value", "pos", "key").unionByName(more)
    aligned = reconcile.aligned_readings(lines, both, ["l_orderkey"], "pos", "key", "value")
    return reconcile.reading_agreement(aligned, ["l_orderkey"])


@query("""
WITH p AS (
  SELECT p_partkey AS k, p_partkey % 13 <> 0 AS o, p_partkey % 11 <> 0 AS n, p_partkey % 17 <> 0 AS c, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN 'my ' || p_name ELSE p_name END AS cname, CASE WHEN p_partkey % 10 = 0 THEN upper(p_name) ELSE p_name END AS nname,
    p_size AS size, CAST(p_size + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS nsize, CAST(p_size + CASE WHEN p_partkey % 7 = 0 THEN p_partkey % 2 ELSE 0 END AS INTEGER) AS csize FROM part),
w AS (
  SELECT *, n AND c AND CASE WHEN o THEN cname <> name AND name <> nname AND cname <> nname ELSE cname <> nname END AS bad_name, n AND c AND CASE WHEN o THEN csize <> size AND size <> nsize AND csize <> nsize ELSE csize <> nsize END AS bad_size FROM p)
SELECT k AS p_partkey, CASE WHEN NOT c THEN nname WHEN n AND o AND cname = name THEN nname ELSE cname END AS name, CASE WHEN NOT c THEN nsize WHEN n AND o AND csize = size THEN nsize ELSE csize END AS size,
  CASE WHEN NOT c THEN 'proposed' WHEN NOT n AND o AND cname = name AND csize = size THEN 'retired' WHEN NOT n THEN 'orphaned' WHEN bad_name OR bad_size THEN 'conflict'
    WHEN o AND name = nname AND size = nsize THEN 'kept' WHEN cname = nname AND csize = nsize THEN 'converged' ELSE 'updated' END AS state,
  CASE WHEN bad_name THEN 'name' ELSE '' END || CASE WHEN bad_name AND bad_size THEN ',' ELSE '' END || CASE WHEN bad_size THEN 'size' ELSE '' END AS conflicts
FROM w WHERE c OR (n AND NOT o)""")
def revision_resync(spark: SparkSession, d: str) -> DataFrame:
    """Curated parts after a new revision of their source: three-way merge by column, with states and conflicts."""
    k, size = F.col("p_partkey"), F.col("p_size")
    part = load(spark, d, "part").select("p_partkey", "p_name", "p_size")
    old = part.filter(k % 13 != 0).select("p_partkey", F.col("p_name").alias("name"), size.alias("size"))
    new = part.filter(k % 11 != 0).select("p_partkey", F.when(k % 10 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"), (size + F.when(k % 3 == 0, 1).otherwise(0)).alias("size"))
    curated = part.filter(k % 17 != 0).select("p_partkey", F.when(k % 5 == 0, F.concat(F.lit("my "), "p_name")).otherwise(F.col("p_name")).alias("name"), (size + F.when(k % 7 == 0, (k % 2).cast("int")).otherwise(0)).alias("size"))
    found = reconcile.resync(old, new, curated, ["p_partkey"], ["name", "size"])
    return found.withColumn("conflicts", F.array_join("conflicts", ","))


@query("""
WITH r AS (SELECT p_type AS class, CASE WHEN p_size % 9 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS role, unnest(['capacity', split_part(p_name, ' ', 2), CASE WHEN p_size > 40 THEN 'large' END]) AS field FROM part),
c AS (SELECT class, field, count(*) AS n FROM r WHERE field IS NOT NULL AND field <> 'capacity' GROUP BY class, field),
o AS (SELECT class, list(field ORDER BY n DESC, field) AS fields FROM c GROUP BY class)
SELECT o.class, 'capacity,' || array_to_string(fields, ',') AS fields, array_to_string(fields[1:5], ',') AS detail, (SELECT string_agg(DISTINCT coalesce(role, '?'), ',' ORDER BY coalesce(role, '?')) FROM r WHERE r.class = o.class) AS roles FROM o""")
def proposed_classes(spark: SparkSession, d: str) -> DataFrame:
    """Drafts of classes from the fields and roles that were extracted."""
    words = F.split("p_name", " ")
    fields = F.array(F.lit("capacity"), words[1], F.when(F.col("p_size") > 40, "large"))
    records = load(spark, d, "part").select(F.col("p_type").alias("class"), F.when(F.col("p_size") % 9 != 0, words[0]).alias("role"), F.explode(fields).alias("field"))
    found = reconcile.propose_class(records, "class", "role", "field", "capacity")
    return found.select("class", F.array_join("table", ",").alias("fields"), F.array_join("detail", ",").alias("detail"), F.array_join("roles", ",").alias("roles"))
