"""Queries for gates, publishing, the viewer, releases and the flagship dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import labels
from tessera.operators import gates, publish, reconcile
from tessera.plans.registry import query
from tessera.sources.tables import load


@query("""
WITH f AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS entity, 'E' AS level, 'required' AS code, 'no price' AS message FROM orders WHERE o_totalprice IS NULL OR o_totalprice < 2000
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'E', 'orphan', 'customer ' || o_custkey FROM orders WHERE o_custkey % 50 = 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'W', 'unit-unknown', o_orderpriority FROM orders WHERE o_orderpriority LIKE '%NOT%'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'I', 'no-gap-note', 'pending' FROM orders WHERE o_orderstatus = 'P')
SELECT level, code, count(*) AS n, count(DISTINCT entity) AS n_entities, min(message) AS first_message FROM f GROUP BY level, code""")
def gate_findings(spark: SparkSession, d: str) -> DataFrame:
    """Findings of a battery of rules, all tried in one pass."""
    c = F.col
    rules = [
        gates.Rule("required", "E", c("o_totalprice").isNull() | (c("o_totalprice") < 2000), F.lit("no price")),
        gates.Rule("orphan", "E", c("o_custkey") % 50 == 0, F.concat(F.lit("customer "), c("o_custkey").cast("string"))),
        gates.Rule("unit-unknown", "W", F.contains("o_orderpriority", F.lit("NOT")), c("o_orderpriority")),
        gates.Rule("no-gap-note", "I", c("o_orderstatus") == "P", F.lit("pending")),
    ]
    found = gates.findings(load(spark, d, "orders"), c("o_orderkey"), rules)
    return found.groupBy("level", "code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity").alias("n_entities"), F.min("message").alias("first_message"))


@query("""
SELECT DISTINCT user_id, event_type AS field FROM events WHERE event_type NOT IN ('view', 'click', 'signup')""")
def schema_conformance(spark: SparkSession, d: str) -> DataFrame:
    """Fields that the dictionary does not declare."""
    e = load(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("fields"))
    return gates.unknown_fields(e, "user_id", F.col("fields"), ["view", "click", "signup"])


@query("""
SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1""")
def duplicate_instances(spark: SparkSession, d: str) -> DataFrame:
    """Keys that occur twice inside one entity (L03 dup-instance)."""
    return gates.duplicates(load(spark, d, "lineitem"), ["l_orderkey"], ["l_partkey"])


@query("""
WITH x AS (SELECT p_partkey * 3 AS k, split_part(p_name, ' ', 1) AS part FROM part)
SELECT k AS p_partkey, CASE WHEN p_name IS NULL THEN 'missing' WHEN contains(lower(p_name), lower(x.part)) THEN 'ok' ELSE 'wrong' END AS verdict FROM x LEFT JOIN part ON p_partkey = k""")
def golden_sample(spark: SparkSession, d: str) -> DataFrame:
    """Known samples against actual names."""
    p = load(spark, d, "part").select("p_partkey", "p_name")
    expected = p.select((F.col("p_partkey") * 3).alias("p_partkey"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("part"))
    return gates.golden_sample(p, expected, ["p_partkey"], "p_name", "part")


@query("""
SELECT s_suppkey, 'nation' AS feature, CAST(s_nationkey AS VARCHAR) AS value FROM supplier UNION ALL SELECT s_suppkey, 'name', s_name FROM supplier
UNION ALL SELECT s_suppkey, 'balance', CAST(CAST(round(s_acctbal, 0) AS BIGINT) AS VARCHAR) FROM supplier WHERE s_acctbal > 0""")
def long_export(spark: SparkSession, d: str) -> DataFrame:
    """One row per unit and feature that has a value."""
    balance = F.when(F.col("s_acctbal") > 0, F.round("s_acctbal", 0).cast("long"))
    s = load(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), balance.alias("balance"))
    return publish.to_long(s, ["s_suppkey"], ["nation", "name", "balance"])


@query("""
SELECT l_suppkey, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a, max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS n, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r FROM lineitem GROUP BY l_suppkey""")
def wide_export(spark: SparkSession, d: str) -> DataFrame:
    """One row per unit with a column per feature in a fixed order."""
    wide = publish.to_wide(load(spark, d, "lineitem"), ["l_suppkey"], "l_returnflag", "l_quantity", ["A", "N", "R"])
    return wide.select("l_suppkey", *(F.col(c).alias(c.lower()) for c in "ANR"))


@query("SELECT doc_id, lang, source FROM documents")
def dynamic_columns(spark: SparkSession, d: str) -> DataFrame:
    """Only those optional columns that hold a value are written."""
    docs = load(spark, d, "documents").withColumn("empty", F.lit(None).cast("string"))
    return docs.select("doc_id", *publish.present_columns(docs, ["lang", "empty", "source"]))


@query("""
SELECT 'part' AS kind, CAST(p_partkey AS VARCHAR) AS ref, p_name AS label FROM part WHERE contains(lower(p_name), '7') OR contains(lower(p_name), 'red')
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation WHERE contains(lower(n_name), 'red')
UNION ALL SELECT 'turn', conv_id || '-' || turn, left(text, 40) FROM conversations WHERE contains(lower(text), 'red')""")
def global_search(spark: SparkSession, d: str) -> DataFrame:
    """A needle in several tables."""
    part, nation, turns = (load(spark, d, t) for t in ("part", "nation", "conversations"))
    ref = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    found = publish.search([("part", part, F.col("p_partkey"), F.col("p_name")), ("nation", nation, F.col("n_nationkey"), F.col("n_name")), ("turn", turns, ref, F.col("text"))], "red", label_chars=40)
    return found.unionByName(publish.search([("part", part.filter("not contains(lower(p_name), 'red')"), F.col("p_partkey"), F.col("p_name"))], "7"))


@query("""
SELECT p_brand, p_type, count(*) AS n, min(p_retailprice) AS cheapest FROM part WHERE p_size BETWEEN 5 AND 30 AND p_type IN ('ECONOMY', 'PROMO') AND contains(p_name, 'e') GROUP BY p_brand, p_type""")
def facet_filters(spark: SparkSession, d: str) -> DataFrame:
    """Facets of the catalogue view, pushed into the scan."""
    p = load(spark, d, "part").filter("p_size BETWEEN 5 AND 30 AND p_type IN ('ECONOMY', 'PROMO') AND contains(p_name, 'e')")
    return p.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_retailprice").alias("cheapest"))


@query("""
SELECT p_brand AS vendor, count(*) AS n_models, count(DISTINCT p_type) AS n_types, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand""")
def vendor_index(spark: SparkSession, d: str) -> DataFrame:
    """Models and types per vendor."""
    return load(spark, d, "part").groupBy(F.col("p_brand").alias("vendor")).agg(F.count(F.lit(1)).alias("n_models"), F.countDistinct("p_type").alias("n_types"), F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"))


@query("""
WITH m AS (SELECT c_mktsegment, max(CASE WHEN c_nationkey % 3 = 0 THEN c_acctbal END) AS a, max(CASE WHEN c_nationkey % 3 = 1 THEN c_acctbal END) AS b, max(CASE WHEN c_nationkey % 3 = 2 AND c_acctbal > 9990 THEN c_acctbal END) AS c FROM customer GROUP BY c_mktsegment)
SELECT *, CAST((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS BIGINT) AS n FROM m""")
def concept_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Concepts by profiles with the number of profiles that share each."""
    k = F.col("c_nationkey") % 3
    c = load(spark, d, "customer").filter((k != 2) | (F.col("c_acctbal") > 9990)).withColumn("profile", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), k.cast("int") + 1))
    return publish.matrix(c, "c_mktsegment", "profile", F.max("c_acctbal"), ["a", "b", "c"])


@query("""
WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS price, count(*) AS n FROM orders WHERE month(o_orderdate) <= 6 GROUP BY o_custkey),
b AS (SELECT o_custkey AS k, max(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b USING (k) WHERE a.k IS NULL OR b.k IS NULL OR a.price <> b.price OR a.n <> b.n""")
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Added, removed and changed rows between two releases (EP-43)."""
    o = load(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    shape = lambda df: df.groupBy("k").agg(F.max("o_totalprice").alias("price"), F.count(F.lit(1)).alias("n"))
    return reconcile.snapshot_diff(shape(o.filter(F.month("o_orderdate") <= 6)), shape(o), ["k"], ["price", "n"])


@query("""
WITH s AS (SELECT l_partkey AS p, l_suppkey AS q, min(l_linenumber) AS unit, min(l_returnflag) AS kind FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
a AS (SELECT l_partkey AS p, l_suppkey AS q, min(l_linenumber) AS unit, min(l_returnflag) AS kind FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1, 2)
SELECT p, q, CASE WHEN a.p IS NULL THEN 'missing' WHEN s.p IS NULL THEN 'extra' WHEN s.kind <> a.kind THEN 'type_mismatch' WHEN s.unit <> a.unit THEN 'unit_mismatch' ELSE 'match' END AS verdict FROM s FULL JOIN a USING (p, q)""")
def conformance(spark: SparkSession, d: str) -> DataFrame:
    """Actual points against a standard (EP-60, L02)."""
    li = load(spark, d, "lineitem").withColumnsRenamed({"l_partkey": "p", "l_suppkey": "q"})
    shape = lambda df: df.groupBy("p", "q").agg(F.min("l_linenumber").alias("unit"), F.min("l_returnflag").alias("kind"))
    return reconcile.conformance(shape(li.filter("l_linestatus = 'F'")), shape(li.filter("l_orderkey % 3 <> 0")), ["p", "q"], "unit", "kind")


@query("""
WITH m(code, canon) AS (VALUES ('F', 'filled'), ('O', 'open'), ('P', 'pending')), n(canon, other) AS (VALUES ('filled', 1), ('open', 2), ('pending', 3))
SELECT o_orderstatus AS code, canon, other, count(*) AS n, count(*) FILTER (o_orderstatus = m.code) AS same FROM orders JOIN m ON m.code = o_orderstatus JOIN n USING (canon) GROUP BY 1, 2, 3""")
def code_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Codes to canonical names, to another vendor's codes and back without loss (EP-17, EP-18)."""
    m = F.broadcast(spark.createDataFrame([("F", "filled"), ("O", "open"), ("P", "pending")], "code string, canon string"))
    n = F.broadcast(spark.createDataFrame([("filled", 1), ("open", 2), ("pending", 3)], "canon string, other int"))
    there = load(spark, d, "orders").select(F.col("o_orderstatus").alias("code")).join(m, "code").join(n, "canon")
    back = there.join(n.withColumnRenamed("canon", "canon_back"), "other").join(m.withColumnsRenamed({"canon": "canon_back", "code": "code_back"}), "canon_back")
    return back.groupBy("code", "canon", "other").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("code") == F.col("code_back")).alias("same"))


@query("""
WITH a AS (SELECT l_orderkey, max(l_quantity) AS v FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey), b AS (SELECT l_orderkey, max(l_quantity) AS v FROM lineitem WHERE l_linenumber = 2 GROUP BY l_orderkey)
SELECT l_orderkey, a.v = b.v AS agrees FROM a JOIN b USING (l_orderkey)""")
def invariant_check(spark: SparkSession, d: str) -> DataFrame:
    """Two physically separate rows must carry equal values."""
    li = load(spark, d, "lineitem").withColumn("role", F.col("l_linenumber").cast("string"))
    return reconcile.diverging_pairs(li, ["l_orderkey"], "role", "1", "2", "l_quantity")


@query("""
WITH b AS (SELECT p_partkey, p_brand, p_size, p_retailprice AS listed FROM part),
f AS (SELECT l_partkey, min(CAST(l_quantity AS VARCHAR)) AS lo, max(CAST(l_quantity AS VARCHAR)) AS hi FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, coalesce(lo || ' - ' || hi, '—') AS airflow, CASE WHEN p_brand = 'Brand#11' THEN p_size * 10 ELSE NULL END AS capacity FROM b LEFT JOIN f ON l_partkey = p_partkey""")
def enriched_units(spark: SparkSession, d: str) -> DataFrame:
    """Enrichment by joins: text bounds per unit, a code map for one vendor, dashes where absent."""
    f = load(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min(F.col("l_quantity").cast("string")).alias("lo"), F.max(F.col("l_quantity").cast("string")).alias("hi"))
    p = load(spark, d, "part").select("p_partkey", "p_brand", "p_size").join(f, "p_partkey", "left")
    return p.select("p_partkey", F.coalesce(F.concat("lo", F.lit(" - "), "hi"), F.lit("—")).alias("airflow"), F.when(F.col("p_brand") == "Brand#11", F.col("p_size") * 10).alias("capacity"))


@query("""
SELECT s_suppkey, 'spec' AS source, 'balance' AS field, round(s_acctbal, 2) AS value FROM supplier UNION ALL SELECT l_suppkey, 'table', 'quantity', max(l_quantity) FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT l_suppkey, 'evidence', 'discount', max(l_discount) FROM lineitem WHERE l_tax > 0.05 GROUP BY l_suppkey""")
def simulator_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Inputs of several layers in one shape."""
    s = load(spark, d, "supplier").select("s_suppkey", F.lit("spec").alias("source"), F.lit("balance").alias("field"), F.round("s_acctbal", 2).alias("value"))
    li = load(spark, d, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    t = li.groupBy("s_suppkey").agg(F.max("l_quantity").alias("value")).select("s_suppkey", F.lit("table").alias("source"), F.lit("quantity").alias("field"), "value")
    e = li.filter("l_tax > 0.05").groupBy("s_suppkey").agg(F.max("l_discount").alias("value")).select("s_suppkey", F.lit("evidence").alias("source"), F.lit("discount").alias("field"), "value")
    return s.unionByName(t).unionByName(e)


@query("""
WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'explicit' END AS own, c_mktsegment, c_acctbal FROM customer)
SELECT coalesce(own, CASE WHEN contains(c_mktsegment, 'AUTO') THEN 'auto' WHEN c_acctbal < 0 THEN 'debt' WHEN contains(c_mktsegment, 'E') THEN 'other' ELSE 'none' END) AS kind, count(*) AS n FROM r GROUP BY 1""")
def conditional_default(spark: SparkSession, d: str) -> DataFrame:
    """An explicit value beats an ordered list of rules."""
    seg = F.col("c_mktsegment")
    rules = [(F.contains(seg, F.lit("AUTO")), "auto"), (F.col("c_acctbal") < 0, "debt"), (F.contains(seg, F.lit("E")), "other")]
    kind = labels.defaulted(F.when(F.col("c_custkey") % 7 == 0, "explicit"), rules, "none")
    return load(spark, d, "customer").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH t AS (SELECT doc_id, len(regexp_extract_all(text, '[0-9]')) AS digits, len(regexp_extract_all(lower(text), '(^|[^a-z])(the|der|que|el)($|[^a-z])')) AS terms FROM documents),
r AS (SELECT *, row_number() OVER (ORDER BY digits DESC, doc_id) AS place FROM t WHERE terms > 0 AND digits >= 20)
SELECT doc_id, CAST(digits AS INT) AS digits, CAST(place AS INT) AS place FROM r WHERE place <= 8""")
def quantifiability_probe(spark: SparkSession, d: str) -> DataFrame:
    """The eight documents with most digits that name a term."""
    t = load(spark, d, "documents").select(
        "doc_id", F.regexp_count("text", F.lit("[0-9]")).alias("digits"), F.lower("text").rlike("(^|[^a-z])(the|der|que|el)($|[^a-z])").alias("named")
    )
    top = t.filter("named AND digits >= 20").orderBy(F.desc("digits"), "doc_id").limit(8)
    from pyspark.sql import Window

    return top.select("doc_id", "digits", F.row_number().over(Window.orderBy(F.desc("digits"), "doc_id")).alias("place"))


@query("""
WITH p AS (SELECT p_partkey, p_type || '.' || p_brand AS cat, p_name, p_size FROM part),
s AS (SELECT *, CASE WHEN starts_with(cat, 'ECONOMY') THEN 'eco' WHEN starts_with(cat, 'PROMO') THEN 'promo' ELSE 'base' END AS profile FROM p),
m AS (SELECT profile, p_partkey, CASE WHEN regexp_matches(p_name, 'red|hot') THEN 'heat' WHEN regexp_matches(p_name, 'cold|blue') THEN 'cool' WHEN regexp_matches(p_name, 'gear') THEN 'drive' END AS template, p_size FROM s)
SELECT profile, coalesce(template, 'unmatched') AS template, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size, round(avg(CASE WHEN template IS NULL THEN 0.0::DOUBLE ELSE 100 END), 6) AS matched_pct FROM m GROUP BY 1, 2""")
def mapped_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The flagship chain: profile by prefix, template by rules, coverage per profile (lifecycle 3.1)."""
    from tessera.operators.match import first_match, longest_prefix

    profiles = spark.createDataFrame([("eco", "ECONOMY", 1), ("promo", "PROMO", 2), ("base", None, 3)], "profile string, prefix string, ord int")
    p = load(spark, d, "part").select("p_partkey", F.concat_ws(".", "p_type", "p_brand").alias("cat"), "p_name", "p_size")
    scoped = p.join(longest_prefix(p, "cat", ["p_partkey"], profiles), "p_partkey")
    m = first_match(scoped, "p_name", [("red|hot", "heat"), ("cold|blue", "cool"), ("gear", "drive")], "template")
    matched = F.when(F.col("template").isNull(), 0.0).otherwise(100.0)
    out = m.withColumn("matched", matched).withColumn("template", F.coalesce("template", F.lit("unmatched")))
    return out.groupBy("profile", "template").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"), F.round(F.avg("matched"), 6).alias("matched_pct"))


@query("""
SELECT CAST(min(d) AS VARCHAR) AS first_day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, CAST(ts AS DATE) AS d FROM events) GROUP BY d, event_type""")
def streaming_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily tallies by Structured Streaming over the event files (an extension: the catalogue has no stream)."""
    from tessera.streaming.windows import daily_tally

    return daily_tally(spark, f"{d}/events.parquet")
