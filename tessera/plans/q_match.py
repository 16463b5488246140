"""Queries that classify, match and reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import graph, match, reconcile
from tessera.plans.registry import query
from tessera.sources.tables import load

CATEGORY_RULES = [("\\| ", "table"), ("license", "legal"), ("###|\\$\\$\\$|%%%", "marked"), ("!!", "shouted"), ("@[a-z0-9-]+\\.", "contact"), ("[0-9]", "numeric")]
_CASES = " ".join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{c}'" for p, c in CATEGORY_RULES)


@query(f"""
WITH c AS (SELECT CASE {_CASES} ELSE 'plain' END AS category, n_chars FROM documents)
SELECT category, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS share, min(n_chars) AS shortest, max(n_chars) AS longest FROM c GROUP BY category""")
def first_match_classify(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the first rule that fits, with coverage per category."""
    c = match.first_match(load(spark, d, "documents").select("text", "n_chars"), "text", CATEGORY_RULES, "category", "plain")
    t = c.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))
    # One row per rule is left here, so the total over them is no shuffle that grows.
    total = t.agg(F.sum("n").alias("total"))
    return t.crossJoin(F.broadcast(total)).select("category", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("share"), "shortest", "longest")


@query("""
WITH r(ord, pattern, payload) AS (VALUES (1, 'red|blue', 'colour'), (2, 'large|small', 'size'), (3, 'widget', 'kind')),
h AS (SELECT p_partkey, arg_min(payload, ord) AS payload, min(ord) AS ord FROM part JOIN r ON regexp_matches(p_name, pattern) GROUP BY p_partkey)
SELECT p_partkey, payload, h.ord FROM part LEFT JOIN h USING (p_partkey)""")
def rule_table_match(spark: SparkSession, d: str) -> DataFrame:
    """The first rule of a table of rules."""
    rules = spark.createDataFrame([(1, "red|blue", "colour"), (2, "large|small", "size"), (3, "widget", "kind")], "ord int, pattern string, payload string")
    return match.first_match_join(load(spark, d, "part"), ["p_partkey"], "p_name", rules)


_SETS = [("latin", ["the", "of", "and", "ing"], 2), ("romance", ["que", "de", "el", "ou"], 2), ("german", ["der", "und", "sch", "ung"], 3)]


def _hits(patterns: list[str]) -> str:
    return " + ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN 1 ELSE 0 END" for p in patterns)


@query(f"""
WITH h AS (SELECT doc_id, {", ".join(f"{_hits(p)} AS {n}" for n, p, _ in _SETS)} FROM documents),
b AS (SELECT *, greatest({", ".join(f"CASE WHEN {n} >= {k} THEN {n} ELSE 0 END" for n, _, k in _SETS)}) AS best FROM h)
SELECT CASE {" ".join(f"WHEN {n} >= {k} AND {n} = best THEN '{n}'" for n, _, k in _SETS)} END AS kind, best AS kind_hits, count(*) AS n FROM b GROUP BY 1, 2""")
def evidence_count_classify(spark: SparkSession, d: str) -> DataFrame:
    """The class with most distinct patterns found, if enough."""
    c = match.by_evidence(load(spark, d, "documents").select("doc_id", "text"), "text", _SETS, "kind")
    return c.groupBy("kind", "kind_hits").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH r(profile, prefix, ord) AS (VALUES ('eco', 'ECONOMY', 1), ('std', 'STANDARD', 2), ('std1', 'STANDARD.Brand#1', 3), ('dup1', 'STANDARD.Brand#1', 4), ('any', NULL, 9)),
p AS (SELECT p_partkey, p_type || '.' || p_brand AS cat FROM part),
h AS (SELECT p_partkey, profile, ord, coalesce(length(prefix), -1) AS len FROM p JOIN r ON prefix IS NULL OR starts_with(cat, prefix)),
w AS (SELECT p_partkey, profile, row_number() OVER (PARTITION BY p_partkey ORDER BY len DESC, ord) AS rn FROM h)
SELECT profile, count(*) AS n, min(p_partkey) AS first_part FROM w WHERE rn = 1 GROUP BY profile""")
def prefix_profile(spark: SparkSession, d: str) -> DataFrame:
    """The profile with the longest prefix of a dotted category; a profile without prefix is the fallback."""
    profiles = spark.createDataFrame([("eco", "ECONOMY", 1), ("std", "STANDARD", 2), ("std1", "STANDARD.Brand#1", 3), ("dup1", "STANDARD.Brand#1", 4), ("any", None, 9)], "profile string, prefix string, ord int")
    p = load(spark, d, "part").withColumn("cat", F.concat_ws(".", "p_type", "p_brand"))
    return match.longest_prefix(p, "cat", ["p_partkey"], profiles).groupBy("profile").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_part"))


@query("""
WITH s AS (SELECT p_brand, p_name, p_type, (CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 35 ELSE 0 END) + (CASE WHEN regexp_matches(p_name, 'red|hot') THEN 10 ELSE 0 END) - (CASE WHEN regexp_matches(p_name, 'small|cold') THEN 25 ELSE 0 END) AS score, p_partkey FROM part),
w AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS r FROM s)
SELECT p_brand, p_partkey, p_name, score FROM w WHERE r = 1""")
def scored_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The best candidate of each brand by an additive score; the smallest id on ties."""
    name = F.col("p_name")
    score = F.when(F.col("p_type").isin("ECONOMY", "PROMO"), 35).otherwise(0) + F.when(name.rlike("red|hot"), 10).otherwise(0) - F.when(name.rlike("small|cold"), 25).otherwise(0)
    best = load(spark, d, "part").withColumn("score", score).groupBy("p_brand").agg(F.max_by(F.struct("p_partkey", "p_name", "score"), F.struct("score", -F.col("p_partkey"))).alias("b"))
    return best.select("p_brand", "b.p_partkey", "b.p_name", "b.score")


@query("""
WITH a AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS k1, l_linenumber AS k2 FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT DISTINCT l_suppkey AS b, l_partkey AS k1, l_linenumber AS k2 FROM lineitem WHERE l_returnflag = 'R'),
n AS (SELECT a, b, count(*) AS n FROM a JOIN b USING (k1, k2) GROUP BY a, b),
w AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS r FROM n)
SELECT a, b, n FROM w WHERE r = 1""")
def overlap_pairing(spark: SparkSession, d: str) -> DataFrame:
    """For each group of one reading the group of the other that shares most keys."""
    li = load(spark, d, "lineitem").select("l_returnflag", "l_suppkey", F.col("l_partkey").alias("k1"), F.col("l_linenumber").alias("k2"))
    a = li.filter("l_returnflag = 'A'").select(F.col("l_suppkey").alias("a"), "k1", "k2")
    b = li.filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("b"), "k1", "k2", F.col("l_suppkey").alias("ord"))
    return match.best_overlap(a, b, ["k1", "k2"], "a", "b", "ord").select("a", "b", "n")


@query("""
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 50000)""")
def semi_cited(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a large pending order."""
    cited = load(spark, d, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 50000").select(F.col("o_custkey").alias("c_custkey"))
    return load(spark, d, "customer").select("c_custkey", "c_name").join(cited, "c_custkey", "left_semi")


@query("""
SELECT source, count(*) AS n, count(*) FILTER (l.doc_id IS NULL) AS missing, round(100.0::DOUBLE * count(l.doc_id) / count(*), 1) AS covered_pct FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source""")
def anti_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a label per source."""
    docs = load(spark, d, "documents").select("doc_id", "source")
    labels = load(spark, d, "labels").select("doc_id", F.lit(1).alias("hit"))
    both = docs.join(labels, "doc_id", "left")
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hit").isNull()).alias("missing"), F.round(100.0 * F.count("hit") / F.count(F.lit(1)), 1).alias("covered_pct"))


@query("""
WITH p AS (SELECT a.p_partkey AS left_key, b.p_partkey AS right_key, regexp_replace(lower(a.p_name), '[^a-z0-9]+', '', 'g') AS x, regexp_replace(lower(b.p_name || ' ' || b.p_type), '[^a-z0-9]+', '', 'g') AS y FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey)
SELECT left_key, right_key FROM p WHERE x = y OR (least(length(x), length(y)) >= 4 AND (contains(x, y) OR contains(y, x)))""")
def fuzzy_containment(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of one brand and size whose names hold each other."""
    p = load(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_name", "p_type")
    b = p.select("p_brand", "p_size", F.col("p_partkey").alias("right_key"), F.concat_ws(" ", "p_name", "p_type").alias("other"))
    # Names meet first, then the parts that carry them: the pairs that are asked for, and no others.
    names = match.contained_names(p, b, ["p_brand", "p_size"], "p_name", "other")
    both = match.pairs_of_names(names, p.select("p_brand", "p_size", "p_name", "p_partkey"), b, ["p_brand", "p_size"], "p_name", "p_partkey", "other", "right_key")
    return both.filter(F.col("p_partkey") != F.col("right_key")).select(F.col("p_partkey").alias("left_key"), "right_key")


_TAGS = [("widget", "small part"), ("cold-gear", "gear for cold rooms"), ("red", "colour red"), ("PRM", "promo")]


@query(f"""
WITH t(code, descr) AS (VALUES {", ".join(f"('{c}', '{x}')" for c, x in _TAGS)}),
w AS (SELECT DISTINCT p_name, unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS token FROM part),
k AS (SELECT lower(code) AS token, code, 3 AS weight FROM t UNION ALL SELECT unnest(string_split_regex(lower(code), '[-_]')), code, 2 FROM t UNION ALL SELECT unnest(regexp_extract_all(lower(descr), '[a-z0-9]+')), code, 1 FROM t)
SELECT p_name, code, max(weight) AS weight FROM w JOIN k USING (token) GROUP BY p_name, code""")
def token_match(spark: SparkSession, d: str) -> DataFrame:
    """Name tokens against a tag dictionary with three weights."""
    return match.token_scores(load(spark, d, "part").select("p_name"), "p_name", spark.createDataFrame(_TAGS, "code string, descr string"))


@query("""
WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS price, CAST(NULL AS VARCHAR) AS prio FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
b AS (SELECT o_custkey AS k, max(o_totalprice) AS price, max(o_orderpriority) AS prio FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
SELECT k, coalesce(a.price, b.price) AS price, coalesce(a.prio, b.prio) AS prio, CASE WHEN a.price IS NULL THEN 'right' WHEN b.price IS NULL THEN 'left' ELSE 'both' END AS origin FROM a FULL JOIN b USING (k)""")
def two_source_merge(spark: SparkSession, d: str) -> DataFrame:
    """Records of two sources merged, the left one first."""
    o = load(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    a = o.filter("o_orderstatus = 'F'").groupBy("k").agg(F.max("o_totalprice").alias("price"), F.lit(None).cast("string").alias("prio"))
    b = o.filter("o_orderstatus = 'O'").groupBy("k").agg(F.max("o_totalprice").alias("price"), F.max("o_orderpriority").alias("prio"))
    return match.merge_records(a, b, ["k"], ["price", "prio"])


@query("""
SELECT l_partkey AS code, min(l_suppkey) AS alias_of FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_partkey""")
def alias_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Codes without a record of their own point to the first one that covers them."""
    li = load(spark, d, "lineitem")
    covers = li.select(F.col("l_partkey").alias("code"), "l_suppkey")
    return reconcile.alias_rows(covers, li.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("code")).distinct(), "code", "l_suppkey")


@query("""
WITH r(req, pattern) AS (VALUES ('cold', 'cold|small'), ('warm', 'red|hot|large'), ('gear', 'gear|widget')),
h AS (SELECT req, p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN 0 WHEN p_size > 25 THEN 1 ELSE 2 END AS rank FROM part JOIN r ON regexp_matches(p_name, pattern)),
w AS (SELECT *, row_number() OVER (PARTITION BY req ORDER BY rank, p_partkey) AS place FROM h)
SELECT req, p_partkey, rank, CAST(place AS INT) AS place, CASE WHEN rank = 0 THEN 'matched' ELSE 'candidate' END AS status FROM w WHERE place <= 8""")
def requirement_topk(spark: SparkSession, d: str) -> DataFrame:
    """The eight best inputs of each requirement."""
    rules = spark.createDataFrame([("cold", "cold|small"), ("warm", "red|hot|large"), ("gear", "gear|widget")], "req string, pattern string")
    rank = F.when(F.col("p_type") == "PROMO", 0).when(F.col("p_size") > 25, 1).otherwise(2)
    hits = load(spark, d, "part").join(match.rule_side(rules), F.expr("p_name rlike pattern")).withColumn("rank", rank)
    return match.top_inputs(hits, "req", "rank", ["p_partkey"]).select("req", "p_partkey", "rank", "place", F.when(F.col("rank") == 0, "matched").otherwise("candidate").alias("status"))


@query(r"""
WITH w AS (SELECT p_partkey, p_type || ' ' || p_name AS text FROM part),
m AS (SELECT p_partkey, lower(text) AS t, regexp_extract_all(lower(text), '[0-9a-z]+') AS words FROM w)
SELECT p_partkey, (regexp_matches(t, '(^|[^0-9a-z])widget') AND regexp_matches(t, '(^|[^0-9a-z])economy') AND len(list_filter(words, lambda x: starts_with(x, 'widget') OR starts_with(x, 'economy'))) * 2 >= len(words)) AS loose,
  regexp_matches(t, 'widget.*economy') AS strict FROM m""")
def loose_match(spark: SparkSession, d: str) -> DataFrame:
    """An ordered pattern loosened to its parts, with half of the words explained."""
    text = F.concat_ws(" ", "p_type", "p_name")
    return load(spark, d, "part").select("p_partkey", match.loose_match(text, "widget.*economy|^widget").alias("loose"), F.lower(text).rlike("widget.*economy").alias("strict"))


@query("""
SELECT CASE WHEN p_name = 'red widget' THEN 'template' WHEN p_type = 'PROMO' OR regexp_matches(p_name, 'config|cold') THEN 'config' WHEN regexp_matches(p_name, 'alarm|hot') THEN 'alarm' WHEN p_type IN ('ECONOMY', 'STANDARD') OR regexp_matches(p_name, 'gear') THEN 'control' ELSE 'telemetry' END AS tier, count(*) AS n, min(p_partkey) AS first_part FROM part GROUP BY 1""")
def point_tier(spark: SparkSession, d: str) -> DataFrame:
    """An ordered cascade of tiers."""
    n, t = F.col("p_name"), F.col("p_type")
    tier = F.when(n == "red widget", "template").when((t == "PROMO") | n.rlike("config|cold"), "config").when(n.rlike("alarm|hot"), "alarm").when(t.isin("ECONOMY", "STANDARD") | n.rlike("gear"), "control").otherwise("telemetry")
    return load(spark, d, "part").groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_part"))


@query("""
WITH c AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
m AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: regexp_matches(x, '[0-9]'))) AS num, len(list_filter(w, lambda x: x = '|')) AS bars FROM c)
SELECT CASE WHEN n = 0 THEN 'empty' WHEN bars * 10 >= n THEN 'rating' WHEN num * 4 >= n THEN 'perf' WHEN n < 30 THEN 'dim' ELSE 'etc' END AS kind, count(*) AS n, min(doc_id) AS first_doc FROM m GROUP BY 1""")
def table_kind(spark: SparkSession, d: str) -> DataFrame:
    """A cascade over ratios of numeric cells."""
    w = load(spark, d, "documents").select("doc_id", F.filter(F.split("text", r"[\t\n\f\r ]+"), lambda x: x != "").alias("w"))
    m = w.select("doc_id", F.size("w").alias("n"), F.size(F.filter("w", lambda x: x.rlike("[0-9]"))).alias("num"), F.size(F.filter("w", lambda x: x == "|")).alias("bars"))
    kind = F.when(F.col("n") == 0, "empty").when(F.col("bars") * 10 >= F.col("n"), "rating").when(F.col("num") * 4 >= F.col("n"), "perf").when(F.col("n") < 30, "dim").otherwise("etc")
    return m.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


@query("""
WITH f AS (SELECT user_id, event_type AS family, count(*) AS n FROM events GROUP BY user_id, event_type),
w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, family) AS r FROM f)
SELECT user_id, family, n FROM w WHERE r = 1""")
def family_routing(spark: SparkSession, d: str) -> DataFrame:
    """The reader family with most rows wins."""
    f = load(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return f.groupBy("user_id").agg(F.min_by("event_type", F.struct(-F.col("n"), "event_type")).alias("family"), F.max("n").alias("n"))


@query("""
WITH b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS q FROM benchmark),
s AS (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type || ' the of and'), '[a-z0-9]+')) AS t FROM part),
j AS (SELECT item_id, p_partkey, len(list_intersect(q, t))::DOUBLE / len(list_distinct(list_concat(q, t))) AS score FROM b, s),
w AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, p_partkey) AS r FROM j)
SELECT item_id, p_partkey, round(score, 9) AS score, CASE WHEN score >= 0.999 THEN 'exact' WHEN score >= 0.75 THEN 'hit' WHEN score >= 0.6 THEN 'ambiguous' ELSE 'only-ours' END AS verdict FROM w WHERE r = 1""")
def jaccard_diff(spark: SparkSession, d: str) -> DataFrame:
    """Each item's most similar tag set with its verdict."""
    b = load(spark, d, "benchmark").select("item_id", S.tokens(F.col("text")).alias("q"))
    s = load(spark, d, "part").select("p_partkey", S.tokens(F.concat_ws(" ", "p_name", "p_type", F.lit("the of and"))).alias("t"))
    best = match.nearest_sets(b, s, "item_id", "q", "p_partkey", "t")
    verdict = F.when(F.col("score") >= 0.999, "exact").when(F.col("score") >= 0.75, "hit").when(F.col("score") >= 0.6, "ambiguous").otherwise("only-ours")
    return best.select("item_id", "p_partkey", F.round("score", 9).alias("score"), verdict.alias("verdict"))


@query("""
WITH e AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS kinds FROM events GROUP BY user_id)
SELECT user_id, array_to_string(list_sort(list_filter(kinds, lambda x: NOT list_contains(['view', 'click', 'login'], x))), ',') AS undeclared, array_to_string(list_sort(list_filter(['view', 'click', 'login'], lambda x: NOT list_contains(kinds, x))), ',') AS unused FROM e""")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    """Used but undeclared kinds, and declared but unused ones."""
    e = load(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    declared = F.array(*map(F.lit, ("view", "click", "login")))
    return e.select("user_id", F.array_join(F.array_sort(F.array_except("kinds", declared)), ",").alias("undeclared"), F.array_join(F.array_sort(F.array_except(declared, "kinds")), ",").alias("unused"))


@query("""
WITH s AS (SELECT p_brand, list_sort(list_distinct(list(p_type))) AS a FROM part WHERE p_size > 40 GROUP BY p_brand),
n AS (SELECT p_brand, list_sort(list_distinct(list(p_type))) AS b FROM part GROUP BY p_brand)
SELECT p_brand, array_to_string(list_concat(a, list_sort(list_filter(b, lambda x: NOT list_contains(a, x)))), ',') AS aliases, CAST(len(list_filter(b, lambda x: NOT list_contains(a, x))) AS BIGINT) AS n_new FROM s JOIN n USING (p_brand)""")
def additive_sync(spark: SparkSession, d: str) -> DataFrame:
    """New aliases appended to stored ones."""
    p = load(spark, d, "part")
    stored = p.filter("p_size > 40").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("a"))
    return reconcile.sync_aliases(stored, p.select("p_brand", "p_type"), "p_brand", "a", "p_type").withColumn("aliases", F.array_join("aliases", ","))


@query("""
WITH s AS (SELECT s_suppkey AS k, round(s_acctbal, 0) AS v, CASE s_suppkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'extracted' ELSE 'manual' END AS status FROM supplier WHERE s_acctbal > 0),
e AS (SELECT s_suppkey AS k, round(s_acctbal, 0) + CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END AS v FROM supplier WHERE s_acctbal < 8000)
SELECT k, CASE WHEN e.k IS NULL OR s.status IN ('verified', 'manual') THEN s.v ELSE e.v END AS v, coalesce(s.status, 'extracted') AS status,
  CASE WHEN s.k IS NULL THEN 'add' WHEN e.k IS NULL THEN CASE WHEN s.status IN ('verified', 'manual') THEN 'orphan' ELSE 'drop' END
    WHEN s.status IN ('verified', 'manual') THEN CASE WHEN s.v = e.v THEN 'keep' ELSE 'drift' END ELSE CASE WHEN s.v = e.v THEN 'same' ELSE 'update' END END AS action
FROM s FULL JOIN e USING (k)""")
def survivorship(spark: SparkSession, d: str) -> DataFrame:
    """Stored against proposed records: confirmed ones survive."""
    k = F.col("s_suppkey")
    s = load(spark, d, "supplier")
    value = F.round("s_acctbal", 0)
    stored = s.filter("s_acctbal > 0").select(k.alias("k"), value.alias("v"), F.when(k % 3 == 0, "verified").when(k % 3 == 1, "extracted").otherwise("manual").alias("status"))
    proposed = s.filter("s_acctbal < 8000").select(k.alias("k"), (value + F.when(k % 7 == 0, 1).otherwise(0)).alias("v"))
    return reconcile.survivorship(stored, proposed, ["k"], "v")


@query("""
WITH b AS (SELECT o_custkey AS k, max(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END) AS p1, max(CASE WHEN o_orderpriority LIKE '2%' THEN o_totalprice END) AS p2 FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
c AS (SELECT o_custkey AS k, max(CASE WHEN o_orderpriority LIKE '2%' THEN o_totalprice END) AS c1, max(CASE WHEN o_orderpriority LIKE '3%' THEN o_totalprice END) AS c2 FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey),
j AS (SELECT b.k, p1, p2, c1, c2, c.k IS NULL AS alone, coalesce(p1 <> c1, false) OR coalesce(p2 <> c2, false) AS bad FROM b LEFT JOIN c USING (k))
SELECT k, CASE WHEN bad THEN p1 ELSE coalesce(p1, c1) END AS p1, CASE WHEN bad THEN p2 ELSE coalesce(p2, c2) END AS p2, CASE WHEN alone THEN 'alone' WHEN bad THEN 'conflict' ELSE 'merged' END AS state FROM j""")
def continued_merge(spark: SparkSession, d: str) -> DataFrame:
    """Blanks of a row filled from its continued row, unless they disagree."""
    o = load(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    best = lambda prefix: F.max(F.when(F.col("o_orderpriority").startswith(prefix), F.col("o_totalprice")))
    base = o.filter("o_orderstatus = 'F'").groupBy("k").agg(best("1").alias("p1"), best("2").alias("p2"))
    more = o.filter("o_orderstatus = 'P'").groupBy("k").agg(best("2").alias("p1"), best("3").alias("p2"))
    return reconcile.fill_from_continued(base, more, ["k"], ["p1", "p2"])


@query("""
WITH k AS (SELECT n_chars AS code, lang, source FROM documents)
SELECT code, 'lang' AS field, count(DISTINCT lang) AS n_values FROM k GROUP BY code HAVING count(DISTINCT lang) > 1
UNION ALL SELECT code, 'source', count(DISTINCT source) FROM k GROUP BY code HAVING count(DISTINCT source) > 1""")
def duplicate_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Fields in which rows of one code differ."""
    k = load(spark, d, "documents").select(F.col("n_chars").alias("code"), "lang", "source")
    return reconcile.duplicate_conflicts(k, ["code"], ["lang", "source"])


@query("""
WITH a AS (SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS inst, min(event_id) AS name FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2, 3),
b AS (SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS inst, min(event_id) AS name FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2, 3),
j AS (SELECT a.user_id, count(*) AS both_n, count(*) FILTER (a.name % 10 = (b.name + 9) % 10) AS ok FROM a JOIN b USING (user_id, event_type, inst) GROUP BY a.user_id),
n AS (SELECT user_id, count(*) AS n FROM a GROUP BY user_id)
SELECT n.user_id, n.n, coalesce(both_n, 0) AS both_n, coalesce(2 * ok - both_n, 0) AS agree, CASE WHEN both_n > 0 THEN round(ok::DOUBLE / both_n, 6) END AS rate,
  CASE WHEN both_n IS NULL THEN 'blind' WHEN round(ok::DOUBLE / both_n, 6) >= 0.99 THEN 'machine' ELSE 'weak' END AS grade FROM n LEFT JOIN j USING (user_id)""")
def crosscheck_rate(spark: SparkSession, d: str) -> DataFrame:
    """Two independent readings compared per model: agreement, rate and grade."""
    e = load(spark, d, "events").withColumn("inst", F.floor(F.col("value") / 10))
    keys = ["user_id", "event_type", "inst"]
    a = e.filter("event_id % 2 = 0").groupBy(*keys).agg(F.min("event_id").alias("name"))
    b = e.filter("event_id % 2 = 1").groupBy(*keys).agg(F.min("event_id").alias("other"))
    both = a.join(b, keys, "left").withColumn("ok", F.when(F.col("other").isNotNull(), F.col("name") % 10 == (F.col("other") + 9) % 10))
    t = both.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count("other").alias("both_n"), F.coalesce(F.sum(F.when(F.col("ok"), 1).when(~F.col("ok"), -1)), F.lit(0)).alias("agree"), F.count_if("ok").alias("good"))
    rate = F.when(F.col("both_n") > 0, F.round(F.col("good") / F.col("both_n"), 6))
    return t.select("user_id", "n", "both_n", "agree", rate.alias("rate"), reconcile.verification_grade(F.lit(False), F.lit(False), rate).alias("grade"))


_EDGES = "SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    nation, region, supplier = (load(spark, d, t) for t in ("nation", "region", "supplier"))
    n = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"))
    r = region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("child"), F.lit("world").alias("parent"))
    s = supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("child"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("parent"))
    return n.unionByName(r).unionByName(s)


@query(f"""
WITH RECURSIVE e AS ({_EDGES}), c AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e UNION SELECT c.node, e.parent, c.depth + 1 FROM c JOIN e ON e.child = c.ancestor)
SELECT node, ancestor, min(depth) AS depth FROM c GROUP BY node, ancestor""")
def closure(spark: SparkSession, d: str) -> DataFrame:
    """All supertypes of a tree of suppliers, nations and regions."""
    return graph.closure(_edges(spark, d))


@query(f"""
WITH RECURSIVE e AS ({_EDGES}), c AS (SELECT child AS node, parent AS ancestor FROM e UNION SELECT c.node, e.parent FROM c JOIN e ON e.child = c.ancestor),
o(node, proto) AS (VALUES ('world', 'id'), ('r0', 'zone'), ('r1', 'site'), ('n1', 'code'), ('n1', 'id')),
i AS (SELECT node, proto FROM o UNION SELECT c.node, o.proto FROM c JOIN o ON o.node = c.ancestor)
SELECT node, string_agg(DISTINCT proto, ',' ORDER BY proto) AS protos FROM i GROUP BY node""")
def inherited_children(spark: SparkSession, d: str) -> DataFrame:
    """Own and inherited children of every node."""
    owned = spark.createDataFrame([("world", "id"), ("r0", "zone"), ("r1", "site"), ("n1", "code"), ("n1", "id")], "node string, proto string")
    found = graph.inherited(owned, graph.closure(_edges(spark, d)), "proto")
    return found.groupBy("node").agg(F.array_join(F.array_sort(F.collect_set("proto")), ",").alias("protos"))


_DEFS = [("equip", "widget"), ("cold-equip", "widget"), ("cold-equip", "cold"), ("gear", "gear"), ("red-gear", "red"), ("red-gear", "gear")]
_IS = [("cold-equip", "equip"), ("red-gear", "gear")]


@query(f"""
WITH d(def, part) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _DEFS)}), s(node, ancestor) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _IS)}),
z AS (SELECT def, count(DISTINCT part) AS np FROM d GROUP BY def),
t AS (SELECT DISTINCT p_partkey AS id, unnest(string_split(p_name, ' ')) AS tag FROM part),
w AS (SELECT id, def, np FROM (SELECT id, def, count(*) AS n FROM t JOIN d ON tag = part GROUP BY id, def) JOIN z USING (def) WHERE n = np),
o AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM w v JOIN s ON v.def = s.node WHERE v.id = w.id AND s.ancestor = w.def))
SELECT id, def FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY np DESC, def) AS r FROM o) WHERE r = 1""")
def most_specific(spark: SparkSession, d: str) -> DataFrame:
    """The most specific definition whose parts are all among a part's tags."""
    tags = load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.explode(F.split("p_name", " ")).alias("tag"))
    defs, up = spark.createDataFrame(_DEFS, "def string, part string"), spark.createDataFrame(_IS, "node string, ancestor string")
    return graph.most_specific(tags, defs, up)


@query(f"""
WITH RECURSIVE e AS (SELECT parent, child FROM ({_EDGES}) UNION ALL SELECT 'n3', 'world'),
t AS (SELECT 'world' AS root, 'world' AS node, ['world'] AS p, 0 AS depth, false AS gap UNION ALL SELECT t.root, e.child, list_append(t.p, e.child), t.depth + 1, list_contains(t.p, e.child) FROM t JOIN e ON e.parent = t.node WHERE NOT t.gap AND t.depth < 6)
SELECT root, node, array_to_string(p, '/') AS path, depth, gap FROM t""")
def expansion_tree(spark: SparkSession, d: str) -> DataFrame:
    """The tree below a root with a cycle cut as a gap."""
    loop = spark.createDataFrame([("world", "n3")], "child string, parent string")
    edges = _edges(spark, d).unionByName(loop)
    return graph.expand(edges, spark.createDataFrame([("world",)], "node string"))


@query("""
WITH t AS (SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ',') AS tag_set, p_name FROM part)
SELECT tag_set, count(*) AS n, min(p_name) AS first, max(p_name) AS last FROM t GROUP BY tag_set HAVING count(*) > 1""")
def tag_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Leaves with equal tag sets."""
    return graph.tag_collisions(load(spark, d, "part").select("p_name", F.split("p_name", " ").alias("tags")), "tags", "p_name")
