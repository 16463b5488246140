"""Queries with order-dependent operators, aggregates and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import gates, order, publish
from tessera.plans.registry import query
from tessera.sources.tables import load


@query("""
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_wins_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """First event of each user and type."""
    return order.first_wins(load(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""
WITH m AS (SELECT user_id, ts, max(event_id) AS signup FROM events WHERE event_type = 'signup' GROUP BY user_id, ts)
SELECT e.event_id, m.signup FROM events e ASOF LEFT JOIN m ON e.user_id = m.user_id AND e.ts >= m.ts""")
def asof_caption(spark: SparkSession, d: str) -> DataFrame:
    """The last signup at or before each event of a user."""
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    marks = e.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("mark"))
    return order.as_of(e.drop("event_type"), marks, ["user_id"], "ts", "mark", "signup").select("event_id", "signup")


@query("""
WITH s AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events),
g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > 21600000000 THEN 1 ELSE 0 END AS st FROM s),
c AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS cluster FROM g)
SELECT user_id, CAST(cluster AS BIGINT) AS cluster, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM c GROUP BY user_id, cluster""")
def gap_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user clustered by gaps of six hours."""
    e = load(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    c = order.gap_clusters(e, ["user_id"], "us", 6 * 3600 * 1_000_000, ["event_id"])
    return c.groupBy("user_id", F.col("cluster").cast("long").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query("""
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list_distinct(list(event_type))) AS kinds FROM events GROUP BY user_id, CAST(ts AS DATE)),
n AS (SELECT *, lag(kinds) OVER w AS b, lead(kinds) OVER w AS a FROM p WINDOW w AS (PARTITION BY user_id ORDER BY day))
SELECT user_id, CAST(day AS VARCHAR) AS day, array_to_string(kinds, ',') AS kinds, len(kinds) >= 3 OR coalesce(list_has_any(kinds, b), false) OR coalesce(list_has_any(kinds, a), false) AS is_table FROM n""")
def neighbour_page(spark: SparkSession, d: str) -> DataFrame:
    """Days with three kinds of events, or a kind shared with the day before or after."""
    p = load(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    marked = order.neighbour_overlap(p, "kinds", ["user_id"], ["day"], 3, "is_table")
    return marked.select("user_id", F.col("day").cast("string").alias("day"), F.array_join("kinds", ",").alias("kinds"), "is_table")


@query("""
WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS mark FROM lineitem)
SELECT l_orderkey, l_linenumber, last_value(mark IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS section FROM m""")
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    """A section carried down an order's lines."""
    m = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).alias("mark"))
    return order.forward_fill(m, "mark", ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "section").select("l_orderkey", "l_linenumber", "section")


@query("""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
f AS (
  SELECT user_id, event_id, event_type, rn, 0 AS segment, [event_type] AS used FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.event_id, e.event_type, e.rn, f.segment + CASE WHEN list_contains(f.used, e.event_type) THEN 1 ELSE 0 END,
    CASE WHEN list_contains(f.used, e.event_type) THEN [e.event_type] ELSE list_append(f.used, e.event_type) END
  FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
SELECT user_id, event_id, event_type, segment FROM f""")
def key_reuse_segments(spark: SparkSession, d: str) -> DataFrame:
    """A user's events cut wherever a type comes again since the last cut."""
    return order.key_reuse_segments(load(spark, d, "events"), ["user_id"], ["event_id"], "event_type").select("user_id", "event_id", "event_type", "segment")


@query("""
WITH RECURSIVE b AS (
  SELECT l_orderkey AS o, l_linenumber AS ln, l_suppkey AS lo, l_suppkey + l_partkey % 40 AS hi, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_suppkey + l_partkey % 40) AS rn FROM lineitem),
f AS (
  SELECT o, ln, lo, hi, rn, 0 AS band, hi AS top FROM b WHERE rn = 1
  UNION ALL
  SELECT b.o, b.ln, b.lo, b.hi, b.rn, f.band + CASE WHEN b.lo > f.top THEN 0 ELSE 1 END, CASE WHEN b.lo > f.top THEN greatest(f.top, b.hi) ELSE b.hi END
  FROM f JOIN b ON b.o = f.o AND b.rn = f.rn + 1)
SELECT o AS l_orderkey, ln AS l_linenumber, lo AS low, hi AS high, band FROM f""")
def band_groups(spark: SparkSession, d: str) -> DataFrame:
    """Address blocks of an order joined while they rise above the band before."""
    b = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("low"), (F.col("l_suppkey") + F.col("l_partkey") % 40).alias("high"))
    return order.band_groups(b, ["l_orderkey"], ["l_linenumber"], "low", "high").select("l_orderkey", "l_linenumber", "low", "high", "band")


@query("""
WITH RECURSIVE r AS (
  SELECT p_brand AS scope, p_name AS item, max(p_size) AS score, 1 AS ord, 'warm' AS rule FROM part WHERE regexp_matches(p_name, 'red|hot|warm|large') GROUP BY p_brand, p_name
  UNION ALL SELECT p_brand, p_name, max(p_size), 2, 'widget' FROM part WHERE regexp_matches(p_name, 'widget|gear') GROUP BY p_brand, p_name
  UNION ALL SELECT p_brand, p_name, max(p_size), 3, 'any' FROM part GROUP BY p_brand, p_name),
s AS (SELECT DISTINCT scope FROM r),
f AS (
  SELECT scope, 0 AS ord, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS item FROM s
  UNION ALL
  SELECT f.scope, f.ord + 1, CASE WHEN c.item IS NULL THEN f.used ELSE list_append(f.used, c.item) END, c.item
  FROM f LEFT JOIN LATERAL (SELECT item FROM r WHERE r.scope = f.scope AND r.ord = f.ord + 1 AND NOT list_contains(f.used, r.item) ORDER BY score DESC, item LIMIT 1) c ON true
  WHERE f.ord < 3)
SELECT scope, CASE ord WHEN 1 THEN 'warm' WHEN 2 THEN 'widget' ELSE 'any' END AS rule, item FROM f WHERE ord > 0 AND item IS NOT NULL""")
def greedy_assign(spark: SparkSession, d: str) -> DataFrame:
    """Rules in order claim part names of a brand, each once."""
    p = load(spark, d, "part").groupBy(F.col("p_brand").alias("scope"), F.col("p_name").alias("item")).agg(F.max("p_size").alias("score"))
    rules = [(1, "warm", "red|hot|warm|large"), (2, "widget", "widget|gear"), (3, "any", "")]
    hits = F.filter(F.array(*(F.when(F.col("item").rlike(x), F.struct(F.lit(o).alias("ord"), F.lit(n).alias("rule"))) for o, n, x in rules)), lambda h: h.isNotNull())
    candidates = p.select("scope", "item", "score", F.explode(hits).alias("h")).select("scope", "item", "score", "h.ord", "h.rule")
    return order.greedy_assignment(candidates, ["scope"], "ord", "rule", "item", "score")


@query("""
WITH m AS (SELECT conv_id, turn, role = 'user' AS l, role <> 'user' AS v FROM conversations),
n AS (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nt, lead(v) OVER (PARTITION BY conv_id ORDER BY turn) AS nv FROM m)
SELECT conv_id, turn, nt AS value_at FROM n WHERE l AND nv""")
def pair_consumption(spark: SparkSession, d: str) -> DataFrame:
    """A user's turn answered by the next turn of another role."""
    c = load(spark, d, "conversations").select("conv_id", "turn", "role")
    return order.consume_pairs(c, ["conv_id"], "turn", F.col("role") == "user", F.col("role") != "user")


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, l_returnflag, min(CASE WHEN l_returnflag = 'N' THEN l_linenumber END) OVER (PARTITION BY l_orderkey) AS cut, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS st FROM lineitem)
SELECT l_orderkey, CAST(CASE WHEN cut IS NOT NULL AND cut > st AND l_linenumber >= cut THEN 1 ELSE 0 END AS INT) AS part, count(*) AS n FROM c GROUP BY 1, 2""")
def split_at_mark(spark: SparkSession, d: str) -> DataFrame:
    """An order's lines cut at the first marked one, both halves not empty."""
    s = order.split_at_first(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "N", "part")
    return s.groupBy("l_orderkey", "part").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH s AS (SELECT conv_id, turn, text, CASE WHEN role = 'assistant' AND lag(1) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT NULL THEN 0 ELSE 1 END AS st FROM conversations),
i AS (SELECT *, sum(st) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS island FROM s)
SELECT conv_id, min(turn) AS turn, sha256(string_agg(text, ' ' ORDER BY turn, text)) AS text_sha256, count(*) AS n_parts FROM i GROUP BY conv_id, island""")
def continuation_stitch(spark: SparkSession, d: str) -> DataFrame:
    """Continuation rows appended to the row they continue."""
    c = load(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    s = order.stitch(c, ["conv_id"], "turn", F.col("role") == "assistant", "text")
    return s.select("conv_id", "turn", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "n_parts")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS channel FROM lineitem""")
def channel_numbering(spark: SparkSession, d: str) -> DataFrame:
    """Channels numbered per kind over tagged rows."""
    n = order.numbered(load(spark, d, "lineitem"), ["l_returnflag", "l_orderkey"], ["l_linenumber", "l_partkey"], F.col("l_linestatus") == "F", "channel")
    return n.select("l_orderkey", "l_linenumber", "channel")


@query("""
SELECT event_type, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY event_type ORDER BY n DESC, first_seen LIMIT 3""")
def tally_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Most common types; ties by first appearance."""
    t = load(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_seen"))
    return t.orderBy(F.desc("n"), "first_seen").limit(3)


@query("""
SELECT c_mktsegment AS segment, round(avg(CASE WHEN o.n > 0 THEN 100.0::DOUBLE ELSE 0 END), 6) AS fill, count(*) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) o ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def fill_rate(spark: SparkSession, d: str) -> DataFrame:
    """Share of customers with any settled order per segment."""
    some = load(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(1))
    c = load(spark, d, "customer").select("c_custkey", "c_mktsegment").join(some, "c_custkey", "left")
    return c.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.round(F.avg(F.when(F.col("hit").isNotNull(), 100.0).otherwise(0.0)), 6).alias("fill"), F.count(F.lit(1)).alias("n"))


@query("""
WITH m AS (SELECT s_nationkey, list_sort(list(s_acctbal)) AS v FROM supplier GROUP BY s_nationkey)
SELECT s.s_suppkey, s.s_nationkey, v[len(v) // 2 + 1] AS peer_median, s.s_acctbal < 0.5::DOUBLE * v[len(v) // 2 + 1] AS thin FROM supplier s JOIN m USING (s_nationkey)""")
def peer_median_gate(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers below half of their nation's upper median."""
    s = load(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return gates.below_peers(s, "s_nationkey", "s_acctbal").select("s_suppkey", "s_nationkey", "peer_median", "thin")


@query("""
WITH i AS (SELECT o_custkey, count(*) AS both_n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END), 4) AS rate FROM orders GROUP BY o_custkey)
SELECT c_mktsegment, sum(round_even(rate * both_n, 0)) / sum(both_n) AS rate, CAST(sum(both_n) AS BIGINT) AS n FROM i JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""")
def weighted_rate(spark: SparkSession, d: str) -> DataFrame:
    """Rates of parts merged by their weights, half-even as the sums were."""
    i = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("both_n"), F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)), 4).alias("rate"))
    j = i.join(load(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    return j.groupBy("c_mktsegment").agg((F.sum(F.bround(F.col("rate") * F.col("both_n"), 0)) / F.sum("both_n")).alias("rate"), F.sum("both_n").alias("n"))


@query("""
SELECT source, count(DISTINCT lang) AS n_langs, count(DISTINCT n_chars // 200 * 200) AS n_bins, CAST(max(n_chars // 200 * 200) AS BIGINT) AS top_bin, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY source""")
def distinct_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Distinct counts and length bins."""
    b = load(spark, d, "documents").withColumn("bin", F.floor(F.col("n_chars") / 200) * 200)
    return b.groupBy("source").agg(
        F.countDistinct("lang").alias("n_langs"), F.countDistinct("bin").alias("n_bins"), F.max("bin").alias("top_bin"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs")
    )


@query("""
SELECT 'documents' AS layer, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'turns', count(*) FROM conversations
UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'lines', CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) FROM documents""")
def layer_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every layer."""
    one = lambda name, table, n: load(spark, d, table).agg(n.alias("n")).select(F.lit(name).alias("layer"), "n")
    count = F.count(F.lit(1))
    parts = [one("documents", "documents", count), one("pages", "pages", count), one("turns", "conversations", count), one("labels", "labels", count), one("lines", "documents", F.sum(F.size(F.split("text", "\n"))))]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


@query("""
SELECT l_suppkey, CASE l_linenumber % 3 WHEN 0 THEN 'LonTalk' WHEN 1 THEN 'Modbus' ELSE 'BACnet' END AS protocol, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def protocol_mix(spark: SparkSession, d: str) -> DataFrame:
    """Rows per model and protocol."""
    k = F.col("l_linenumber") % 3
    return load(spark, d, "lineitem").groupBy("l_suppkey", F.when(k == 0, "LonTalk").when(k == 1, "Modbus").otherwise("BACnet").alias("protocol")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT p_partkey, p_name, p_size FROM part ORDER BY CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END, p_size, p_name, p_partkey LIMIT 60 OFFSET 60""")
def natural_sort_page(spark: SparkSession, d: str) -> DataFrame:
    """Second page of parts by numbers first, then text."""
    p = load(spark, d, "part").withColumn("cell", F.when(F.col("p_type") != "PROMO", F.concat_ws(" ", F.col("p_size").cast("string"), "p_name")))
    keys = [S.absent(F.col("cell")).asc(), F.col("p_size").asc(), F.col("p_name").asc(), F.col("p_partkey").asc()]
    return publish.page(p, keys, 1).select("p_partkey", "p_name", "p_size")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """The 50 orders after a key, by a predicate that reaches the scan (EP paging)."""
    return publish.keyset_page(load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey", 100)


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS b FROM lineitem),
p AS (SELECT *, max(b) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS phase FROM s)
SELECT CASE WHEN phase = 1 THEN 'input' ELSE 'output' END AS phase, l_linenumber, count(*) AS n FROM p GROUP BY 1, 2""")
def phase_state(spark: SparkSession, d: str) -> DataFrame:
    """A phase carried from row to row, set by a boundary row."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").rowsBetween(Window.unboundedPreceding, 0)
    p = load(spark, d, "lineitem").withColumn("seen", F.max(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).over(w))
    return p.groupBy(F.when(F.col("seen") == 1, "input").otherwise("output").alias("phase"), "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, string_split(p_name || ' ' || p_type, ' ') AS tok, [10, 20] AS amps FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey, l_linenumber, CAST(i AS INT) AS opt, tok[i] AS volt, CAST(CASE WHEN i <= 2 THEN amps[i] ELSE amps[2] END AS INT) AS amp FROM (SELECT *, unnest(range(1, len(tok) + 1)) AS i FROM t)""")
def option_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per option of a multi-token cell; shorter lists repeat their last token."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    t = li.join(load(spark, d, "part").select("p_partkey", "p_name", "p_type"), "p_partkey")
    amps = F.array(F.lit(10), F.lit(20))
    rows = t.select("l_orderkey", "l_linenumber", F.posexplode(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")).alias("i", "volt"))
    return rows.select("l_orderkey", "l_linenumber", (F.col("i") + 1).alias("opt"), "volt", F.coalesce(F.try_element_at(amps, F.col("i") + 1), F.element_at(amps, -1)).alias("amp"))


@query("""
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY o_orderpriority""")
def transposed_table(spark: SparkSession, d: str) -> DataFrame:
    """Rows turned into columns by a label."""
    wide = load(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return wide.select("o_orderpriority", *(F.coalesce(F.col(c), F.lit(0)).alias(c.lower()) for c in "FOP"))


@query("""
WITH b AS (SELECT s_suppkey AS band, s_suppkey * 20.0::DOUBLE AS lo, s_suppkey * 20.0::DOUBLE + 12.5 AS hi FROM supplier)
SELECT band, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS keys FROM part JOIN b ON p_partkey >= lo AND p_partkey < hi GROUP BY band""")
def interval_join(spark: SparkSession, d: str) -> DataFrame:
    """Points in bands, joined on cells."""
    from tessera.operators.match import containing

    k = F.col("s_suppkey")
    bands = load(spark, d, "supplier").select(k.alias("band"), (k * 20.0).alias("lo"), (k * 20.0 + 12.5).alias("hi"))
    hits = containing(load(spark, d, "part").select("p_partkey"), bands, "p_partkey", "lo", "hi", 16)
    return hits.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"))
