"""Prefix trie of conversations with what sharing its nodes saves, by the Euler-tour technique.

1. Turns are range-sorted by conversation and turn.  A prefix is known by the exclusive or of
   128-bit digests of (place, turn), a running aggregate that crosses partitions by one row per
   partition and conversation, so that a long conversation is never one task's.
2. Prefixes of one length and digest are a node; its members are counted and their least kept.
3. Siblings are ranked by their least member.  Each node has an arc that enters it and one that
   leaves it: from entering a node the tour enters its first child or leaves it, from leaving it
   the tour enters the next sibling or leaves the parent.
4. The tour is list-ranked (list_rank).  Arcs of nearby conversations lie in one block, so most
   of the tour is followed inside blocks.
5. Sums over a subtree are differences of running sums along the tour, at leaving and entering.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_SQL, materialize, small_batches
from tessera.llm.list_rank import FINAL_LINKS, NONE, list_places
from tessera.llm.merkle import CRC_OF, CRC_TABLE
from tessera.llm.ranks import in_order, placed, ranked, running_sums, spans

#: Conversations of one group start from its first one, with up to this many turns.
GROUP, HEADS = 20, 3
#: Bits of a node's number that count inside a block of the list ranking: 65,536 nodes.
BLOCK_BITS = 16
#: Ids of ended conversations in one row.
IDS_PER_ROW = 4096
KEY = ["depth", "k1", "k2"]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_SQL)).cast("long")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (of role and text), words of every turn of a conversation, as a written table; null role or text is empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull())
    return materialize(rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), word_count(text).alias("words")), "turns")


def _marks() -> list[Column]:
    """Two halves of the digest of a turn at its place."""
    return [F.xxhash64(F.lit(k), F.col("depth"), F.col("digest")).alias(f"x{k}") for k in (1, 2)]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (digest of the first `depth` turns), p1, p2 (of one turn less), words (of the last), ended; a written table.

    Conversation c has the first h turns of conversation c - c % 20, then its own behind its first h, h = crc32(c) % 4.
    """
    rows = in_order(turn_rows(conversations), ["conv_id"], ["turn", "digest"], "turns")
    held = materialize(spans(rows, ["conv_id"]), "spans")
    convs = held.groupBy("conv_id").agg(F.max("total").alias("n"))
    convs = convs.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEADS + 1)).alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    firsts = convs.filter(F.col("conv_id") == F.col("base")).select(F.col("conv_id").alias("first_id"), F.col("n").alias("first_n"))
    convs = convs.join(firsts, F.col("base") == F.col("first_id"), "left").withColumn("heads", F.least("h", F.coalesce("first_n", F.lit(0))))
    convs = materialize(convs.select("conv_id", "h", "base", "heads", (F.col("heads") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")

    held = held.join(convs.select(F.col("conv_id").alias("c"), "h", "heads", "length"), F.col("conv_id") == F.col("c")).drop("c")
    at = materialize(placed(rows, held, ["conv_id"]), "placed")
    given = at.filter((F.col("conv_id") % GROUP == 0) & (F.col("place") < HEADS)).select(F.col("conv_id").alias("from"), (F.col("place") + 1).alias("depth"), "digest", "words")
    taken = convs.join(given, (F.col("base") == F.col("from")) & (F.col("depth") <= F.col("h"))).select("conv_id", "depth", "length", "words", *_marks())
    run = Window.partitionBy("conv_id").orderBy("depth")
    taken = materialize(taken.select("conv_id", "depth", "length", "words", "x1", "x2", *(F.bit_xor(f"x{k}").over(run).alias(f"k{k}") for k in (1, 2))), "heads")

    own = at.filter(F.col("place") >= F.col("h")).withColumn("depth", F.col("place") - F.col("h") + F.col("heads") + 1)
    own = materialize(own.select("conv_id", "part", "at", "depth", "length", "words", *_marks()), "own")
    parts = own.groupBy("part", "conv_id").agg(*(F.bit_xor(f"x{k}").alias(f"part{k}") for k in (1, 2)))
    start = taken.groupBy("conv_id").agg(*(F.bit_xor(f"x{k}").alias(f"start{k}") for k in (1, 2))).withColumnRenamed("conv_id", "c")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    earlier = parts.select("part", "conv_id", *(F.coalesce(F.bit_xor(f"part{k}").over(before), zero).alias(f"part{k}") for k in (1, 2))).join(start, F.col("conv_id") == F.col("c"), "left")
    earlier = earlier.select("part", "conv_id", *(F.col(f"part{k}").bitwiseXOR(F.coalesce(f"start{k}", zero)).alias(f"ahead{k}") for k in (1, 2)))
    inside = Window.partitionBy("part", "conv_id").orderBy("at")
    sums = own.join(earlier, ["part", "conv_id"]).withColumns({f"k{k}": F.bit_xor(f"x{k}").over(inside).bitwiseXOR(F.col(f"ahead{k}")) for k in (1, 2)})

    columns = ["conv_id", "depth", "length", "words", "x1", "x2", "k1", "k2"]
    steps = taken.select(*columns).unionByName(sums.select(*columns))
    steps = steps.select("conv_id", "depth", "k1", "k2", *(F.col(f"k{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"p{k}") for k in (1, 2)), "words", (F.col("depth") == F.col("length")).alias("ended"))
    root = convs.select("conv_id", zero.alias("depth"), *(zero.alias(c) for c in ("k1", "k2", "p1", "p2", "words")), (F.col("length") == 0).alias("ended"))
    return materialize(steps.unionByName(root), "steps")


def ends_of(steps: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of nodes at which conversations end: the hash of their ids, ascending, joined by commas.

    Ids are sorted over all partitions and joined there; what meets per node is a row per
    IDS_PER_ROW of them, read as a stream.
    """
    kinds = "depth long, k1 long, k2 long"
    ended = materialize(steps.filter("ended").select(*KEY, "conv_id"), "ended")

    def join(batches):
        for batch in batches:
            rows, last = [], None
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last or len(rows[-1][1]) >= IDS_PER_ROW:
                    rows.append((key, []))
                    last = key
                rows[-1][1].append(conv)
            keys = [pa.array([k[c] for k, _ in rows], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array([i[0] for _, i in rows], pa.int64()), pa.array([",".join(map(str, i)) for _, i in rows], pa.string())], [*KEY, "first", "ids"])

    def digest(batches):
        last, running = None, None
        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    if last is not None:
                        done.append((*last, running.hexdigest()))
                    last, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            yield _ends(done)
        if last is not None:
            yield _ends([(*last, running.hexdigest())])

    sorted_ = ended.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    joined = sorted_.mapInArrow(join, f"{kinds}, first long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, f"{kinds}, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"])


def trie_nodes(steps: DataFrame) -> DataFrame:
    """node, conv_id, depth, k1, k2, parent, parent_conv_id, n_convs, saved (by the node alone), rank among its siblings and their number; a written table.

    node is a number that ascends with conv_id and depth.
    """
    nodes = steps.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words"))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    nodes = in_order(materialize(nodes, "nodes"), ["conv_id"], ["depth"], "nodes").withColumnRenamed("at", "node").drop("part", "words")
    root = nodes.filter(F.col("depth") == 0).first()
    root_id, root_conv = (root["node"], root["conv_id"]) if root else (None, None)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("d"), F.col("k1").alias("a1"), F.col("k2").alias("a2"))
    columns = ["node", "conv_id", *KEY, "parent", "parent_conv_id", "n_convs", "saved"]
    # A parent may have a third of all nodes as children: Spark splits such partitions of the join, and the root's children need none.
    deep = nodes.filter(F.col("depth") > 1).join(above, (F.col("p1") == F.col("a1")) & (F.col("p2") == F.col("a2")) & (F.col("depth") - 1 == F.col("d")))
    high = nodes.filter(F.col("depth") == 1).withColumns({"parent": F.lit(root_id).cast("long"), "parent_conv_id": F.lit(root_conv).cast("long")})
    top = nodes.filter(F.col("depth") == 0).withColumns({"parent": F.lit(None).cast("long"), "parent_conv_id": F.lit(None).cast("long")})
    family = deep.select(*columns).unionByName(high.select(*columns)).unionByName(top.select(*columns))
    return materialize(ranked(materialize(family, "family"), ["parent"], ["conv_id"], "siblings").withColumnsRenamed({"place": "rank", "total": "siblings"}), "ranked")


def tour(nodes: DataFrame) -> DataFrame:
    """id, next, block, leaves, saved of the arcs of the Euler tour: 2 * node enters, 2 * node + 1 leaves; and n_children on entering arcs."""
    eldest = nodes.filter((F.col("rank") == 0) & F.col("parent").isNotNull()).select(F.col("parent").alias("of"), F.col("node").alias("child"), F.col("siblings").alias("n_children"))
    younger = nodes.filter(F.col("parent").isNotNull() & (F.col("rank") > 0)).select(F.col("parent").alias("its_parent"), (F.col("rank") - 1).alias("its_rank"), F.col("node").alias("sibling"))
    both = nodes.join(eldest, F.col("node") == F.col("of"), "left").join(younger, (F.col("parent") == F.col("its_parent")) & (F.col("rank") == F.col("its_rank")), "left")
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    leaf = F.col("child").isNull()
    zero = F.lit(0).cast("long")
    arcs = F.array(
        F.struct(enter.alias("id"), F.when(leaf, leave).otherwise(F.col("child") * 2).alias("next"), leaf.cast("long").alias("leaves"), F.col("saved").alias("saved"), F.coalesce("n_children", zero).alias("n_children")),
        F.struct(leave.alias("id"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(NONE).cast("long")).alias("next"), zero.alias("leaves"), zero.alias("saved"), zero.alias("n_children")),
    )
    return materialize(both.select(F.shiftright("node", BLOCK_BITS).alias("block"), F.explode(arcs).alias("arc")).select("block", "arc.*"), "arcs")


def prefix_trie(conversations: DataFrame, final: int = FINAL_LINKS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the trie of rebuilt conversations.

    conversations: conv_id, turn, role, text.  Turns ascend, null first; turns of one number are
    ordered by the digest of their role and text, and repeated rows are turns each.  Null role and
    text are empty.  Rows without conv_id are no conversation's and are left out.  An empty table
    has no node; a conversation that is rebuilt without turns ends at the root.  Prefixes are told
    apart by digests of 128 bits.
    """
    small_batches(conversations.sparkSession, 10_000)
    steps = rebuilt(conversations)
    nodes = trie_nodes(steps)
    arcs = tour(nodes)
    places = list_places(arcs.select("id", "next", "block"), "block", final)
    ordered = materialize(arcs.select("id", "leaves", "saved", "n_children").join(places, "id"), "tour")
    sums = running_sums(ordered.select("id", "place", "leaves", "saved"), "place", ["leaves", "saved"])
    sign = F.when(F.col("id") % 2 == 1, 1).otherwise(-1)
    below = sums.groupBy(F.shiftright("id", 1).alias("of")).agg(F.sum(sign * F.col("leaves")).alias("leaves_below"), F.sum(sign * F.col("saved")).alias("saved_below"))
    own = ordered.filter(F.col("id") % 2 == 0).select(F.shiftright("id", 1).alias("v"), "leaves", "n_children")
    found = nodes.join(own, F.col("node") == F.col("v")).join(below, F.col("node") == F.col("of"))
    ends = ends_of(steps)
    same = (found["depth"] == ends["depth"]) & (found["k1"] == ends["k1"]) & (found["k2"] == ends["k2"])
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.join(ends, same, "left").select(
        "conv_id", found["depth"], "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves_below") + F.col("leaves")).alias("n_leaves"), (F.col("saved_below") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )


#: The trie in DuckDB: prefixes as joined digests, subtrees by the prefixes of each node's least member.
ORACLE = f"""
WITH {CRC_TABLE},
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM turns),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC_OF.format(s="conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
pieces AS (
  SELECT c.conv_id, 0 AS piece, p.place, p.digest, p.text FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, p.place, p.digest, p.text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY piece, place) AS depth, count(*) OVER (PARTITION BY conv_id) AS length FROM pieces),
steps AS (
  SELECT conv_id, depth, sha256(string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS key, len(regexp_extract_all(text, '{WORD_SQL}')) AS words, depth = length AS ended FROM numbered
  UNION ALL
  SELECT c.conv_id, 0, '', 0, NOT EXISTS (SELECT 1 FROM pieces p WHERE p.conv_id = c.conv_id) FROM convs c),
nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM steps GROUP BY depth, key),
family AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent_key
  FROM nodes n LEFT JOIN steps s ON s.conv_id = n.conv_id AND s.depth = n.depth - 1 LEFT JOIN nodes p ON p.depth = s.depth AND p.key = s.key),
children AS (SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM family WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT f.*, coalesce(c.n_children, 0) AS n_children FROM family f LEFT JOIN children c ON c.depth = f.depth AND c.key = f.key),
below AS (
  SELECT s.depth, s.key, count(*) FILTER (n.n_children = 0) AS n_leaves, CAST(sum(n.saved) AS BIGINT) AS saved_tokens
  FROM counted n JOIN steps s ON s.conv_id = n.conv_id AND s.depth <= n.depth GROUP BY s.depth, s.key)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, b.n_leaves, b.saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.depth = c.depth AND b.key = c.key
"""
