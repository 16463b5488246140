"""Merkle manifest of a dataset: a persistent tree of hashes whose versions share what they don't change.

1. Every row is a leaf: the SHA-256 of its fields, each with its length before it.
2. Leaves ascend by doc_id in the tree of their group (lang); places come from a range sort.
3. A tree is cut into aligned blocks of 8^4 places.  A task builds the four levels above one
   block; the blocks' roots are the places of the next, 4,096 times shorter table, until a
   tree is one node.  The groups' roots are places of one more tree of the same kind.
4. A change of a leaf makes a version of the tree.  It copies the leaf's ancestors only: first
   those in the leaf's block, then, with the runs of siblings that the block's root meets on
   its way up, those of the upper levels.  All other nodes are those of the tree before, so
   versions never wait for each other and none of them meets in one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, small_batches
from tessera.llm.ranks import in_order, placed, ranked, spans

FANOUT = 8
#: Levels that one task builds above an aligned block.
BLOCK_LEVELS = 4
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Where a node stands on its way to the root: digests of its siblings left and right of it, a pair a level.
PATHS = "tree long, place long, lefts array<string>, rights array<string>, subroot string"
VERSIONS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, changed_leaf string, copied array<string>, folded_root string"


def field(col: Column) -> Column:
    """A value as its byte count, a colon and its text; null as a dash."""
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def lower_capitals(col: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed."""
    return F.translate(col, CAPITALS, CAPITALS.lower())


def parent(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def depth(total: int, fanout: int = FANOUT) -> int:
    """Levels above so many leaves."""
    levels = 0
    while total > 1:
        total, levels = -(-total // fanout), levels + 1
    return levels


def block_tree(digests: list[str], levels: int, fanout: int = FANOUT) -> list[list[str]]:
    """The nodes above an aligned block's first row, level by level; the last level is one node."""
    tree = [digests]
    for _ in range(levels):
        below = tree[-1]
        tree.append([parent(below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return tree


def siblings(tree: list[list[str]], place: int, fanout: int = FANOUT) -> list[tuple[str, str]]:
    """(digests left of it, digests right of it) of a place and its ancestors in their runs, level by level."""
    found = []
    for level in tree[:-1]:
        first = place - place % fanout
        found.append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        place //= fanout
    return found


def copied_path(digest: str, way: list[tuple[str, str]]) -> list[str]:
    """The nodes of a new version: the ancestors of a changed node, from its parent up; their other children are shared."""
    copied = []
    for left, right in way:
        digest = parent([left, digest, right])
        copied.append(digest)
    return copied


def _columns(table: pa.Table, *names: str) -> list[list]:
    return [table.column(n).to_pylist() for n in names]


def _tree_of(table: pa.Table, fanout: int, block_levels: int) -> tuple[list[int], list[list[str]]]:
    """Places in order and the nodes of a block's rows (place, total, digest)."""
    rows = sorted(zip(*_columns(table, "place", "total", "digest"), strict=True))
    return [p for p, _, _ in rows], block_tree([d for _, _, d in rows], min(block_levels, depth(rows[0][1], fanout)), fanout)


def paths_to_root(nodes: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, place, lefts, rights, subroot of nodes (tree, place, total, digest; a written table): each node's way to its tree's root."""
    size = fanout**block_levels
    blocked = nodes.withColumn("block", F.floor(F.col("place") / size).cast("long"))
    if (nodes.agg(F.max("total")).first()[0] or 0) <= size:

        def whole(table: pa.Table) -> pa.Table:
            places, tree = _tree_of(table, fanout, block_levels)
            ways = [siblings(tree, k, fanout) for k in range(len(places))]
            return _paths(table.column("tree")[0].as_py(), places, ways, tree[-1][0])

        return materialize(blocked.groupBy("tree").applyInArrow(whole, PATHS), "paths")

    upper = paths_to_root(block_roots(nodes, fanout, block_levels), fanout, block_levels)

    def joined(table: pa.Table, above: pa.Table) -> pa.Table:
        places, tree = _tree_of(table, fanout, block_levels)
        lefts, rights, subroots = _columns(above, "lefts", "rights", "subroot")
        ahead = list(zip(lefts[0], rights[0], strict=True))
        ways = [siblings(tree, k, fanout) + ahead for k in range(len(places))]
        return _paths(table.column("tree")[0].as_py(), places, ways, subroots[0])

    above = upper.withColumnRenamed("place", "block")
    return materialize(blocked.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(joined, PATHS), "paths")


def _paths(tree: int, places: list[int], ways: list[list[tuple[str, str]]], subroot: str) -> pa.Table:
    texts = pa.list_(pa.string())
    columns = [pa.array([tree] * len(places), pa.int64()), pa.array(places, pa.int64())]
    columns += [pa.array([[pair[side] for pair in way] for way in ways], texts) for side in (0, 1)]
    return pa.Table.from_arrays([*columns, pa.array([subroot] * len(places), pa.string())], ["tree", "place", "lefts", "rights", "subroot"])


def block_roots(nodes: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The nodes above the aligned blocks of nodes (tree, place, total, digest), with the same columns, as a written table."""
    size = fanout**block_levels

    def root(table: pa.Table) -> pa.Table:
        places, tree = _tree_of(table, fanout, block_levels)
        total = table.column("total")[0].as_py()
        row = [table.column("tree")[0].as_py(), places[0] // size, -(-total // size)]
        return pa.Table.from_arrays([*(pa.array([v], pa.int64()) for v in row), pa.array([tree[-1][0]])], ["tree", "place", "total", "digest"])

    blocked = nodes.select("tree", "place", "total", "digest", F.floor(F.col("place") / size).cast("long").alias("block"))
    return materialize(blocked.groupBy("tree", "block").applyInArrow(root, "tree long, place long, total long, digest string"), "roots")


def manifest(leaves: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The tree over leaves (lang, doc_id, leaf, changed_leaf) and a version of it for every row with a changed leaf.

    Per row: doc_id, leaf, subroot, root, proof_sha256 (of the siblings on the way to the root),
    changed_leaf, copied (the nodes of the row's version: the leaf's ancestors from its parent to
    the root, empty without a change) and folded_root (that version's root; without a change the
    root as it follows from the leaf and its siblings).
    """
    size = fanout**block_levels
    rows = in_order(leaves, ["lang"], ["doc_id", "leaf", "changed_leaf"], "leaves")
    held = materialize(spans(rows, ["lang"]), "spans")
    groups = ranked(held.groupBy("lang").agg(F.count(F.lit(1)).alias("parts")), [], ["lang"], "groups")
    groups = materialize(groups.select(F.col("lang").alias("of"), F.col("place").alias("tree"), F.col("total").alias("trees")), "groups")
    held = held.join(groups, held["lang"].eqNullSafe(groups["of"])).select(*held.columns, "tree", "trees")
    nodes = materialize(placed(rows, held, ["lang"]).withColumn("digest", F.col("leaf")).drop("lang", "at", "part", "ahead", "trees"), "nodes")

    roots = block_roots(nodes, fanout, block_levels)
    inner = paths_to_root(roots, fanout, block_levels)
    # One row per group, found at the first block of its tree.
    tops = inner.filter(F.col("place") == 0).join(groups, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("total"), F.col("subroot").alias("digest"))
    top = paths_to_root(materialize(tops, "tops"), fanout, block_levels)
    top = top.select(F.col("place").alias("tree"), F.col("lefts").alias("top_lefts"), F.col("rights").alias("top_rights"), F.col("subroot").alias("root"))
    upper = inner.join(top, "tree").select("tree", F.col("place").alias("block"), F.concat("lefts", "top_lefts").alias("lefts"), F.concat("rights", "top_rights").alias("rights"), "subroot", "root")

    def versions(table: pa.Table, above: pa.Table) -> pa.Table:
        _, tree = _tree_of(table, fanout, block_levels)
        lefts, rights, subroots, root_of = _columns(above, "lefts", "rights", "subroot", "root")
        ahead, subroot, root = list(zip(lefts[0], rights[0], strict=True)), subroots[0], root_of[0]
        ahead_text = "".join(left + right for left, right in ahead).encode()
        found = []
        ordered = sorted(zip(*_columns(table, "place", "doc_id", "leaf", "changed_leaf"), strict=True), key=lambda r: r[0])
        for k, (_, doc_id, leaf, changed) in enumerate(ordered):
            inside = siblings(tree, k, fanout)
            proof = hashlib.sha256("".join(left + right for left, right in inside).encode())
            proof.update(ahead_text)
            nodes = copied_path(leaf if changed is None else changed, inside + ahead)
            folded = nodes[-1] if nodes else leaf if changed is None else changed
            found.append((doc_id, leaf, subroot, root, proof.hexdigest(), changed, [] if changed is None else nodes, folded))
        text = pa.string()
        kinds = [pa.int64(), *[text] * 5, pa.list_(text), text]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "changed_leaf", "copied", "folded_root"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names)

    blocked = nodes.withColumn("block", F.floor(F.col("place") / size).cast("long"))
    return blocked.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(versions, VERSIONS)


def document_leaves(docs: DataFrame) -> DataFrame:
    """lang, doc_id, leaf, changed_leaf of every row of docs, as a written table: the change lower-cases A-Z of the text where 3 divides crc32(doc_id).

    A row whose doc_id is null has no decimal form and isn't changed.
    """
    values = [F.col(c) for c in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(chosen, leaf_of([*values[:-1], lower_capitals(F.col("text"))]))
    rows = docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), leaf_of(values).alias("leaf"), changed.alias("changed_leaf"))
    return materialize(rows, "leaves")


def verified_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs (doc_id, source, lang, n_chars, text).

    Null fields are dashes, an empty text is "0:".  The null lang is a group of its own, first;
    rows without an id come first in their group; rows of one id, repeated ones included, are
    leaves each, ordered by their digests.  A group of one leaf has the leaf as its root, and so
    has a table of one row.  An empty table gives no row.
    """
    small_batches(docs.sparkSession)
    found = manifest(document_leaves(docs))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: CRC-32 of the text s in DuckDB, given the table `crc` of its 256 remainders as `tab`.
CRC_TABLE = """crc AS (
  SELECT list(list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM (SELECT unnest(range(256)) AS n))"""
CRC_OF = "xor(list_reduce(list_concat([4294967295], list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in [*FIELDS[:-1], text]) + ")"


def _levels_sql(name: str, start: str) -> str:
    """Recursive levels of trees: (tree, level, place, total, digest)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, place, total, digest FROM {start}
  UNION ALL
  SELECT tree, level + 1, place // 8, (any_value(total) + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM {name} WHERE total > 1 GROUP BY tree, level, place // 8)"""


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT *, {_leaf_sql("text")} AS leaf,
    CASE WHEN {CRC_OF.format(s="doc_id::VARCHAR")} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')")} END AS changed
  FROM documents, crc),
langs AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees FROM (SELECT DISTINCT lang FROM documents)),
rows_ AS (
  SELECT l.doc_id, l.leaf, l.changed, g.tree, g.trees, count(*) OVER (PARTITION BY g.tree) AS total,
    row_number() OVER (PARTITION BY g.tree ORDER BY l.doc_id NULLS FIRST, l.leaf) - 1 AS place
  FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang),
first AS (SELECT tree, place, total, leaf AS digest FROM rows_),
{_levels_sql("nodes", "first")},
subroots AS (SELECT tree, digest FROM nodes WHERE total = 1),
second AS (SELECT -1 AS tree, s.tree AS place, (SELECT count(*) FROM subroots) AS total, s.digest FROM subroots s),
{_levels_sql("tops", "second")},
steps AS (
  SELECT 0 AS tops, tree, level, place, total, digest FROM nodes UNION ALL SELECT 1, tree, level, place, total, digest FROM tops),
ways AS (
  SELECT a.tops, a.tree, a.level, a.place,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lefts,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rights
  FROM steps a JOIN steps b ON a.tops = b.tops AND a.tree = b.tree AND a.level = b.level AND a.place // 8 = b.place // 8
  WHERE a.total > 1 GROUP BY a.tops, a.tree, a.level, a.place),
trail AS (
  SELECT r.tree AS leaf_tree, r.place AS leaf_place, w.tops, w.level, w.lefts, w.rights FROM rows_ r JOIN ways w ON w.tops = 0 AND w.tree = r.tree AND w.place = r.place // (8 ** w.level)::BIGINT
  UNION ALL
  SELECT r.tree, r.place, w.tops, w.level, w.lefts, w.rights FROM rows_ r JOIN ways w ON w.tops = 1 AND w.place = r.tree // (8 ** w.level)::BIGINT),
folded AS (
  SELECT leaf_tree, leaf_place, sha256(string_agg(lefts || rights, '' ORDER BY tops, level)) AS proof, list({{'l': lefts, 'r': rights}} ORDER BY tops, level) AS way
  FROM trail GROUP BY leaf_tree, leaf_place),
done AS (
  SELECT r.doc_id, r.leaf, s.digest AS subroot, (SELECT digest FROM tops WHERE total = 1) AS root, coalesce(f.proof, sha256('')) AS proof_sha256,
    list_reduce(list_concat([{{'l': coalesce(r.changed, r.leaf), 'r': ''}}], coalesce(f.way, [])), lambda d, w: {{'l': sha256(w.l || d.l || w.r), 'r': ''}}).l AS folded_root
  FROM rows_ r JOIN subroots s ON s.tree = r.tree LEFT JOIN folded f ON f.leaf_tree = r.tree AND f.leaf_place = r.place)
SELECT *, folded_root = root AS verified FROM done
"""
