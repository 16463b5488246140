"""Walking a small ontology: closure, inherited children, most specific definitions, expansion trees.

The walks are breadth-first joins, each round's frontier a written table; they end when
nothing new is found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.match import rule_side
from tessera.scratch import materialize

MAX_DEPTH = 6


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(node, ancestor, depth) of all supertypes, with the shortest depth; cycles end where nothing new appears."""
    step = materialize(edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).filter("ancestor is not null").distinct(), "edges")
    found = frontier = step.withColumn("depth", F.lit(1))
    depth = 1
    while True:
        depth += 1
        reached = frontier.alias("f").join(step.alias("s"), F.col("f.ancestor") == F.col("s.node")).select(F.col("f.node"), F.col("s.ancestor")).distinct()
        fresh = materialize(reached.join(found.select("node", "ancestor"), ["node", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if not fresh.limit(1).count():
            return found
        frontier = fresh
        found = found.unionByName(fresh)


def with_parts(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, parent): the edges and one from every hyphenated name to each of its parts."""
    plain = edges.select(F.col(child).alias("child"), F.col(parent).alias("parent"))
    names = plain.select(F.col("child").alias("name")).unionByName(plain.select(F.col("parent").alias("name"))).filter(F.contains("name", F.lit("-"))).distinct()
    parts = names.select(F.col("name").alias("child"), F.explode(F.split("name", "-")).alias("parent")).filter("parent <> '' and parent <> child")
    return plain.unionByName(parts).distinct()


def inherited(owned: DataFrame, ancestors: DataFrame, value: str) -> DataFrame:
    """(node, value) over a node's own values and those of its ancestors, distinct.  owned: node, value."""
    up = ancestors.select("node", "ancestor").join(owned.select(F.col("node").alias("ancestor"), value), "ancestor").select("node", value)
    return owned.select("node", value).unionByName(up).distinct()


def most_specific(tags: DataFrame, definitions: DataFrame, ancestors: DataFrame) -> DataFrame:
    """id and def: definitions whose parts are all among a row's tags, without ancestors of other such definitions; most parts, then name.

    tags: id, tag.  definitions: def, part.
    """
    sizes = definitions.groupBy("def").agg(F.countDistinct("part").alias("n_parts"))
    hits = tags.distinct().join(rule_side(definitions.distinct()), F.col("tag") == F.col("part")).groupBy("id", "def").agg(F.count(F.lit(1)).alias("n"))
    whole = hits.join(rule_side(sizes), "def").filter("n = n_parts").select("id", "def", "n_parts")
    covered = whole.join(rule_side(ancestors), F.col("def") == F.col("node")).select("id", F.col("ancestor").alias("def")).distinct()
    open_ = whole.join(covered, ["id", "def"], "left_anti")
    return open_.groupBy("id").agg(F.min_by("def", F.struct(-F.col("n_parts"), F.col("def"))).alias("def"))


def expand(edges: DataFrame, roots: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(root, node, path, depth, gap) of the tree below each root; a node that repeats on its path ends there with a gap.

    edges: parent, child.  Every path is a row: its text is the nodes joined by `/`.
    """
    level = roots.select(F.col("node").alias("root"), "node", F.array("node").alias("path"), F.lit(0).alias("depth"), F.lit(False).alias("gap"))
    found = level
    for depth in range(1, max_depth + 1):
        below = level.filter(~F.col("gap")).alias("l").join(edges.alias("e"), F.col("l.node") == F.col("e.parent"))
        level = below.select("l.root", F.col("e.child").alias("node"), F.concat("l.path", F.array("e.child")).alias("path"), F.lit(depth).alias("depth"), F.array_contains("l.path", F.col("e.child")).alias("gap"))
        found = found.unionByName(level)
    return found.select("root", "node", F.array_join("path", "/").alias("path"), "depth", "gap")


def tag_collisions(leaves: DataFrame, tags: str, name: str) -> DataFrame:
    """tag set, number of leaves that carry it, the first and the last of them, and whether the first has the shortest name of all.

    The first leaf is the one of the shortest name, then the smallest.
    """
    rank = F.struct(F.length(name), F.col(name))
    same = leaves.groupBy(F.array_sort(tags).alias("tag_set")).agg(F.count(F.lit(1)).alias("n"), F.min_by(name, rank).alias("first"), F.max(name).alias("last")).filter("n > 1")
    return same.select(F.array_join("tag_set", ",").alias("tag_set"), "n", "first", "last")


def resolved(sets: DataFrame, definitions: DataFrame, ancestors: DataFrame, kind: str) -> DataFrame:
    """tags and target: for every distinct tag set the most specific definition of that kind all of whose parts it has.

    sets: tags (a sorted array).  The kind itself is no answer.
    """
    keyed = sets.select("tags").distinct().withColumn("id", F.to_json("tags"))
    of_kind = ancestors.filter(F.col("ancestor") == kind).select(F.col("node").alias("def")).distinct()
    found = most_specific(keyed.select("id", F.explode("tags").alias("tag")), definitions.join(of_kind, "def", "left_semi").filter(F.col("def") != kind), ancestors)
    return keyed.join(found, "id").select("tags", F.col("def").alias("target"))


def choices(definitions: DataFrame, ancestors: DataFrame, flatten: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(for, node: what a definition may hand down; for, def, part, n: compounds of n parts that it may), both written tables.

    flatten: def, choice.  What is a choice of a definition or below one may be handed down, and so may
    the parts of compound definitions that are; compounds of the nodes' own kind say what a node is,
    not where it belongs, and don't count.
    """
    is_a = ancestors.select("node", "ancestor").unionByName(definitions.select(F.col("def").alias("node"), F.col("def").alias("ancestor"))).unionByName(flatten.select(F.col("choice").alias("node"), F.col("choice").alias("ancestor")))
    chosen = is_a.join(flatten.select(F.col("def").alias("for"), F.col("choice").alias("ancestor")), "ancestor").select("for", "node").distinct()
    sizes = definitions.groupBy("def").agg(F.countDistinct("part").alias("n")).filter("n > 1")
    own_kind = ancestors.filter(F.col("ancestor") == kind).select(F.col("node").alias("def"))
    chosen = materialize(chosen, "chosen")
    compounds = definitions.distinct().join(sizes, "def").join(own_kind, "def", "left_anti").join(chosen.select("for", F.col("node").alias("def")), "def")
    return chosen, materialize(compounds.select("for", "def", "part", "n"), "compounds")


def carried_tags(nodes: DataFrame, chosen: DataFrame, compounds: DataFrame) -> DataFrame:
    """id and carry (sorted): what nodes (id, target, tags) hand down to their children, of their own tags and those handed to them.

    A compound's parts are handed down if the node has all of them.
    """
    tags = nodes.select("id", "target", F.explode("tags").alias("tag"))
    plain = tags.join(chosen, (F.col("target") == F.col("for")) & (F.col("tag") == F.col("node"))).select("id", "tag")
    hits = tags.join(compounds, (F.col("tag") == F.col("part")) & (F.col("target") == F.col("for"))).groupBy("id", "def").agg(F.collect_set("tag").alias("tags"), F.first("n").alias("n")).filter(F.size("tags") == F.col("n"))
    both = plain.unionByName(hits.select("id", F.explode("tags").alias("tag")))
    return both.groupBy("id").agg(F.array_sort(F.collect_set("tag")).alias("carry"))


def expand_sets(protos: DataFrame, definitions: DataFrame, ancestors: DataFrame, flatten: DataFrame, roots: DataFrame, kind: str = "equip", wildcards: tuple[tuple[str, ...], ...] = (), max_depth: int = MAX_DEPTH) -> DataFrame:
    """root, path, label, is_leaf, tags, target, depth and gap of every node of the trees below roots, with tags handed down on the way.

    protos: def, tags (the tag sets of its children); definitions: def, part; ancestors: node,
    ancestor; flatten: def, choice; roots: def.  A child with the tag `kind` is resolved to a
    definition and expanded in turn: what it hands down (carried_tags) is part of the tags of all
    below it.  A gap names why a node isn't expanded: no definition, a cycle, or the depth.  Tag sets
    among `wildcards` are no children.  Each level's frontier is a written table.
    """
    definitions, ancestors = materialize(definitions.distinct(), "definitions"), materialize(ancestors.distinct(), "ancestors")
    sets = materialize(protos.select(F.col("def").alias("of"), F.array_sort(F.array_distinct("tags")).alias("proto")).distinct(), "protos")
    for wild in wildcards:
        sets = sets.filter(F.col("proto") != F.array(*map(F.lit, sorted(wild))))
    targets = materialize(resolved(sets.filter(F.array_contains("proto", kind)).select(F.col("proto").alias("tags")), definitions, ancestors, kind), "targets")
    chosen, compounds = choices(definitions, ancestors, flatten, kind)
    none = F.array().cast("array<string>")
    frontier = roots.select(F.col("def").alias("root"), F.col("def").alias("at"), none.alias("carry"), F.array("def").alias("chain"), none.alias("path"))
    found = None
    for depth in range(max_depth + 1):
        level = frontier.join(sets, F.col("at") == F.col("of")).join(targets.select(F.col("tags").alias("proto"), "target"), "proto", "left")
        inner = F.array_contains("proto", kind)
        why = F.when(~inner, None).when(F.col("target").isNull(), "no definition").when(F.array_contains("chain", F.col("target")), "cycle").when(F.lit(depth >= max_depth), "depth")
        level = level.select("root", "path", F.array_join("proto", " ").alias("label"), (~inner).alias("is_leaf"), F.array_sort(F.array_union("proto", "carry")).alias("tags"), F.when(inner, F.col("target")).alias("target"), F.lit(depth).alias("depth"), why.alias("gap"), "chain")
        level = materialize(level.withColumn("id", F.monotonically_increasing_id()), "level")
        found = level if found is None else found.unionByName(level)
        open_ = level.filter("not is_leaf and gap is null")
        if not open_.limit(1).count():
            break
        down = carried_tags(open_.select("id", "target", "tags"), chosen, compounds)
        frontier = open_.join(down, "id", "left").select("root", F.col("target").alias("at"), F.coalesce("carry", none).alias("carry"), F.concat("chain", F.array("target")).alias("chain"), F.concat("path", F.array("label")).alias("path"))
    return found.select("root", F.array_join("path", "/").alias("path"), "label", "is_leaf", F.array_join("tags", " ").alias("tags"), "target", "depth", "gap")
