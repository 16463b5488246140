"""Matching against ordered dictionaries of rules, and joins other than plain equality.

Rules are metadata: a bounded, hand-written dictionary.  Each function that broadcasts
them goes through `rule_side`, which counts first and leaves larger tables to Spark's own
choice of join.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.order import greedy_assignment
from tessera.scratch import materialize

MAX_RULES = 20_000
#: Pairs that one partition makes.
PAIRS = 2_000_000


def rule_side(rules: DataFrame) -> DataFrame:
    """The rules, broadcast if they are few."""
    return F.broadcast(rules) if rules.limit(MAX_RULES + 1).count() <= MAX_RULES else rules


def first_match(df: DataFrame, text: str, rules: Sequence[tuple[str, str]], out: str, default: str | None = None) -> DataFrame:
    """The payload of the first rule (pattern, payload) found in the text, regardless of case.

    A dictionary known when the query is written becomes one CASE expression: no join, and
    later patterns are not tried once one fits.
    """
    found = F.lit(default)
    for pattern, payload in reversed(list(rules)):
        found = F.when(F.coalesce(F.col(text), F.lit("")).rlike(f"(?i){pattern}"), payload).otherwise(found)
    return df.withColumn(out, found)


def first_match_join(df: DataFrame, id_columns: Sequence[str], text: str, rules: DataFrame) -> DataFrame:
    """The same with rules in a table (ord, pattern, payload): the payload with the smallest ord per row, null without a match."""
    hits = df.select(*id_columns, text).join(rule_side(rules), F.expr(f"`{text}` rlike concat('(?i)', pattern)"), "left")
    return hits.groupBy(*id_columns).agg(F.min_by("payload", "ord").alias("payload"), F.min("ord").alias("ord"))


def by_evidence(df: DataFrame, text: str, sets: Sequence[tuple[str, Sequence[str], int]], out: str) -> DataFrame:
    """The class whose rule set (name, patterns, need) has most distinct patterns in the text, at least `need`; the first on ties."""
    scored = []
    for name, patterns, need in sets:
        hits = sum((F.when(F.col(text).rlike(f"(?i){p}"), 1).otherwise(0) for p in patterns), F.lit(0))
        scored.append((name, hits, need))
    best: Column = F.greatest(*(F.when(h >= need, h).otherwise(0) for _, h, need in scored)) if len(scored) > 1 else scored[0][1]
    found = F.lit(None).cast("string")
    for name, hits, need in reversed(scored):
        found = F.when((hits >= need) & (hits == best), name).otherwise(found)
    return df.withColumn(f"{out}_hits", best).withColumn(out, found)


def by_evidence_or_title(df: DataFrame, text: str, title: str, sets: Sequence[tuple[str, Sequence[str], int]], titles: Sequence[tuple[str, str]]) -> DataFrame:
    """df with class and reason: the class by evidence in the text, else by the first title rule (class, pattern), else none."""
    found = by_evidence(df, text, sets, "__class")
    named = F.lit(None).cast("string")
    why = F.lit("not enough evidence")
    for name, pattern in reversed(list(titles)):
        hit = F.coalesce(F.col(title), F.lit("")).rlike(f"(?i){pattern}")
        named = F.when(hit, name).otherwise(named)
        why = F.when(hit, F.concat(F.lit("title: "), F.regexp_extract(F.col(title), f"(?i){pattern}", 0))).otherwise(why)
    reason = F.when(F.col("__class").isNotNull(), F.concat(F.lit("evidence: "), F.col("__class_hits").cast("string"))).otherwise(why)
    return found.withColumn("class", F.coalesce("__class", named)).withColumn("reason", reason).drop("__class", "__class_hits")


def longest_prefix(df: DataFrame, key: str, ids: Sequence[str], profiles: DataFrame) -> DataFrame:
    """ids and profile: the profile (profile, prefix, ord) with the longest prefix of the key; the smallest ord on ties.

    Profiles with a null prefix are the fallback.
    """
    hits = df.select(*ids, key).join(rule_side(profiles), F.col("prefix").isNull() | F.startswith(F.col(key), F.col("prefix")), "left")
    rank = F.struct(F.coalesce(F.length("prefix"), F.lit(-1)), -F.col("ord"))
    return hits.groupBy(*ids).agg(F.max_by("profile", rank).alias("profile"))


def containing(points: DataFrame, bands: DataFrame, value: str, low: str, high: str, width: int, by: Sequence[str] = ()) -> DataFrame:
    """Pairs of points and the bands [low, high) that hold them.

    Bands are cut into cells of `width`; a point looks only into its own cell, so the join
    is one on equality whatever the number of bands.
    """
    cut = bands.withColumn("__cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1e-9) / width))))
    placed = points.withColumn("__cell", F.floor(F.col(value) / width))
    return placed.join(cut, [*by, "__cell"]).filter((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("__cell")


def best_overlap(left: DataFrame, right: DataFrame, key: Sequence[str], a: str, b: str, order: str) -> DataFrame:
    """For each group a of left the group b of right that shares most keys; the smallest order on ties: a, b, n.

    Groups with the same keys, told by a digest of them, share alike: one of each kind is
    compared, so equal groups, however many, make no pairs.
    """

    def kinds(df: DataFrame, group: str, rank: Column) -> tuple[DataFrame, DataFrame]:
        rows = df.select(*key, F.col(group).alias("__g"), rank.alias("__o")).distinct()
        digest = [F.bit_xor(F.xxhash64(*key)).alias("__d1"), F.bit_xor(F.xxhash64(F.lit(1), *key)).alias("__d2"), F.count(F.lit(1)).alias("__d3")]
        of = rows.groupBy("__g", "__o").agg(*digest)
        heads = of.groupBy("__d1", "__d2", "__d3").agg(F.min(F.struct("__o", "__g")).alias("__head"))
        named = of.join(heads, ["__d1", "__d2", "__d3"]).select("__g", "__o", "__head")
        return named, rows.join(heads.select(F.col("__head.__g").alias("__g")), "__g", "left_semi")

    named, x = kinds(left, a, F.lit(0))
    _, y = kinds(right, b, F.col(order))
    pairs = x.select(*key, F.col("__g").alias("__a")).join(y.select(*key, F.col("__g").alias("__b"), "__o"), list(key)).groupBy("__a", "__b", "__o").agg(F.count(F.lit(1)).alias("n"))
    best = pairs.groupBy("__a").agg(F.max_by("__b", F.struct("n", -F.col("__o"))).alias(b), F.max("n").alias("n"))
    return named.select(F.col("__g").alias(a), F.col("__head.__g").alias("__a")).join(best, "__a").select(a, b, "n")


def same_or_contained(a: Column, b: Column, least: int = 4) -> Column:
    """Whether two names are equal once squeezed to letters and digits, or one of at least `least` characters holds the other."""
    x, y = (F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "") for c in (a, b))
    shorter = F.least(F.length(x), F.length(y))
    return (x == y) | ((shorter >= least) & (F.contains(x, y) | F.contains(y, x)))


def token_scores(names: DataFrame, name: str, tags: DataFrame) -> DataFrame:
    """name, code and weight: 3 where a token is the code, 2 where it is part of the code, 1 where it stands in the description.

    tags: code, descr.  Each kind of match is its own join on equality over exploded tokens.
    """
    words = names.select(name, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), F.lit(0)))).alias("token")).distinct()
    code = tags.select("code", F.lower("code").alias("token"), F.lit(3).alias("weight"))
    part = tags.select("code", F.explode(F.array_distinct(F.split(F.lower("code"), "[-_]"))).alias("token"), F.lit(2).alias("weight"))
    text = tags.select("code", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("descr"), F.lit("[a-z0-9]+"), F.lit(0)))).alias("token"), F.lit(1).alias("weight"))
    keyed = code.unionByName(part).unionByName(text).filter("token <> ''").groupBy("token", "code").agg(F.max("weight").alias("weight"))
    return words.join(rule_side(keyed), "token").groupBy(name, "code").agg(F.max("weight").alias("weight"))


_INNERMOST = re.compile(r"\([^()]*\)")
_GAP = re.compile(r"\.[*+?]")


def loose_parts(include: str) -> list[list[str]]:
    """An ordered pattern's alternatives as parts that must all occur, in any order.

    Alternatives tied to the start or end and those of one part are left out: loosening
    them would match too much.
    """
    groups: list[str] = []

    def put_away(found: re.Match[str]) -> str:
        groups.append(found.group())
        return f"<{len(groups) - 1}>"

    def bring_back(text: str) -> str:
        for k in reversed(range(len(groups))):
            text = text.replace(f"<{k}>", groups[k])
        return text

    # Groups are put away from the inside out; what is left has bars and gaps of the outermost level only.
    flat = include
    while _INNERMOST.search(flat):
        flat = _INNERMOST.sub(put_away, flat)
    alternatives = [x for x in flat.split("|") if not (x.startswith("^") or x.endswith("$"))]
    parts = [[bring_back(p) for p in _GAP.split(x) if p.strip()] for x in alternatives]
    return [p for p in parts if len(p) > 1 and min(len(re.findall(r"\w", x.replace("_", ""))) for x in p) >= 3]


def loose_match(text: Column, include: str) -> Column:
    """Whether all parts of one alternative occur and explain at least half of the text's words."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[0-9a-z]+"), F.lit(0))
    found = F.lit(False)
    for parts in loose_parts(include.lower()):
        every = F.lit(True)
        for p in parts:
            every = every & F.lower(text).rlike(rf"(^|[^0-9a-z]){p}")
        used = F.size(F.filter(words, lambda w: F.exists(F.array(*map(F.lit, parts)), lambda p: F.startswith(w, p))))
        found = found | (every & (used * 2 >= F.size(words)))
    return found


def assign_templates(names: DataFrame, by: str, item: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """by, rule, item and status (matched, loose, missing) of every rule (rule, pattern) in every `by`.

    Rules in order claim the smallest name that fits their pattern and no earlier rule claimed.
    A second pass offers the names that are left to the rules that are left, by loose_match.
    """
    listed = F.array(*(F.struct(F.lit(k).alias("ord"), F.lit(r).alias("rule")) for k, (r, _) in enumerate(rules)))
    wanted = names.select(by).distinct().select(by, F.explode(listed).alias("x")).select(by, "x.ord", "x.rule")

    def candidates(df: DataFrame, fits: Sequence[Column]) -> DataFrame:
        hits = F.array(*(F.when(fit, F.struct(F.lit(k).alias("ord"), F.lit(r).alias("rule"))) for k, ((r, _), fit) in enumerate(zip(rules, fits, strict=True))))
        return df.select(by, item, F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("x")).select(by, "x.ord", "x.rule", F.col(item).alias("item"), F.lit(0).alias("score"))

    strict = candidates(names, [F.lower(item).rlike(p) for _, p in rules])
    first = materialize(greedy_assignment(strict, [by], "ord", "rule", "item", "score"), "claims")
    left = wanted.join(first, [by, "rule"], "left_anti")
    free = names.join(first.select(by, F.col("item").alias(item)), [by, item], "left_anti")
    loose = candidates(free, [loose_match(F.col(item), p) for _, p in rules]).join(left.select(by, "rule"), [by, "rule"], "left_semi")
    second = greedy_assignment(loose, [by], "ord", "rule", "item", "score")
    claims = first.withColumn("status", F.lit("matched")).unionByName(second.withColumn("status", F.lit("loose")))
    return wanted.join(claims, [by, "rule"], "left").select(by, "rule", "item", F.coalesce("status", F.lit("missing")).alias("status"))


def requirement_status(df: DataFrame, by: str, kind: str, text: str, strong: Column, rules: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """by, name, status and n_kinds of every requirement (name, field, context, exclude) in every `by`.

    A row is a hit where the field's pattern and the context's are found and the exclusion's is
    not; empty patterns ask nothing.  One strong hit makes it matched, any hit a candidate.
    """
    fits = [F.col(text).rlike(f) & (F.lit(not c) | F.col(text).rlike(c)) & ~(F.lit(bool(x)) & F.col(text).rlike(x)) for _, f, c, x in rules]
    named = F.array(*(F.when(fit, name) for (name, *_), fit in zip(rules, fits, strict=True)))
    hits = df.select(by, kind, strong.alias("strong"), F.explode(F.filter(named, lambda x: x.isNotNull())).alias("name"))
    kinds = hits.groupBy(by, "name", kind).agg(F.bool_or("strong").alias("strong"))
    found = kinds.groupBy(by, "name").agg(F.bool_or("strong").alias("strong"), F.count(F.lit(1)).alias("n_kinds"))
    wanted = df.select(by).distinct().select(by, F.explode(F.array(*(F.lit(name) for name, *_ in rules))).alias("name"))
    status = F.when(F.col("strong"), "matched").when(F.col("n_kinds") > 0, "candidate").otherwise("missing")
    return wanted.join(found, [by, "name"], "left").select(by, "name", status.alias("status"), F.coalesce("n_kinds", F.lit(0)).alias("n_kinds"))


def top_inputs(hits: DataFrame, requirement: str, rank: str, order: Sequence[str], keep: int = 8) -> DataFrame:
    """The best `keep` inputs of each requirement by rank, then order, with their place from 1."""
    place = F.row_number().over(Window.partitionBy(requirement).orderBy(rank, *order))
    return hits.withColumn("place", place).filter(F.col("place") <= keep)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two arrays of distinct elements; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def merge_records(left: DataFrame, right: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per key of either side; the left value wins where both have one; origin says who contributed."""
    a, b = left.select(*key, *(F.col(f).alias(f"__l_{f}") for f in fields), F.lit(1).alias("__l")), right.select(*key, *(F.col(f).alias(f"__r_{f}") for f in fields), F.lit(1).alias("__r"))
    both = a.join(b, list(key), "full_outer")
    origin = F.when(F.col("__l").isNull(), "right").when(F.col("__r").isNull(), "left").otherwise("both")
    return both.select(*key, *(F.coalesce(f"__l_{f}", f"__r_{f}").alias(f) for f in fields), origin.alias("origin"))


def contained_names(left: DataFrame, right: DataFrame, by: Sequence[str], name: str, other: str, least: int = 4) -> DataFrame:
    """Rows (by, name, other) of names that are equal once squeezed, or hold each other, under one `by`.

    Both sides are cut down to distinct names first, and meet only where they share a piece of
    `least` letters or digits: a held name's first piece stands in the name that holds it.
    Shorter names can only be equal.
    """
    bare = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")
    x = left.select(*by, name, bare(F.col(name)).alias("__x")).distinct()
    y = right.select(*by, other, bare(F.col(other)).alias("__y")).distinct()
    pieces = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (least - 1)), lambda k: F.substring(c, k, F.lit(least))))
    long_x, long_y = x.filter(F.length("__x") >= least), y.filter(F.length("__y") >= least)
    in_y = long_x.withColumn("__piece", F.substring("__x", 1, least)).join(long_y.withColumn("__piece", F.explode(pieces(F.col("__y")))), [*by, "__piece"]).filter(F.contains("__y", F.col("__x")))
    in_x = long_y.withColumn("__piece", F.substring("__y", 1, least)).join(long_x.withColumn("__piece", F.explode(pieces(F.col("__x")))), [*by, "__piece"]).filter(F.contains("__x", F.col("__y")))
    short = x.withColumn("__piece", F.col("__x")).join(y.withColumn("__piece", F.col("__y")), [*by, "__piece"])
    columns = [*by, name, other]
    return in_y.select(*columns).unionByName(in_x.select(*columns)).unionByName(short.select(*columns)).distinct()


def pairs_of_names(names: DataFrame, left: DataFrame, right: DataFrame, by: Sequence[str], name: str, a: str, other: str, b: str, most: int = PAIRS) -> DataFrame:
    """a and b of all pairs of rows (by, name, a) and (by, other, b) whose names are a row of names (by, name, other).

    How many pairs each `other` makes is counted first: pairs are made in as many partitions as
    leave each about `most`, and an `other` with more is dealt over several by its left rows.
    """
    n = names.join(left.groupBy(*by, name).agg(F.count(F.lit(1)).alias("__l")), [*by, name]).join(right.groupBy(*by, other).agg(F.count(F.lit(1)).alias("__r")), [*by, other])
    n = n.withColumn("__pairs", F.sum(F.col("__l") * F.col("__r")).over(Window.partitionBy(*by, other)))
    n = materialize(n.withColumn("__parts", F.ceil(F.col("__pairs") / most).cast("int")).drop("__pairs"), "names")
    pairs, rows = n.agg(F.sum(F.col("__l") * F.col("__r")), F.sum("__l")).first()
    parts = max(12, -(-(pairs or 0) // most))
    # Names repeat a left row once for each `other`: that happens in partitions of bounded size, too.
    x = left.repartition(max(12, -(-(rows or 0) // most)), *by, name).join(n.select(*by, name, other, "__parts"), [*by, name])
    x = x.withColumn("__part", F.pmod(F.xxhash64(a), F.col("__parts")).cast("int")).select(*by, other, "__part", a)
    dealt = n.select(*by, other, "__parts").distinct().select(*by, other, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))
    y = right.join(dealt, [*by, other])
    key = [*by, other, "__part"]
    return x.repartition(parts, *key).join(y.repartition(parts, *key), key).select(a, b)


def nearest_sets(queries: DataFrame, sets: DataFrame, q: str, tokens_q: str, s: str, tokens_s: str) -> DataFrame:
    """q, s, score and n_best: the set with the highest Jaccard similarity to each query, how many sets have it, the smallest s of them.

    Equal sets are compared once.  A query meets the sets that hold its rarest known token first;
    the best of those is a bound b.  A set that reaches b shares at least b times as many tokens
    as the query has, so one of the query's rarest tokens, all but the last of that many, is among
    them: only there do others meet, never on the most frequent words.  A query that shares no
    token with any set has score 0 with the smallest s of all.
    """
    heads = sets.groupBy(F.array_sort(F.array_distinct(tokens_s)).alias("__t")).agg(F.min(s).alias(s), F.count(F.lit(1)).alias("__same"))
    heads = materialize(heads, "sets")
    y = heads.select(s, F.explode("__t").alias("__token"))
    frequency = materialize(y.groupBy("__token").agg(F.count(F.lit(1)).alias("__f")), "frequencies")
    x = materialize(queries.select(q, F.array_distinct(tokens_q).alias("__q")).distinct(), "queries")
    ranked = x.select(q, F.size("__q").alias("__m"), F.explode("__q").alias("__token")).join(frequency, "__token", "left")
    rank = F.row_number().over(Window.partitionBy(q).orderBy(F.coalesce("__f", F.lit(0)), "__token"))
    ranked = materialize(ranked.select(q, "__m", "__token", "__f", rank.alias("__rank")), "ranked")

    def compared(rows: DataFrame) -> DataFrame:
        # Pairs are ids until each is one; only then the sets are put beside them.
        pairs = rows.join(y, "__token").select(q, s).distinct().join(heads, s).join(x, q)
        k = F.size(F.array_intersect("__q", "__t"))
        return pairs.select(q, s, "__same", (k / (F.size("__q") + F.size("__t") - k)).alias("score"))

    known = ranked.filter("__f is not null")
    rarest = known.join(known.groupBy(q).agg(F.min("__rank").alias("__rank")), [q, "__rank"])
    bounds = compared(rarest).groupBy(q).agg(F.max("score").alias("__b"))
    needed = F.ceil(F.col("__b") * F.col("__m") - 1e-9)
    scored = compared(known.join(bounds, q).filter(F.col("__rank") <= F.col("__m") - needed + 1).drop("__b"))
    scored = materialize(scored, "scored")
    top = scored.groupBy(q).agg(F.max("score").alias("score"))
    best = scored.join(top, [q, "score"]).groupBy(q, "score").agg(F.min(s).alias(s), F.sum("__same").alias("n_best"))
    none = sets.agg(F.min(s).alias("__none"), F.count(F.lit(1)).alias("__all"))
    found = queries.select(q).join(best, q, "left").crossJoin(F.broadcast(none))  # one row
    return found.select(q, F.coalesce(s, "__none").alias(s), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_best", "__all").alias("n_best"))
