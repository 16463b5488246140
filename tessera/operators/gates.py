"""Quality gates as data: rules give findings (entity, level, code, message)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = ("E", "W", "I")


@dataclass(frozen=True)
class Rule:
    """A finding's code and level, the condition under which a row has it, and its message."""

    code: str
    level: str
    when: Column
    message: Column


def findings(df: DataFrame, entity: Column, rules: Sequence[Rule]) -> DataFrame:
    """One row per row and rule that holds.  All rules are tried in one pass over the rows."""
    entries = F.array(*(F.when(r.when, F.struct(F.lit(r.level).alias("level"), F.lit(r.code).alias("code"), r.message.cast("string").alias("message"))) for r in rules))
    hits = df.select(entity.cast("string").alias("entity"), F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("x"))
    return hits.select("entity", "x.level", "x.code", "x.message")


def summary(found: DataFrame) -> DataFrame:
    """level, code, number of findings and of entities."""
    return found.groupBy("level", "code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity").alias("n_entities"))


def duplicates(df: DataFrame, entity: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once inside an entity."""
    return df.groupBy(*entity, *key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unknown_fields(df: DataFrame, entity: str, fields: Column, dictionary: Sequence[str]) -> DataFrame:
    """entity and field: fields that the dictionary does not declare."""
    extra = F.array_except(fields, F.array(*map(F.lit, dictionary)))
    return df.select(entity, F.explode(extra).alias("field")).distinct()


def upper_median(values: Column) -> Column:
    """The element at half the length of the sorted values: the upper one of two middle values."""
    ordered = F.array_sort(values)
    return F.try_element_at(ordered, (F.floor(F.size(ordered) / 2) + 1).cast("int"))


def below_peers(df: DataFrame, peer: str, ratio: str, fraction: float = 0.5) -> DataFrame:
    """Every row with its peer group's upper median and whether it is below that fraction of it.

    The median is the row at half the group's length.  Equal values are counted first, so only
    a group's distinct values are put in order, and the one median per group is joined back.
    """
    counts = df.filter(F.col(ratio).isNotNull()).groupBy(peer, ratio).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(peer)
    upto = counts.withColumn("__upto", F.sum("__n").over(w.orderBy(ratio))).withColumn("__all", F.sum("__n").over(w))
    medians = upto.filter(F.col("__upto") > F.floor(F.col("__all") / 2)).groupBy(F.col(peer).alias("__peer")).agg(F.min(ratio).alias("peer_median"))
    found = df.join(medians, F.col(peer).eqNullSafe(F.col("__peer")), "left").drop("__peer")
    return found.withColumn("thin", F.col(ratio) < F.lit(fraction) * F.col("peer_median"))


def golden_sample(actual: DataFrame, expected: DataFrame, key: Sequence[str], name: str, part: str) -> DataFrame:
    """key and verdict: ok where the actual name holds the expected part regardless of case, wrong where not, missing without a row."""
    both = expected.select(*key, part).join(actual.select(*key, name), list(key), "left")
    verdict = F.when(F.col(name).isNull(), "missing").when(F.contains(F.lower(name), F.lower(part)), "ok").otherwise("wrong")
    return both.select(*key, verdict.alias("verdict"))


# ---------------------------------------------------------------- findings that need several tables of a model

#: The agreement below which a cross-check is an error, the share of points below which it is thin, and what a simulator needs one of.
LEAST_AGREEMENT, LEAST_CHECKED = 0.98, 0.5
CORE_QUANTITIES = ("power", "current", "voltage", "capacity")
CONFIRMED, UNCONFIRMED = ("human", "sample", "machine"), ("weak", "blind")


def _number(value: Column) -> Column:
    return value.cast("string")


def crosscheck_findings(models: DataFrame, checks: DataFrame) -> DataFrame:
    """Findings of second readings.  models: model, n_points, extractor; checks: model, unverifiable, n_both, n_agree, example.

    A model without points isn't asked.  A check that says why it can't be made is one finding; else
    too few points checked, none at all, too little agreement and enough of it are told apart.
    """
    both = models.join(checks.withColumn("checked", F.lit(True)), "model", "left").filter("n_points > 0")
    made = F.col("checked").isNotNull() & (F.coalesce("unverifiable", F.lit("")) == "")
    rate = F.col("n_agree") / F.col("n_both")
    of = F.concat_ws("/", _number(F.col("n_both")), _number(F.col("n_points")))
    rules = [
        Rule("crosscheck-unverifiable", "W", F.col("checked").isNotNull() & ~made, F.col("unverifiable")),
        Rule("crosscheck-thin", "W", made & (F.col("n_both") < F.col("n_points") * LEAST_CHECKED), of),
        Rule("crosscheck-none", "W", made & (F.col("n_both") == 0), of),
        Rule("crosscheck", "E", made & (F.col("n_both") > 0) & (rate < LEAST_AGREEMENT), F.concat_ws(" ", _number(F.col("n_both") - F.col("n_agree")), F.coalesce("example", F.lit("")))),
        Rule("crosscheck-ok", "I", made & (F.col("n_both") > 0) & (rate >= LEAST_AGREEMENT), of),
        Rule("no-crosscheck", "W", F.col("checked").isNull() & (F.coalesce("extractor", F.lit("")) != "manual"), F.lit("one reading only")),
    ]
    return findings(both, F.col("model"), rules)


def known_good_findings(models: DataFrame, points: DataFrame, expected: DataFrame, checks: DataFrame) -> DataFrame:
    """Findings of points that a person has confirmed.  points: model, type, inst, name; expected: model, type, inst, part of the name.

    Of several points with one type and instance the first name counts.  A model with neither
    confirmed points nor a second reading has no way to be checked.
    """
    first = points.groupBy("model", "type", "inst").agg(F.min("name").alias("name"))
    judged = expected.join(first.withColumn("there", F.lit(True)), ["model", "type", "inst"], "left")
    key = F.concat_ws("-", "type", _number(F.col("inst")))
    wrong = F.col("there").isNotNull() & ~F.contains(F.lower(F.coalesce("name", F.lit(""))), F.lower("part"))
    per = judged.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(wrong, 1)).alias("n_wrong"), F.min(F.when(wrong, key)).alias("first_wrong"), F.count(F.when(F.col("there").isNull(), 1)).alias("n_missing"), F.min(F.when(F.col("there").isNull(), key)).alias("first_missing"))
    both = models.join(per, "model", "left").join(checks.select("model", F.lit(True).alias("checked")).distinct(), "model", "left")
    rules = [
        Rule("known-good", "E", F.col("n_wrong") > 0, F.concat_ws(" ", _number(F.col("n_wrong")), "first_wrong")),
        Rule("known-good-missing", "W", F.col("n_missing") > 0, F.concat_ws(" ", _number(F.col("n_missing")), "first_missing")),
        Rule("known-good-ok", "I", (F.col("n_wrong") == 0) & (F.col("n_missing") == 0), _number(F.col("n"))),
        Rule("no-known-good", "W", F.col("n").isNull() & F.col("checked").isNull() & (F.col("n_points") > 0), F.lit("no way to check")),
    ]
    return findings(both, F.col("model"), rules)


def spec_findings(models: DataFrame, specs: DataFrame, unfit: DataFrame) -> DataFrame:
    """Findings of a model's ratings.  specs: model, form (table, variant or flat), rows, quantity, source; unfit: source, reason.

    A model with points but no ratings is a finding, and so are ratings without any of
    CORE_QUANTITIES, and each source that is known not to serve the purpose.
    """
    counts = [F.count(F.when(F.col("form") == form, 1)).alias(form) for form in ("table", "variant", "flat")]
    rows = [F.coalesce(F.sum(F.when(F.col("form") == form, F.col("rows"))), F.lit(0)).alias(f"{form}_rows") for form in ("table", "variant", "flat")]
    core = F.array_sort(F.collect_set(F.when(F.col("quantity").isin(*CORE_QUANTITIES), F.col("quantity"))))
    per = specs.groupBy("model").agg(F.count(F.lit(1)).alias("n"), *counts, *rows, core.alias("core"))
    both = models.join(per, "model", "left")
    sized = lambda form: F.concat_ws(" ", _number(F.col(form)), _number(F.col(f"{form}_rows")))
    rules = [
        *(Rule(code, "I", F.col(form) > 0, sized(form)) for code, form in (("spec-flat", "flat"), ("spec-variants", "variant"), ("spec-ok", "table"))),
        Rule("spec-nocore", "W", F.col("n").isNotNull() & (F.size("core") == 0), F.lit("nothing to simulate with")),
        Rule("spec-core", "I", F.col("n").isNotNull() & (F.size("core") > 0), F.array_join("core", ", ")),
        Rule("no-spec", "W", F.col("n").isNull() & (F.col("n_points") > 0), F.lit("points only")),
    ]
    bad = specs.select("model", "source").distinct().join(unfit, "source").join(models.select("model"), "model")
    return findings(both, F.col("model"), rules).unionByName(findings(bad, F.col("model"), [Rule("spec-source-unfit", "W", F.lit(True), F.concat_ws(": ", "source", "reason"))]))


def record_findings(models: DataFrame) -> DataFrame:
    """Findings of a model's own record: no note on what is missing, points entered by hand.  models: model, n_points, extractor, gap, has_spec."""
    rules = [
        Rule("no-gap-note", "I", (F.coalesce("gap", F.lit("")) == "") & ~F.coalesce("has_spec", F.lit(False)), F.lit("no note on what is missing")),
        Rule("manual", "I", (F.col("n_points") > 0) & (F.col("extractor") == "manual"), _number(F.col("n_points"))),
    ]
    return findings(models, F.col("model"), rules)


def verified_findings(grades: DataFrame) -> DataFrame:
    """Findings over all models: how many models and points are confirmed, and how many weakly or not at all.  grades: model, grade, n_points."""
    confirmed, thin = F.col("grade").isin(*CONFIRMED), F.col("grade").isin(*UNCONFIRMED)
    points = lambda when: F.coalesce(F.sum(F.when(when, F.col("n_points"))), F.lit(0))
    models = lambda when: F.count(F.when(when, 1))
    total = grades.agg(models(confirmed).alias("ok"), F.count(F.lit(1)).alias("all"), points(confirmed).alias("ok_points"), points(F.lit(True)).alias("all_points"), models(thin).alias("thin"), points(thin).alias("thin_points"))
    of = lambda a, b: F.concat_ws("/", _number(F.col(a)), _number(F.col(b)))
    rules = [
        Rule("verified-skip", "I", F.col("all") == 0, F.lit("no model has a grade")),
        Rule("verified-count", "I", F.col("all") > 0, F.concat_ws(" ", of("ok", "all"), of("ok_points", "all_points"))),
        Rule("verified-thin", "W", F.col("thin") > 0, F.concat_ws(" ", _number(F.col("thin")), _number(F.col("thin_points")))),
    ]
    return findings(total, F.lit("all"), rules)


def review_findings(artefacts: DataFrame, inputs: DataFrame) -> DataFrame:
    """Findings of artefacts that are missing or older than their newest input.  artefacts: artefact, built_at; inputs: artefact, input, changed_at."""
    newest = inputs.groupBy("artefact").agg(F.max("changed_at").alias("changed_at"), F.max_by("input", F.struct("changed_at", "input")).alias("input"))
    both = artefacts.join(newest, "artefact", "left")
    rules = [
        Rule("review-missing", "I", F.col("built_at").isNull(), F.lit("not built")),
        Rule("review-stale", "W", F.col("built_at") < F.col("changed_at"), F.col("input")),
    ]
    return findings(both, F.col("artefact"), rules)


def template_findings(cover: DataFrame, notes: DataFrame) -> DataFrame:
    """Findings of template rows that no point of a model serves.  cover: profile, model, name, required, hit; notes: profile, note.

    Required rows that aren't served, and a cover below half the profile's median, are warnings; where
    the profile's note explains gaps they are information.
    """
    per = cover.groupBy("profile", "model").agg(F.count(F.when(F.col("hit"), 1)).alias("hit"), F.count(F.lit(1)).alias("all"), F.array_sort(F.collect_list(F.when(F.col("required") & ~F.col("hit"), F.col("name")))).alias("missed"))
    thin = below_peers(per.withColumn("ratio", F.col("hit") / F.col("all")), "profile", "ratio")
    told = thin.join(notes, "profile", "left").withColumn("told", F.coalesce("note", F.lit("")) != "")
    missing = F.size("missed") > 0
    few = F.coalesce("thin", F.lit(False)) & (F.col("peer_median") > 0)
    some = F.concat_ws(" ", "profile", _number(F.size("missed")), F.array_join(F.slice("missed", 1, 5), ", "))
    share = F.concat_ws(" ", "profile", F.concat_ws("/", _number(F.col("hit")), _number(F.col("all"))))
    rules = [Rule(code, level, when & (F.col("told") if level == "I" else ~F.col("told")), text) for code, when, text in (("template-required", missing, some), ("template-thin", few, share)) for level in ("W", "I")]
    return findings(told, F.col("model"), rules)
