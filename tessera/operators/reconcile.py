"""Reconciling proposals with confirmed records, and comparing releases."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.order import first_wins

CONFIRMED = ("verified", "manual")


def survivorship(stored: DataFrame, extracted: DataFrame, key: Sequence[str], value: str, status: str = "status") -> DataFrame:
    """key, value, status and action of every record of either side.

    A confirmed record is never overwritten: it stays as `keep`, `drift` (the proposal
    differs) or `orphan` (no longer proposed).  Others follow the proposal: `add`, `update`,
    `same` or `drop`.  Null values compare as equal.
    """
    s = stored.select(*key, F.col(value).alias("__old"), F.col(status).alias("__status"), F.lit(1).alias("__s"))
    e = extracted.select(*key, F.col(value).alias("__new"), F.lit(1).alias("__e"))
    both = s.join(e, list(key), "full_outer")
    confirmed = F.coalesce(F.col("__status").isin(*CONFIRMED), F.lit(False))
    equal = F.col("__old").eqNullSafe(F.col("__new"))
    action = (
        F.when(F.col("__s").isNull(), "add")
        .when(F.col("__e").isNull(), F.when(confirmed, "orphan").otherwise("drop"))
        .when(confirmed, F.when(equal, "keep").otherwise("drift"))
        .otherwise(F.when(equal, "same").otherwise("update"))
    )
    kept = F.when(F.col("__e").isNull() | confirmed, F.col("__old")).otherwise(F.col("__new"))
    return both.select(*key, kept.alias(value), F.coalesce("__status", F.lit("extracted")).alias(status), action.alias("action"))


def fill_from_continued(base: DataFrame, continued: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Base rows with blanks filled from the continued row of the same key, unless any field of the two disagrees."""
    c = continued.select(*key, *(F.col(f).alias(f"__c_{f}") for f in fields), F.lit(1).alias("__c"))
    both = base.join(c, list(key), "left")
    conflict = F.lit(False)
    for f in fields:
        conflict = conflict | F.coalesce(F.col(f) != F.col(f"__c_{f}"), F.lit(False))
    filled = [F.when(conflict, F.col(f)).otherwise(F.coalesce(f, f"__c_{f}")).alias(f) for f in fields]
    state = F.when(F.col("__c").isNull(), "alone").when(conflict, "conflict").otherwise("merged")
    return both.select(*key, *filled, state.alias("state"))


def duplicate_conflicts(df: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """key, field and n_values where rows of one key differ in a field."""
    long = df.select(*key, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("x"))
    return long.groupBy(*key, F.col("x.field").alias("field")).agg(F.countDistinct("x.value").alias("n_values")).filter("n_values > 1")


def verification_grade(human: Column, sample: Column, rate: Column) -> Column:
    """human over sample over machine (rate of at least 0.99) over weak over blind."""
    return F.when(human, "human").when(sample, "sample").when(rate >= 0.99, "machine").when(rate.isNotNull(), "weak").otherwise("blind")


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """key and change (added, removed or changed) between two releases, by a hash of each row's content."""
    content = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    both = old.select(*key, content.alias("__a")).join(new.select(*key, content.alias("__b")), list(key), "full_outer")
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.col("__a") != F.col("__b"), "changed")
    return both.select(*key, change.alias("change")).filter(F.col("change").isNotNull())


def conformance(standard: DataFrame, actual: DataFrame, key: Sequence[str], unit: str, kind: str) -> DataFrame:
    """key and verdict: match, missing, extra, unit_mismatch or type_mismatch of the actual points against the standard's."""
    s = standard.select(*key, F.col(unit).alias("__su"), F.col(kind).alias("__st"), F.lit(1).alias("__s"))
    a = actual.select(*key, F.col(unit).alias("__au"), F.col(kind).alias("__at"), F.lit(1).alias("__a"))
    verdict = (
        F.when(F.col("__a").isNull(), "missing")
        .when(F.col("__s").isNull(), "extra")
        .when(~F.col("__st").eqNullSafe(F.col("__at")), "type_mismatch")
        .when(~F.col("__su").eqNullSafe(F.col("__au")), "unit_mismatch")
        .otherwise("match")
    )
    return s.join(a, list(key), "full_outer").select(*key, verdict.alias("verdict"))


def alias_rows(covers: DataFrame, owned: DataFrame, code: str, owner: str) -> DataFrame:
    """code and the first owner that covers it, for codes that have no record of their own."""
    return first_wins(covers.join(owned.select(code), code, "left_anti"), [code], [owner]).select(code, F.col(owner).alias("alias_of"))


def sync_aliases(stored: DataFrame, seen: DataFrame, key: str, stored_array: str, seen_value: str) -> DataFrame:
    """key, aliases (stored ones first, new ones after them, sorted) and n_new: additive, nothing is removed."""
    fresh = seen.groupBy(key).agg(F.array_sort(F.collect_set(seen_value)).alias("__seen"))
    both = stored.join(fresh, key, "left").withColumn("__seen", F.coalesce("__seen", F.array().cast("array<string>")))
    extra = F.array_except("__seen", stored_array)
    return both.select(key, F.concat(F.col(stored_array), F.array_sort(extra)).alias("aliases"), F.size(extra).cast("long").alias("n_new"))


def diverging_pairs(df: DataFrame, key: Sequence[str], role: str, first: str, second: str, value: str) -> DataFrame:
    """key, and whether two physically separate readings of one value agree numerically."""
    a = df.filter(F.col(role) == first).groupBy(*key).agg(F.max(value).alias("__a"))
    b = df.filter(F.col(role) == second).groupBy(*key).agg(F.max(value).alias("__b"))
    return a.join(b, list(key)).select(*key, F.col("__a").eqNullSafe(F.col("__b")).alias("agrees"))


def sync_plan(units: DataFrame, of_class: str, raw: str, value: Column) -> DataFrame:
    """units with value and action: without a class a unit is refused, an unchanged value is the same, others are to be written."""
    planned = units.withColumn("value", value)
    return planned.withColumn("action", F.when(F.col(of_class).isNull(), "refused").when(F.col("value").eqNullSafe(F.col(raw)), "same").otherwise("write"))


def first_rung(tables: DataFrame, model: str, code: str, shapes: Sequence[tuple[int, Column]]) -> DataFrame:
    """model, rung, code and n: of the ways (rung, condition) to find a model's codes the lowest that finds any, with all its codes."""
    rung = F.lit(None).cast("int")
    for number, found in sorted(shapes, key=lambda s: -s[0]):
        rung = F.when(found, number).otherwise(rung)
    tried = tables.select(model, code, rung.alias("rung")).filter("rung is not null")
    lowest = tried.groupBy(model).agg(F.min("rung").alias("rung"))
    return tried.join(lowest, [model, "rung"], "left_semi").groupBy(model, "rung", code).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- revisions against curated rows


def resync(old: DataFrame, new: DataFrame, curated: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """key, columns, state and conflicts: curated rows after a source went from revision old to new.

    Each column is merged three ways: what nobody edited follows the source, what only a person
    edited stays, and what both changed differently is a conflict, in which the person's value
    stays.  state: `kept` (nothing to do), `updated` (follows the source), `converged` (the source
    came to say what the person said), `conflict`, `proposed` (new in the source), `retired` (gone
    from the source and not edited, the columns are the last known), `orphaned` (gone, but edited or
    entered by a person).  Nulls are values like others.  One row per key in each input.
    """
    named = lambda df, p: df.select(*(F.col(c).alias(f"{p}_{c}") for c in (*key, *columns)), F.lit(True).alias(f"has_{p}"))
    on = lambda p: [F.coalesce(*(F.col(f"{q}_{c}") for q in p[:-1])).eqNullSafe(F.col(f"{p[-1]}_{c}")) for c in key]
    both = named(old, "o").join(named(new, "n"), on("on"), "full_outer")
    both = both.join(named(curated, "c"), on("onc"), "full_outer")
    has = {p: F.coalesce(f"has_{p}", F.lit(False)) for p in "onc"}
    same = lambda c, a, b: F.col(f"{a}_{c}").eqNullSafe(F.col(f"{b}_{c}"))
    every = lambda a, b: _all(same(c, a, b) for c in columns)
    clash = lambda c: ~same(c, "c", "o") & ~same(c, "o", "n") & ~same(c, "c", "n")
    # A row that both a person and the source have added has no common past: every difference is a conflict.
    differs = lambda c: F.when(has["o"], clash(c)).otherwise(~same(c, "c", "n"))
    conflicts = F.when(has["n"] & has["c"], F.array_compact(F.array(*(F.when(differs(c), F.lit(c)) for c in columns)))).otherwise(F.array().cast("array<string>"))
    state = (
        F.when(has["n"] & ~has["c"] & ~has["o"], "proposed")
        .when(has["n"] & ~has["c"], "dropped")
        .when(~has["n"] & ~has["c"], "gone")
        .when(~has["n"], F.when(has["o"] & every("c", "o"), "retired").otherwise("orphaned"))
        .when(F.size(conflicts) > 0, "conflict")
        .when(has["o"] & every("o", "n"), "kept")
        .when(every("c", "n"), "converged")
        .otherwise("updated")
    )
    follows = lambda c: F.when(~has["c"], F.col(f"n_{c}")).when(has["n"] & has["o"] & same(c, "c", "o"), F.col(f"n_{c}")).otherwise(F.col(f"c_{c}"))
    merged = both.select(*(F.coalesce(*(F.col(f"{p}_{c}") for p in "cno")).alias(c) for c in key), *(follows(c).alias(c) for c in columns), state.alias("state"), conflicts.alias("conflicts"))
    # What a person has taken out stays out, and what is in neither has nothing to say.
    return merged.filter(~F.col("state").isin("dropped", "gone"))


def _all(conditions: Iterable[Column]) -> Column:
    found = F.lit(True)
    for condition in conditions:
        found = found & condition
    return found


# ---------------------------------------------------------------- two readings of one document


def aligned_readings(first: DataFrame, second: DataFrame, by: Sequence[str], pos: str, key: str, value: str, band: int = 200) -> DataFrame:
    """by, key, pos_a, pos_b, value_a, value_b of two readings of each entity, put side by side by a longest common subsequence of their keys.

    A key that only one reading has, or that stands in another order there, has nulls on the other
    side.  Rows may be shifted by at most `band` places more or less than the readings' lengths
    differ.  An entity is a document: its rows come to one task.  Readings in step need no
    search and are put together a batch at a time.
    """
    read = lambda df, side: df.select(*by, F.lit(side).alias("__side"), F.col(pos).cast("long").alias("__pos"), F.col(key).cast("string").alias("__key"), F.col(value).cast("string").alias("__value"))
    rows = read(first, 0).unionByName(read(second, 1))
    gathered = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("__side", "__pos", "__key", "__value"))).alias("rows"))
    schema = ", ".join(f"`{c}` {t}" for c, t in gathered.select(*by).dtypes)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("rows")
            flat, sizes = rows.flatten(), rows.value_lengths().to_numpy(zero_copy_only=False)
            part = lambda c: flat.field(c)  # noqa: B023, E731
            side = part("__side").to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            i, j, plain = in_step(owner, side, part("__key"), len(sizes), band)
            own, left, right = [owner[np.where(i >= 0, i, j)]], [i], [j]
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for k in np.flatnonzero(~plain):
                first, end = int(starts[k]), int(starts[k + 1])
                keys, n = part("__key").slice(first, end - first).to_pylist(), int((side[first:end] == 0).sum())
                pairs = np.array([(-1 if x is None else first + x, -1 if y is None else first + n + y) for x, y in side_by_side(keys[:n], keys[n:], band)], dtype=np.int64).reshape(-1, 2)
                own, left, right = [*own, np.full(len(pairs), k)], [*left, pairs[:, 0]], [*right, pairs[:, 1]]
            i, j = np.concatenate(left), np.concatenate(right)
            at = lambda column, places: column.take(pa.array(places, pa.int64(), mask=places < 0))
            places = pa.array(np.concatenate(own), pa.int64())
            names = [c for c in batch.schema.names if c != "rows"]
            found = [part("__key").take(pa.array(np.where(i >= 0, i, j), pa.int64())), at(part("__pos"), i), at(part("__pos"), j), at(part("__value"), i), at(part("__value"), j)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(places) for c in names), *found], [*names, "key", "pos_a", "pos_b", "value_a", "value_b"])

    return gathered.mapInArrow(align, f"{schema}, key string, pos_a long, pos_b long, value_a string, value_b string")


def in_step(owner: np.ndarray, side: np.ndarray, key: pa.Array, n: int, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows put side by side (-1: none) of the entities whose readings are in step, and which of the n entities are.

    Readings are in step if no key repeats in either, the keys that both have stand in one order,
    and neither has more rows than the band is wide: what they share is then the one longest common
    subsequence.  Rows come by entity, then side, then place.
    """
    code = key.dictionary_encode()
    code = code.indices.fill_null(len(code.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((side, code, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (code[order][1:] == code[order][:-1])
    twice = same & (side[order][1:] == side[order][:-1])
    plain = np.ones(n, dtype=bool)
    plain[owner[order][1:][twice]] = False
    for s in (0, 1):
        plain &= np.bincount(owner[side == s], minlength=n) <= band
    pair = np.full(len(owner), -1, dtype=np.int64)
    matched = same & ~twice
    pair[order[:-1][matched]] = order[1:][matched]
    # Pairs by the first reading's places: the second's have to rise.
    i = np.flatnonzero((pair >= 0) & (side == 0))
    crossed = (owner[i][1:] == owner[i][:-1]) & (pair[i][1:] < pair[i][:-1])
    plain[owner[i][1:][crossed]] = False
    taken = np.zeros(len(owner), dtype=bool)
    taken[pair[i]] = True
    kept = plain[owner]
    first, second = np.flatnonzero(kept & (side == 0)), np.flatnonzero(kept & (side == 1) & ~taken)
    return np.concatenate([first, np.full(len(second), -1)]), np.concatenate([pair[first], second]), plain


def side_by_side(a: list[str], b: list[str], band: int) -> list[tuple[int | None, int | None]]:
    """Places of both sequences in order, matched along a longest common subsequence inside a band around the diagonals."""
    n, m = len(a), len(b)
    low, high = min(0, m - n) - band, max(0, m - n) + band
    best: list[dict[int, int]] = [{} for _ in range(n + 1)]  # best[i][j]: matches of a[i:] and b[j:]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(min(m - 1, i + high), max(0, i + low) - 1, -1):
            row[j] = 1 + below.get(j + 1, 0) if a[i] == b[j] else max(below.get(j, 0), row.get(j + 1, 0))
    found: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < n and j < m:
        if a[i] == b[j] and i + low <= j <= i + high:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1].get(j, 0) >= best[i].get(j + 1, 0):
            found.append((i, None))
            i += 1
        else:
            found.append((None, j))
            j += 1
    return [*found, *((k, None) for k in range(i, n)), *((None, k) for k in range(j, m))]


def reading_agreement(aligned: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, n_both, n_agree, n_first, n_second and example per entity of aligned_readings(): what gates.crosscheck_findings() asks for."""
    both, agree = F.col("pos_a").isNotNull() & F.col("pos_b").isNotNull(), F.col("value_a").eqNullSafe(F.col("value_b"))
    count = lambda when: F.count(F.when(when, 1))
    text = F.concat(F.col("key"), F.lit(": "), F.coalesce("value_a", F.lit("")), F.lit(" | "), F.coalesce("value_b", F.lit("")))
    return aligned.groupBy(*by).agg(count(both).alias("n_both"), count(both & agree).alias("n_agree"), count(F.col("pos_b").isNull()).alias("n_first"), count(F.col("pos_a").isNull()).alias("n_second"), F.min_by(F.when(both & ~agree, text), F.when(both & ~agree, F.col("pos_a"))).alias("example"))


def propose_class(records: DataFrame, of_class: str, role: str, field: str, first: str, n_detail: int = 5) -> DataFrame:
    """of_class, table, detail and roles: a draft of each class's fields from the records (of_class, role, field) extracted for it.

    table: the field `first`, then all others by how often they occur, most first, then by name;
    detail: the first of those others; roles: the roles that occur, an unnamed one as `?`.
    """
    counted = records.groupBy(of_class, field).agg(F.count(F.lit(1)).alias("n")).filter(F.col(field).isNotNull() & (F.col(field) != first))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(field).alias("f")))), lambda x: x["f"])
    fields = counted.groupBy(of_class).agg(ordered.alias("order"))
    roles = records.groupBy(of_class).agg(F.array_sort(F.collect_set(F.coalesce(F.nullif(role, F.lit("")), F.lit("?")))).alias("roles"))
    return fields.join(roles, of_class).select(of_class, F.concat(F.array(F.lit(first)), F.col("order")).alias("table"), F.slice("order", 1, n_detail).alias("detail"), "roles")
