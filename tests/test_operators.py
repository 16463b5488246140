"""Single operators on small fixtures: ties, nulls, idempotence, conservation."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import gates, graph, match, order, publish, reconcile


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_object_ids(spark):
    found = column(spark, ["AI-1", "av: 2", "MI[3]", "Analog Input, 4", "multi-state value 5", "XX-1", None, "dev 6"], S.object_id)
    assert [tuple(x) for x in found] == [("AI", 1), ("AV", 2), ("MSI", 3), ("AI", 4), ("MSV", 5), (None, None), (None, None), ("Dev", 6)]


def test_ranges_keep_references_out(spark):
    found = column(spark, ["0~90", "-127 to 127", "0 - DRV-20", "—", None, "0.1 - 120.0"], S.parse_range)
    assert [(x["min"], x["max"]) for x in found] == [(0, 90), (-127, 127), (None, None), (None, None), (None, None), (0.1, 120)]


def test_units(spark):
    assert column(spark, ["°C", "PERCENT", "", "furlong", None, "C"], S.canonical_unit) == ["degC", "percent", None, None, None, "degC"]
    assert column(spark, ["", "0 = Off 1 = On", "kW", "PRESSURE FLUIDIC _", "furlong"], S.unit_state) == ["unitless", "states", "ok", "group", "unknown"]


def test_enumerations_need_two_entries(spark):
    found = column(spark, ["0 = Auto 1 = Forced", "1: On", None], S.enum_states)
    assert [[tuple(x) for x in v or []] for v in found] == [[("0", "Auto"), ("1", "Forced")], [], []]


def test_numbers(spark):
    assert column(spark, ["1,200 - 1,300 and -5", "none"], S.numbers) == [[1200, 1300, -5], []]
    assert [r[0] for r in spark.sql("SELECT 12.0D v UNION ALL SELECT 12.5D").orderBy("v").select(S.format_number(F.col("v"))).collect()] == ["12", "12.5"]


def test_first_wins_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 0, "z")], "k string, o int, v string")
    assert sorted((r.k, r.v) for r in order.first_wins(df, ["k"], ["o", "v"]).collect()) == [("a", "x"), ("b", "z")]


def test_as_of_counts_the_same_position(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, at int")
    right = spark.createDataFrame([(1, 5, 50), (1, 3, 30)], "k int, at int, v int")
    assert sorted((r.k, r.at, r.out) for r in order.as_of(left, right, ["k"], "at", "v", "out").collect()) == [(1, 1, None), (1, 5, 50), (2, 9, None)]


def test_key_reuse(spark):
    df = spark.createDataFrame([(1, i, k) for i, k in enumerate("abaca")], "d int, i int, k string")
    assert [r.segment for r in order.key_reuse_segments(df, ["d"], ["i"], "k").orderBy("i").collect()] == [0, 0, 1, 1, 2]


def test_bands(spark):
    df = spark.createDataFrame([(1, 0, 1, 43), (1, 1, 101, 135), (1, 2, 1, 43), (1, 3, 50, 60)], "d int, i int, lo int, hi int")
    assert [r.band for r in order.band_groups(df, ["d"], ["i"], "lo", "hi").orderBy("i").collect()] == [0, 0, 1, 1]


def test_greedy_assignment_claims_names_once(spark):
    rows = [(1, 1, "r1", "n1", 5), (1, 2, "r2", "n1", 9), (1, 3, "r3", "n2", 1), (1, 3, "r3", "n1", 9)]
    df = spark.createDataFrame(rows, "d int, o int, r string, i string, s int")
    assert sorted((r.rule, r.item) for r in order.greedy_assignment(df, ["d"], "o", "r", "i", "s").collect()) == [("r1", "n1"), ("r3", "n2")]


def test_pairs_consume_values(spark):
    df = spark.createDataFrame([(1, i, k) for i, k in enumerate(["lv", "lv", "lv", "v", "l"])], "d int, i int, k string")
    found = order.consume_pairs(df, ["d"], "i", F.contains("k", F.lit("l")), F.contains("k", F.lit("v")))
    assert sorted((r.i, r.value_at) for r in found.collect()) == [(0, 1), (2, 3)]


def test_survivorship_is_idempotent(spark):
    stored = spark.createDataFrame([(1, "a", "verified"), (2, "b", "extracted"), (3, "c", "manual"), (4, "d", "extracted")], "k int, v string, status string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (5, "z")], "k int, v string")
    first = reconcile.survivorship(stored, new, ["k"], "v")
    assert {r.k: (r.v, r.action) for r in first.collect()} == {1: ("a", "drift"), 2: ("y", "update"), 3: ("c", "orphan"), 4: ("d", "drop"), 5: ("z", "add")}
    kept = first.filter("action <> 'drop'").select("k", "v", "status")
    again = reconcile.survivorship(kept, new, ["k"], "v")
    assert {r.action for r in again.collect()} == {"drift", "same", "orphan"}


def test_prefix_ties_go_to_the_first_profile(spark):
    profiles = spark.createDataFrame([("late", "a.b", 2), ("early", "a.b", 1), ("any", None, 0)], "profile string, prefix string, ord int")
    df = spark.createDataFrame([(1, "a.b.c"), (2, "z")], "i int, cat string")
    assert {r.i: r.profile for r in match.longest_prefix(df, "cat", ["i"], profiles).collect()} == {1: "early", 2: "any"}


def test_loose_parts():
    assert match.loose_parts("leaving.*water|^on.?off|fan") == [["leaving", "water"]]


def test_interval_join(spark):
    points = spark.createDataFrame([(x,) for x in (0.0, 9.99, 10.0, 25.0)], "x double")
    bands = spark.createDataFrame([("a", 0.0, 10.0), ("b", 10.0, 30.0)], "b string, lo double, hi double")
    assert sorted((r.x, r.b) for r in match.containing(points, bands, "x", "lo", "hi", 7).collect()) == [(0.0, "a"), (9.99, "a"), (10.0, "b"), (25.0, "b")]


def test_closure_stops_at_cycles(spark):
    edges = spark.createDataFrame([("rtu", "ahu"), ("ahu", "equip"), ("x", "y"), ("y", "x")], "child string, parent string")
    assert {(r.node, r.ancestor) for r in graph.closure(edges).collect()} == {("rtu", "ahu"), ("rtu", "equip"), ("ahu", "equip"), ("x", "y"), ("y", "x"), ("x", "x"), ("y", "y")}


def test_upper_median(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (1, 2, 3, 4)], "g int, r double")
    assert {r.peer_median for r in gates.below_peers(df, "g", "r").collect()} == {3.0}
    assert df.groupBy("g").agg(gates.upper_median(F.collect_list("r")).alias("m")).first().m == 3.0


def test_long_then_wide_keeps_every_value(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b")], "k int, x string, y string")
    long = publish.to_long(df, ["k"], ["x", "y"])
    assert long.count() == 2
    assert sorted(tuple(r) for r in publish.to_wide(long, ["k"], "feature", "value", ["x", "y"]).collect()) == [(1, "a", None), (2, None, "b")]


def test_search_cap_is_per_kind(spark):
    df = spark.createDataFrame([(i, "Red") for i in range(5)], "i int, n string")
    found = publish.search([("a", df, F.col("i"), F.col("n")), ("b", df, F.col("i"), F.col("n"))], "red", cap=2)
    assert found.groupBy("kind").count().collect()[0]["count"] == 2 and found.count() == 4


def test_units_of_one_system(spark):
    assert column(spark, ["°F", "Deg C", "PERCENT", "% rh", "Lps", "furlong", "", None, "GPM"], S.unit_side) == ["IP", "SI", "both", "both", "SI", None, None, None, "IP"]
    assert column(spark, ["Mass", "VELOCITY - x", "Not  Applicable", "Enthalpy, spec", "thing"], S.unit_state) == ["group", "group", "group", "group", "unknown"]
    assert column(spark, ["mmAq", "㎥/h", "kbps", "% RH", "Hrs"], S.canonical_unit) == ["mmH2O", "m3h", "bps", "percent", "h"]


def test_range_signs(spark):
    found = column(spark, ["1 – 2", "1--2", "1 TO 2", "1-2-3", "1 ~ DRV", "-5~-1"], S.parse_range)
    assert [(x["min"], x["max"]) for x in found] == [(1, 2), (1, 2), (1, 2), (None, None), (None, None), (-5, -1)]


def test_object_ids_of_other_shapes(spark):
    found = column(spark, ["AI 7 ]", "ai[ 12 ]", "Analog  Inputs , 3", "Binary Output 1]", "Analog, 1", "AI1234567", "MSV-4 x", "multistate input 9", "LAV: 2"], S.object_id)
    assert [tuple(x) for x in found] == [("AI", 7), ("AI", 12), ("AI", 3), (None, None), (None, None), (None, None), (None, None), ("MSI", 9), ("LAV", 2)]


def test_registers(spark):
    assert column(spark, ["3x0004", "D14A", "40001", "2x0001", "3x04", "1234567", "d14a", ""], S.register_address) == [30004, 0x14A, 40001, None, None, None, None, None]


def test_long_chains_and_null_keys_in_segments(spark):
    keys = ["a", None, None, "b", "a"] + ["x"] * 70
    df = spark.createDataFrame([(None, i, k) for i, k in enumerate(keys)] + [(2, 0, "z")], "d int, i int, k string")
    found = [r.segment for r in order.key_reuse_segments(df, ["d"], ["i"], "k").filter("d is null").orderBy("i").collect()]
    assert found == [0, 0, 0, 0, 1] + list(range(1, 71))


def test_loose_parts_keep_groups_whole():
    assert match.loose_parts("sup(ply|.*air).*temp.+sensor|a.*bcd") == [["sup(ply|.*air)", "temp", "sensor"]]


def test_names_that_hold_each_other(spark):
    left = spark.createDataFrame([("b", "Fan Speed"), ("b", "ab"), ("b", "abc"), ("c", "Fan")], "b string, n string")
    right = spark.createDataFrame([("b", "supply fan-speed 2"), ("b", "AB"), ("b", "abcd"), ("b", "fans"), ("c", "fan")], "b string, o string")
    found = {(r.b, r.n, r.o) for r in match.contained_names(left, right, ["b"], "n", "o").collect()}
    both = left.join(right, "b").filter(match.same_or_contained(F.col("n"), F.col("o")))
    assert found == {(r.b, r.n, r.o) for r in both.collect()} == {("b", "Fan Speed", "supply fan-speed 2"), ("b", "Fan Speed", "fans"), ("b", "ab", "AB"), ("c", "Fan", "fan")}


def test_overlaps_of_equal_groups(spark):
    left = spark.createDataFrame([(g, k) for g in (1, 2, 3) for k in ("x", "y")] + [(4, "z")], "a int, k string")
    right = spark.createDataFrame([(8, "x", 2), (8, "y", 2), (9, "x", 1), (9, "y", 1), (7, "y", 0)], "b int, k string, o int")
    assert {(r.a, r.b, r.n) for r in match.best_overlap(left, right, ["k"], "a", "b", "o").collect()} == {(1, 9, 2), (2, 9, 2), (3, 9, 2)}


def test_nearest_sets_tell_ties(spark):
    queries = spark.createDataFrame([(1, ["a", "b"]), (2, ["q"]), (3, [])], "i int, q array<string>")
    sets = spark.createDataFrame([(10, ["a"]), (11, ["b"]), (12, ["a"]), (13, ["z", "a", "b"])], "s int, t array<string>")
    found = {r.i: (r.s, round(r.score, 3), r.n_best) for r in match.nearest_sets(queries, sets, "i", "q", "s", "t").collect()}
    assert found == {1: (13, 0.667, 1), 2: (10, 0.0, 4), 3: (10, 0.0, 4)}


def test_nearest_sets_by_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(25)]
    some = lambda n: [w for w in words if rng.random() < n / (1 + int(w[1:]))]  # noqa: E731 - the first words are in nearly every set
    queries, sets = [(k, some(6)) for k in range(60)], [(k, some(5)) for k in range(200)]
    found = match.nearest_sets(spark.createDataFrame(queries, "i int, q array<string>"), spark.createDataFrame(sets, "s int, t array<string>"), "i", "q", "s", "t").collect()
    for r in found:
        q = set(queries[r.i][1])
        score = {s: len(q & set(t)) / len(q | set(t)) if q & set(t) else 0.0 for s, t in sets}
        best = max(score.values())
        assert (r.s, r.score, r.n_best) == (min(s for s in score if score[s] == best), best, sum(x == best for x in score.values()))
    assert len(found) == 60


@pytest.mark.parametrize("size", [3, 4096])
def test_segments_across_blocks(spark, monkeypatch, size):
    rng = random.Random(5)
    monkeypatch.setattr(order, "BLOCK_PLACES", size)
    rows = [(e, i, rng.choice("abcdefg") if rng.random() < 0.9 else None) for e in (1, 2, None) for i in range(rng.randrange(20, 90))]
    found = {(r.d, r.i): r.segment for r in order.key_reuse_segments(spark.createDataFrame(rows, "d int, i int, k string"), ["d"], ["i"], "k").collect()}
    for e in (1, 2, None):
        segment, seen = 0, set()
        for d, i, k in rows:
            if d == e:
                if k is not None and k in seen:
                    segment, seen = segment + 1, set()
                seen.add(k)
                assert found[d, i] == segment


def test_greedy_assignment_by_brute_force(spark):
    rng = random.Random(6)
    rows = [(e, o, f"r{o}", f"n{rng.randrange(12)}", rng.randrange(4)) for e in range(5) for o in range(6) for _ in range(rng.randrange(9))]
    found = {(r.d, r.rule, r.item) for r in order.greedy_assignment(spark.createDataFrame(rows, "d int, o int, r string, i string, s int"), ["d"], "o", "r", "i", "s").collect()}
    expected = set()
    for e in range(5):
        used: set = set()
        for o in range(6):
            free = [(-s, i) for d, x, _, i, s in rows if (d, x) == (e, o) and i not in used]
            if free:
                used.add(min(free)[1])
                expected.add((e, f"r{o}", min(free)[1]))
    assert found == expected


def test_templates_claim_in_two_passes(spark):
    names = spark.createDataFrame([("m", x) for x in ("supply air temp", "air temp of supply", "fan")], "m string, n string")
    found = {r.rule: (r.item, r.status) for r in match.assign_templates(names, "m", "n", [("r1", "supply.*temp"), ("r2", "supply.*temp"), ("r3", "^pump")]).collect()}
    assert found == {"r1": ("supply air temp", "matched"), "r2": ("air temp of supply", "loose"), "r3": (None, "missing")}


def test_closure_of_compound_names(spark):
    edges = spark.createDataFrame([("hot-water-pump", "motor"), ("pump", "device")], "child string, parent string")
    found = {(r.node, r.ancestor, r.depth) for r in graph.closure(graph.with_parts(edges)).collect()}
    assert {("hot-water-pump", "pump", 1), ("hot-water-pump", "device", 2), ("hot-water-pump", "motor", 1)} <= found and len(found) == 6


def test_deep_closures_are_whole(spark):
    edges = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(40)], "child string, parent string")
    assert graph.closure(edges).filter("node = 'n0'").count() == 40


def test_scan_of_tables_with_banners_and_continuations(spark):
    from tessera.operators import scan

    family = scan.Family("f", [("id", "object id"), ("name", "point name"), ("unit", "unit")])
    tables = {
        1: [["Controller X", "", ""], ["Object\nID", "Point Name", "Units"], ["AI-1", "Temp", "°C"], ["", "Other", "kW"], ["AI-1", "Again", ""]],
        2: [["Point Name", "Extra", "Object ID"], ["Fan", "e", "BO: 2"], ["Point Name", "", "Object ID"], ["Mode", "", "MV[3]"]],
        3: [["Object ID", "Point Name", "Unit"]],
    }
    cells = spark.createDataFrame([("d", 1, t, r, c, v) for t, rows in tables.items() for r, row in enumerate(rows) for c, v in enumerate(row)], "doc string, page int, tab int, row int, col int, val string")
    points, skipped, unknown = scan.scan(cells, family)
    assert sorted((r.type, r.inst, r["name"], r.unit) for r in points.collect()) == [("AI", 1, "Temp", "degC"), ("BO", 2, "Fan", None), ("MSV", 3, "Mode", None)]
    assert {r.reason: r.n for r in skipped.collect()} == {"no id": 1, "repeat": 1, "header again": 1} and [r.column for r in unknown.collect()] == ["Extra"]


def test_readings_in_step_are_put_together_as_by_the_search(spark):
    rng, rows = random.Random(5), {0: [], 1: []}
    for e in range(300):
        keys = [f"k{k}" for k in range(rng.randrange(9))]
        for side in (0, 1):
            own = [k for k in keys if rng.random() < 0.7] + ["extra"] * (side * rng.randrange(2)) + [None] * (rng.random() < 0.2)
            if e % 3 == 0:
                rng.shuffle(own)
            if e % 5 == 0:
                own += own[:2]
            rows[side] += [(e, p, k, f"{side}{p}") for p, k in enumerate(own)]
    a, b = (spark.createDataFrame(rows[side], "e int, pos int, key string, value string") for side in (0, 1))
    for band in (2, 200):
        found = reconcile.aligned_readings(a, b, ["e"], "pos", "key", "value", band).collect()
        expected = []
        for e in range(300):
            x, y = ([r for r in rows[side] if r[0] == e] for side in (0, 1))
            for i, j in reconcile.side_by_side([r[2] for r in x], [r[2] for r in y], band):
                p, q = (x[i] if i is not None else (None,) * 4), (y[j] if j is not None else (None,) * 4)
                expected.append((e, (p if i is not None else q)[2], p[1], q[1], p[3], q[3]))
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_most_readings_are_put_together_without_a_search():
    import numpy as np
    import pyarrow as pa

    owner, side = np.array([0, 0, 0, 0, 1, 1, 1, 1]), np.array([0, 0, 1, 1, 0, 0, 1, 1])
    i, j, plain = reconcile.in_step(owner, side, pa.array(["a", "b", "b", "c", "a", "b", "b", "a"]), 2, 200)
    assert plain.tolist() == [True, False] and sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(-1, 3), (0, -1), (1, 2)]


def test_pairs_of_names_by_brute_force(spark):
    rng = random.Random(8)
    left = [(rng.randrange(2), rng.choice("uvw"), k) for k in range(40)]
    right = [(rng.randrange(2), rng.choice("xy"), k) for k in range(40)]
    names = [(g, n, o) for g in range(2) for n in "uvz" for o in "xy" if (g, n) != (1, "u")]
    a, b, n = spark.createDataFrame(left, "g int, name string, a int"), spark.createDataFrame(right, "g int, other string, b int"), spark.createDataFrame(names, "g int, name string, other string")
    pairs = match.pairs_of_names(n, a, b, ["g"], "name", "a", "other", "b", most=20)
    assert sorted(map(tuple, pairs.collect())) == sorted((x[2], y[2]) for x in left for y in right if x[0] == y[0] and (x[0], x[1], y[1]) in names)
    # No partition makes all pairs, though each `other` has hundreds.
    sizes = [r.n for r in pairs.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) * 4 < sum(sizes)
    assert match.pairs_of_names(n.limit(0), a, b, ["g"], "name", "a", "other", "b").count() == 0
