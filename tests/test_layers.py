"""Gates over several tables, re-sync of revisions, second readings."""

from __future__ import annotations

import random

from tessera.operators import gates, reconcile


def codes(found):
    return sorted((r.entity, r.level, r.code) for r in found.collect())


def test_crosscheck_codes(spark):
    models = spark.createDataFrame([("a", 10, "x"), ("b", 10, "x"), ("c", 10, "x"), ("d", 10, "manual"), ("e", 10, "x"), ("f", 0, "x"), ("g", 10, "x")], "model string, n_points int, extractor string")
    checks = spark.createDataFrame([("a", None, 10, 10, None), ("b", "", 4, 3, "k"), ("c", "scan", 0, 0, None), ("f", None, 0, 0, None), ("g", None, 0, 0, None)], "model string, unverifiable string, n_both int, n_agree int, example string")
    assert codes(gates.crosscheck_findings(models, checks)) == [
        ("a", "I", "crosscheck-ok"), ("b", "E", "crosscheck"), ("b", "W", "crosscheck-thin"), ("c", "W", "crosscheck-unverifiable"), ("e", "W", "no-crosscheck"), ("g", "W", "crosscheck-none"), ("g", "W", "crosscheck-thin"),
    ]


def test_known_good_codes(spark):
    models = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1), ("d", 1), ("e", 0)], "model string, n_points int")
    points = spark.createDataFrame([("a", "AI", 1, "Supply AIR"), ("b", "AI", 1, "x"), ("b", "AI", 2, None)], "model string, type string, inst int, name string")
    expected = spark.createDataFrame([("a", "AI", 1, "air"), ("b", "AI", 1, "y"), ("b", "AI", 2, "z"), ("b", "AO", 1, "z")], "model string, type string, inst int, part string")
    checks = spark.createDataFrame([("d",)], "model string")
    found = gates.known_good_findings(models, points, expected, checks)
    assert codes(found) == [("a", "I", "known-good-ok"), ("b", "E", "known-good"), ("b", "W", "known-good-missing"), ("c", "W", "no-known-good")]
    assert {r.code: r.message for r in found.filter("entity = 'b'").collect()} == {"known-good": "2 AI-1", "known-good-missing": "1 AO-1"}


def test_verified_and_review_codes(spark):
    grades = spark.createDataFrame([("a", "human", 5), ("b", "weak", 2), ("c", "machine", None)], "model string, grade string, n_points int")
    assert sorted((r.code, r.message) for r in gates.verified_findings(grades).collect()) == [("verified-count", "2/3 5/7"), ("verified-thin", "1 2")]
    assert codes(gates.verified_findings(grades.limit(0))) == [("all", "I", "verified-skip")]
    artefacts = spark.createDataFrame([("p", 5), ("q", 9), ("r", None), ("s", 1)], "artefact string, built_at int")
    inputs = spark.createDataFrame([("p", "i", 7), ("p", "j", 6), ("q", "i", 8), ("r", "i", 1)], "artefact string, input string, changed_at int")
    assert codes(gates.review_findings(artefacts, inputs)) == [("p", "W", "review-stale"), ("r", "I", "review-missing")]


def test_resync_states(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k int, a string, b int")
    old = frame([(1, "x", 1), (2, "x", 1), (3, "x", 1), (4, "x", 1), (5, "x", 1), (6, "x", None), (8, "x", 1), (9, "x", 1), (None, "x", 1)])
    new = frame([(1, "x", 1), (2, "y", 1), (3, "y", 1), (4, "y", 2), (6, "x", 2), (7, "n", 1), (9, "x", 2), (10, "p", 1), (None, "y", 1)])
    curated = frame([(1, "mine", 1), (2, "x", 1), (3, "y", 1), (4, "mine", 1), (5, "x", 1), (6, "x", None), (8, "mine", 1), (10, "q", 1), (11, "own", 1), (None, "x", 1)])
    found = {r.k: (r.a, r.b, r.state, r.conflicts) for r in reconcile.resync(old, new, curated, ["k"], ["a", "b"]).collect()}
    assert found == {
        1: ("mine", 1, "kept", []), 2: ("y", 1, "updated", []), 3: ("y", 1, "converged", []), 4: ("mine", 2, "conflict", ["a"]), 5: ("x", 1, "retired", []), 6: ("x", 2, "updated", []),
        7: ("n", 1, "proposed", []), 8: ("mine", 1, "orphaned", []), 10: ("q", 1, "conflict", ["a"]), 11: ("own", 1, "orphaned", []), None: ("y", 1, "updated", []),
    }


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_side_by_side_is_longest():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        found = reconcile.side_by_side(a, b, 20)
        assert [i for i, _ in found if i is not None] == list(range(len(a))) and [j for _, j in found if j is not None] == list(range(len(b)))
        pairs = [(i, j) for i, j in found if i is not None and j is not None]
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == lcs(a, b)
    long = [str(k) for k in range(3000)]
    assert sum(None not in x for x in reconcile.side_by_side(long, long[5:], 10)) == 2995


def test_readings_side_by_side(spark):
    first = spark.createDataFrame([("d", 1, "a", "1"), ("d", 2, "b", "2"), ("d", 3, "c", "3"), ("e", 1, "a", "1")], "doc string, pos int, key string, value string")
    second = spark.createDataFrame([("d", 1, "b", "2"), ("d", 2, "x", "9"), ("d", 3, "c", None), ("f", 1, "q", "1")], "doc string, pos int, key string, value string")
    aligned = reconcile.aligned_readings(first, second, ["doc"], "pos", "key", "value")
    found = {r.doc: (r.n_both, r.n_agree, r.n_first, r.n_second, r.example) for r in reconcile.reading_agreement(aligned, ["doc"]).collect()}
    assert found == {"d": (2, 1, 1, 1, "c: 3 | "), "e": (0, 0, 1, 0, None), "f": (0, 0, 0, 1, None)}
