"""Tag sets handed down in expansion trees, names restored from their page."""

from __future__ import annotations

from tessera.operators import graph, headers


def test_tags_are_handed_down_by_choice_and_in_compounds(spark):
    protos = [("plant", ["equip", "pipe", "chilled", "water"]), ("plant", ["point", "run"]), ("pipe", ["point", "temp"]), ("pipe", ["equip", "pump"]), ("pump", ["point", "run"]), ("pump", ["equip", "pipe"]), ("pump", ["equip", "unknown"]), ("pipe", ["point"])]
    definitions = [("pipe", "pipe"), ("pump", "pump"), ("chilled-water", "chilled"), ("chilled-water", "water"), ("water", "water"), ("chilled", "chilled"), ("water-pump", "water"), ("water-pump", "pump"), ("equip", "equip")]
    ancestors = [("pipe", "equip"), ("pump", "equip"), ("chilled-water", "fluid"), ("water", "fluid"), ("water-pump", "equip"), ("water-pump", "pump"), ("equip", "entity")]
    flatten = [("pipe", "fluid"), ("water-pump", "fluid")]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    found = graph.expand_sets(frame(protos, "def string, tags array<string>"), frame(definitions, "def string, part string"), frame(ancestors, "node string, ancestor string"), frame(flatten, "def string, choice string"), frame([("plant",)], "def string"), wildcards=(("point",),))
    rows = {(r.depth, r.path, r.label, r.tags, r.target, r.gap) for r in found.collect()}
    pipe = "chilled equip pipe water"
    assert rows == {
        (0, "", "point run", "point run", None, None), (0, "", pipe, pipe, "pipe", None),
        # water is a fluid; chilled is handed down with it, as chilled-water is one.
        (1, pipe, "point temp", "chilled point temp water", None, None), (1, pipe, "equip pump", "chilled equip pump water", "pump", None),
        # The pump has no choices of its own, so nothing goes further down.
        (2, f"{pipe}/equip pump", "point run", "point run", None, None), (2, f"{pipe}/equip pump", "equip pipe", "equip pipe", "pipe", "cycle"), (2, f"{pipe}/equip pump", "equip unknown", "equip unknown", None, "no definition"),
    }


def test_depth_is_a_gap(spark):
    frame = spark.createDataFrame
    protos = frame([("a", ["equip", "b"]), ("b", ["equip", "c"]), ("c", ["point", "x"])], "def string, tags array<string>")
    definitions = frame([("b", "b"), ("c", "c")], "def string, part string")
    ancestors = frame([("b", "equip"), ("c", "equip")], "node string, ancestor string")
    found = graph.expand_sets(protos, definitions, ancestors, frame([], "def string, choice string"), frame([("a",)], "def string"), max_depth=1)
    assert sorted((r.depth, r.target, r.gap) for r in found.collect()) == [(0, "b", None), (1, "c", "depth")]


def test_names_come_back_from_their_own_page(spark):
    words = [(1, k, w) for k, w in enumerate(["S2_HI_MTR_T", "S1_COND_FAN_", "VSD_FAULT", "A_B", "AB_", "SPARE", "AV1"])] + [(2, 0, "COND_FAN_1A")]
    values = [(1, "_ _ S2 HI MTR T"), (1, "S1CONDFANVSDFAULT"), (1, "A B"), (1, "CONDFAN1A"), (2, "CONDFAN1A"), (1, "nowhere"), (1, "SPARE"), (1, None), (3, "x")]
    found = headers.restored_by_page(spark.createDataFrame(values, "page int, name string"), spark.createDataFrame(words, "page int, pos int, word string"), ["page"], "name").collect()
    assert {(r.page, r.name, r.restored, r.found) for r in found} == {
        (1, "_ _ S2 HI MTR T", "S2_HI_MTR_T", True), (1, "S1CONDFANVSDFAULT", "S1_COND_FAN_VSD_FAULT", True), (1, "A B", "A B", False), (1, "CONDFAN1A", "CONDFAN1A", False),
        (2, "CONDFAN1A", "COND_FAN_1A", True), (1, "nowhere", "nowhere", False), (1, "SPARE", "SPARE", True), (1, None, "", True), (3, "x", "x", False),
    }
