"""Saved roles put together again, derived runs, and catalogs of rules: literal cases."""

import json

import pytest

from loomframe.operators import stages
from loomframe.sources import catalogs

ROLE = "episode int, role string, status string, qc_status string, track string, seed string, seed_frame int"


def again(spark, **changes):
    case = {
        "manifest": [(1, "cup", "front", 2)], "roles": [(1, "target", "ok", "passed", "t", "s", 1)], "tracks": [("t", 0, [1, 0]), ("t", 1, [3, 0])], "seeds": [("s", [4, 0])],
    } | changes
    found = stages.rehydrated(
        spark.createDataFrame(case["manifest"], "episode int, task string, camera string, frame_count int"), spark.createDataFrame(case["roles"], ROLE), spark.createDataFrame(case["tracks"], "track string, frame int, mask array<bigint>"),
        spark.createDataFrame(case["seeds"], "seed string, mask array<bigint>"), spark.createDataFrame([(1, "cup", "front", 2)], "episode int, task string, camera string, frames int"), ("target",),
    )
    return tuple(found.first())


def test_a_saved_role(spark):
    assert again(spark) == (1, "target", 2, 3, 1, None)


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({"manifest": []}, "manifest"), ({"manifest": [(1, "pan", "front", 2)]}, "task"), ({"manifest": [(1, "cup", None, 2)]}, "camera"), ({"manifest": [(1, "cup", "front", 3)]}, "frame_count"), ({"roles": []}, "role"),
        ({"roles": [(1, "target", "ok", "passed", "t", "s", 1)] * 2}, "role"), ({"roles": [(1, "target", "ok", None, "t", "s", 1)]}, "status"), ({"roles": [(1, "target", "ok", "passed", None, "s", 1)]}, "track"),
        ({"tracks": [("t", 0, [1]), ("t", 0, [1])]}, "frames"), ({"tracks": [("t", 0, [1])]}, "frames"), ({"roles": [(1, "target", "ok", "passed", "t", "s", 2)]}, "seed_frame"), ({"seeds": [("s", [0, 0])]}, "seed"), ({"seeds": []}, "seed"),
    ],
)
def test_saved_roles_that_can_not_be_used(spark, changes, reason):
    assert again(spark, **changes) == (1, "target", None, None, None, reason)


def test_derived_roles(spark):
    masks = {(1, "target"): [[15]] * 6, (1, "receiver"): [[15]] * 6, (2, "target"): [[0]] * 3 + [[15]] * 3, (3, "target"): [[1], [1 << 63], [1], [1 << 63], [(1 << 40) - 1], [1]], (4, "target"): [[15]] * 6}
    signed = lambda w: w - 2**64 if w >= 2**63 else w
    rows = [(e, r, t, [signed(w) for w in m]) for (e, r), ms in masks.items() for t, m in enumerate(ms)]
    frames = spark.createDataFrame(rows, "episode int, role string, frame int, mask array<bigint>")
    roles = spark.createDataFrame([(1, "target", 1, 3, [15]), (1, "receiver", 1, 3, None), (2, "target", 0, 2, [15]), (3, "target", 0, 5, [1]), (4, "target", 0, 5, [15])], "episode int, role string, start int, end int, seed array<bigint>")
    reviews = spark.createDataFrame([(4, "target", "reject", " the  wrong one "), (1, "target", "accept", "fine")], "episode int, role string, decision string, reason string")
    found = {(r["episode"], r["role"]): r for r in stages.derived_roles(frames, roles, reviews, 1, "run9").collect()}
    told = {k: (r["status"], (r["failure"] or "").split(":")[0], r["frames"], r["pixels"]) for k, r in found.items()}
    assert told == {
        (1, "target"): ("ok", "", 3, 12), (1, "receiver"): ("failed", "empty_text_seed", 3, 0), (2, "target"): ("failed", "native_track_empty_in_output_window", 3, 0), (3, "target"): ("quarantined", "temporal_qc_quarantine", 6, 0),
        (4, "target"): ("quarantined", "identity_qc_reject", 6, 0),
    }
    assert found[4, "target"]["failure"] == "identity_qc_reject:the wrong one" and {r["run"] for r in found.values()} == {"run9"}
    assert found[1, "target"]["source"] == found[4, "target"]["source"] != found[2, "target"]["source"]
    assert stages.derived_roles(frames.limit(0), roles, reviews, 1, "run9").count() == 0


def catalog(spark, tmp_path, value):
    path = tmp_path / "rules.json"
    path.write_text(value if isinstance(value, str) else json.dumps(value))
    return catalogs.rules(spark, str(path))


def test_rules_in_order(spark, tmp_path):
    raw = {"format_version": catalogs.FORMAT, "rules": [{"role": "target", "tasks": [" a "], "aliases": ["x", "y"]}, {"role": "target", "query_words": ["cup"], "aliases": ["z"]}, {"role": "receiver", "query_words": ["cup"], "aliases": ["w"]}]}
    known = catalogs.as_literal(catalog(spark, tmp_path, raw))
    rows = spark.createDataFrame([(1, "target", "a", ["cup"]), (2, "target", "b", ["cup"]), (3, "receiver", "a", ["cup"]), (4, "target", None, None), (5, None, "a", ["cup"])], "id int, role string, task string, words array<string>")
    assert {r["id"]: (r["rule_idx"], r["aliases"]) for r in catalogs.matched(rows, known).collect()} == {1: (0, ["x", "y"]), 2: (1, ["z"]), 3: (2, ["w"]), 4: (None, None), 5: (None, None)}


@pytest.mark.parametrize(
    ("rule", "reason"),
    [
        (1, "mapping"), ({"role": "x", "tasks": ["a"], "aliases": ["b"]}, "role"), ({"role": "target", "tasks": "a", "aliases": ["b"]}, "tasks"), ({"role": "target", "query_words": [" "], "aliases": ["b"]}, "query_words"),
        ({"role": "target", "tasks": ["a"]}, "aliases"), ({"role": "target", "tasks": ["a"], "aliases": [1]}, "aliases"), ({"role": "target", "aliases": ["b"]}, "condition"), ({"role": "target", "tasks": ["a"], "aliases": ["b"]}, None),
    ],
)
def test_what_is_wrong_with_a_rule(spark, tmp_path, rule, reason):
    found = catalog(spark, tmp_path, {"format_version": catalogs.FORMAT, "rules": [rule]})
    assert found.first()["reason"] == reason
    if reason:
        with pytest.raises(ValueError, match="rules"):
            catalogs.as_literal(found)


def test_catalogs_of_other_formats(spark, tmp_path):
    for value in ({"format_version": "x", "rules": []}, {"format_version": catalogs.FORMAT}, [1]):
        with pytest.raises(ValueError, match="catalog"):
            catalog(spark, tmp_path, value)


def test_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    found = catalog(spark, tmp_path, f"format_version: {catalogs.FORMAT}\nrules:\n  - role: target\n    tasks: []\n    query_words: [fan]\n    aliases: [desk fan, \"{{color}} fan\"]\n")
    row = found.first()
    assert (row["tasks"], row["query_words"], row["aliases"], row["reason"]) == ([], ["fan"], ["desk fan", "{color} fan"], None)


GOOD = {"decision": "accept", "selected_candidate": "A", "confidence": 0.9, "reason": "fits"}


@pytest.mark.parametrize(
    ("valid", "answers", "expected"),
    [
        ([True, False], [(1, GOOD, None)], ("passed", "A", 0.9, "fits")), ([False, False], [(1, GOOD, None)], ("rejected", None, None, "basic_checks")), ([True], [], ("error", None, None, "request:none")),
        ([True], [(1, None, "a"), (2, None, "b"), (3, GOOD, None)], ("error", None, None, "request:b")), ([True], [(1, None, "a"), (2, GOOD, None)], ("passed", "A", 0.9, "fits")),
        ([False, True], [(1, GOOD, None)], ("error", None, None, "answer:candidate")), ([True], [(1, GOOD | {"confidence": 0.2}, None)], ("ambiguous", None, 0.2, "confidence")),
        ([True], [(1, GOOD | {"decision": "reject_all", "selected_candidate": None}, None)], ("rejected", None, 0.9, "fits")), ([True], [(1, GOOD | {"decision": "ambiguous", "selected_candidate": None, "confidence": 0.1}, None)], ("ambiguous", None, 0.1, "fits")),
        ([True], [(2, GOOD | {"confidence": 0.1}, None), (1, "{", None)], ("error", None, None, "answer:json")),
    ],
)
def test_reports_of_a_look_at_candidates(spark, valid, answers, expected):
    seen = spark.createDataFrame([(1, chr(65 + i), v) for i, v in enumerate(valid)], "seed int, candidate string, valid boolean")
    said = spark.createDataFrame([(1, n, json.dumps(a) if isinstance(a, dict) else a, e) for n, a, e in answers], "seed int, attempt int, answer string, error string")
    row = stages.visual_reports(seen, said, ["seed"], 2, 0.5).first()
    assert tuple(row)[1:] == expected
