"""Arms of recordings, plans, datasets, composite episodes, repaired queries, channels and digests: literal cases."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loomframe.operators import contracts, quality, timeline
from loomframe.sources import episodes

ARMS = "recording int, arm string, loops int, holds boolean, close_start int, close_done int"


@pytest.mark.parametrize(
    ("left", "right", "expected"),
    [
        ((1, False, 5, 9), (0, False, 2, 4), ("pick_place", "left")), ((1, False, 5, 9), (1, False, 2, 4), ("other", "right")), ((0, True, 5, 9), (0, False, 2, 4), ("close_hold", "left")),
        ((0, True, 5, 9), (0, True, 2, 4), ("other", "right")), ((0, False, 5, 9), (0, False, 2, None), ("other", "left")), ((0, False, 5, 9), (0, False, 5, 7), ("other", "both")),
        ((0, False, None, None), (0, False, 3, None), ("other", "none")), ((0, False, None, None), (0, False, 3, 6), ("other", "right")),
    ],
)
def test_arm_of_a_recording(spark, left, right, expected):
    row = timeline.shapes(spark.createDataFrame([(1, "left", *left), (1, "right", *right)], ARMS), "recording").first()
    assert (row["shape"], row["arm"]) == expected


def test_candidates_need_geometry_and_files(spark):
    arms = spark.createDataFrame([(i, a, 1 if (a, i) == ("left", i) else 0, False, 1, 3) for i in range(4) for a in ("left", "right")] + [(4, "left", 0, False, 1, 3)], ARMS)
    known = spark.createDataFrame([(0, True), (1, False), (2, True), (3, None), (4, True)], "recording int, geometry_valid boolean")
    files = spark.createDataFrame([(i, p) for i in range(5) for p in ("video", "sidecar", "video")], "recording int, part string").where("not (recording = 2 and part = 'sidecar')")
    found = contracts.candidate_recordings(arms, known, files, ("video", "sidecar"), "recording")
    assert sorted((r["recording"], r["shape"]) for r in found.collect()) == [(0, "pick_place"), (4, "other")]
    only = contracts.candidate_recordings(arms, known, files, ("video", "sidecar"), "recording", single_loop=True)
    assert [r["recording"] for r in only.collect()] == [0]


def test_plans_of_a_resumed_run(spark):
    expected = spark.createDataFrame([("r", e, e, "d") for e in (1, 2, 3, 4, 5, 6)], "run string, episode int, place int, digest string")
    records = spark.createDataFrame([("r", 4, "pending"), ("r", 5, "complete"), ("r", 6, "pending")], "run string, episode int, status string")
    outputs = spark.createDataFrame([("r", 6)], "run string, episode int")
    case = lambda *plans: sorted((r["episode"], r["reason"]) for r in contracts.plan_violations(spark.createDataFrame([("r", *p) for p in plans], "run string, episode int, position int, digest string"), expected, records, outputs).collect())
    rest = [(5, "unplanned"), (6, "published")]
    assert case((1, 0, "d"), (2, 1, "d"), (3, 2, "d")) == rest  # 4 is pending and untouched
    assert case((1, 0, "d"), (3, 1, "d"), (2, 2, "d")) == sorted([*rest, (2, "order")])
    assert case((1, 0, "x"), (2, 1, "d"), (2, 2, "d"), (3, 3, None), (9, 4, "d")) == sorted([*rest, (1, "changed"), (2, "repeated"), (3, "changed"), (9, "undeclared")])


def test_dashboard(spark):
    rows = [("a", s) for s in ("completed", "failed", "skipped_by_hand", "running", "not_run_after_fatal_cuda", "pending", "", None)]
    records = spark.createDataFrame(rows, "run string, status string").select("run", quality.status_category(F.col("status")).alias("category"))
    found = {r["run"]: r for r in contracts.dashboard(records, spark.createDataFrame([("a", 20), ("b", 3)], "run string, total int")).collect()}
    assert [found["a"][n] for n in ("total", "success", "failed", "skipped", "running", "not_run", "remaining")] == [20, 1, 1, 1, 1, 1, 15]
    assert (found["b"]["total"], found["b"]["remaining"]) == (3, 3)
    few = contracts.dashboard(records, spark.createDataFrame([("a", 2)], "run string, total int")).first()
    assert (few["total"], few["remaining"]) == (8, 3)  # more were seen than declared


def part(**changes):
    return json.dumps({k: v for k, v in ({"profile": "pick_place", "task": "cup", "camera": "front", "episode_indices": [1, 2]} | changes).items() if v is not ...})


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        (part(), None), (None, "json"), ("{", "json"), (part() + "}", "json"), ("[]", "json"), (part(profile="target_only"), "profile"), (part(task=""), "task"), (part(camera=...), "camera"), (part(episode_indices=[]), "episodes"),
        (part(episode_indices=...), "episodes"), (part(episode_indices=[1, 2.5]), "numbers"), (part(episode_indices=[1, True]), "numbers"), (part(episode_indices=[1, 1]), "repeated_episodes"), (part(task="pan"), "absent"),
    ],
)
def test_manifests_of_datasets(spark, value, reason):
    row = contracts.resolved_datasets(spark.createDataFrame([("/d", value)], "root string, value string"), "pick_place", "cup").first()
    assert row["reason"] == reason and (row["episodes"] == [1, 2]) == (reason is None)


def test_collections_of_datasets(spark):
    whole = lambda *names, **more: json.dumps({"profile": "pick_place", "datasets": [{"task": n} for n in names]} | more)
    rows = [("/c", whole("cup", "pan", "mug")), ("/c/cup", part()), ("/c/pan", part(task="pan", camera="")), ("/e", whole()), ("/r", whole("a", "a")), ("/n", whole("../x")), ("/p", whole("cup", profile="x"))]
    frame = spark.createDataFrame(rows, "root string, value string")
    found = {(r["root"], r["part"]): (r["task"], r["reason"]) for r in contracts.resolved_datasets(frame, "pick_place").collect()}
    assert found == {("/c", "cup"): ("cup", None), ("/c", "pan"): (None, "camera"), ("/c", "mug"): (None, "part"), ("/e", None): (None, "datasets"), ("/r", None): (None, "repeated"), ("/n", None): (None, "names"), ("/p", None): (None, "profile")}
    one = {(r["root"], r["part"]): r["reason"] for r in contracts.resolved_datasets(frame, "pick_place", "cup").collect()}
    assert one["/c", "cup"] is None and ("/c", "pan") not in one and one["/r", None] == "repeated"


FULL = "episode int, move_start int, close_start int, close_done int, open_start int, open_done int"


@pytest.mark.parametrize(
    ("given", "missing", "expected"),
    [
        (None, "", ((3, 14), "detected", None)), (None, "video", ((None, None), None, "missing")), ((1, 2, 4, 6, 8, 1, 8), "", ((1, 8), "recorded", None)), ((1, 2, 4, 6, 8, 1, 9), "", ((None, None), None, "loop")),
        ((1, 2, 4, 6, 8, None, 8), "", ((None, None), None, "together")), ((1, 2, 4, 6, 8, 1, 15), "", ((None, None), None, "window")), ((3, 5, 9, None, None, 3, 14), "", ((3, 14), "recorded", None)),
        ((3, 5, 9, None, None, 3, 9), "", ((None, None), None, "hold")), ((3, 5, 15, None, None, 3, 14), "", ((None, None), None, "close_end")),
    ],
)
def test_composite_episodes(spark, given, missing, expected):
    rows = spark.createDataFrame([(1, 15, missing)], "episode int, frames int, missing string")
    found = contracts.composite(rows, spark.createDataFrame([(1, 3, 5, 9, 10, 14)], FULL), spark.createDataFrame([(1, *given)] if given else [], FULL + ", start int, end int")).first()
    assert ((found["start"], found["end"]), found["origin"], found["reason"]) == expected
    none = contracts.composite(rows, spark.createDataFrame([(1, 3, 5, 9, 10, None)], FULL), spark.createDataFrame([], FULL + ", start int, end int")).first()
    assert none["reason"] == (missing and "missing" or "none")


@pytest.mark.parametrize(
    ("evidence", "seeds", "expected"),
    [([], [], []), ([5, 7, 9], [1, 2], [5, 9]), ([5], [1, 2, 3], [1, 5]), ([5], [], [5]), ([], [1, 2, 3], [1, 3]), ([8, 9], [1], [8, 9]), ([], [4], [4])],
)
def test_context_frames(spark, evidence, seeds, expected):
    row = spark.createDataFrame([(evidence, seeds)], "e array<int>, s array<int>").select(contracts.context_frames(F.col("e"), F.col("s")).alias("x")).first()
    assert row["x"] == expected


def test_a_slot_is_kept_for_a_prior(spark):
    row = lambda most, prior: spark.createDataFrame([(list("abcd"), prior)], "q array<string>, p boolean").select(contracts.capped_queries(F.col("q"), most, F.col("p")).alias("x")).first()["x"]
    assert (row(3, True), row(3, False), row(3, None), row(1, True)) == (["a", "b"], ["a", "b", "c"], ["a", "b", "c"], ["a"])


FIELDS = ("category_query", "color_category_query", "shape_category_query", "general_fallback_query")


@pytest.mark.parametrize(
    ("values", "order", "bank", "repaired", "reason"),
    [
        (("cup", "red cup", None, "thing"), ["general_fallback_query", "category_query"], {0: "cup", 1: "red cup", 3: "thing"}, [0, 1, 3], None), (("cup", "cup", None, None), ["color_category_query"], {0: "cup"}, [0], None),
        ((None, "red  cup", "red cup ", None), ["shape_category_query", "color_category_query"], {2: "red cup "}, [2], None), (("a", None, None, None), ["a"], None, None, "unknown"),
        (("a", None, None, None), ["category_query", " category_query"], None, None, "repeated"), ((None, None, None, None), [], {}, [], None), (("a", "b", None, None), ["shape_category_query", "color_category_query"], {0: "a", 1: "b"}, [1, 0], None),
        (("a", None, "a", "a"), ["general_fallback_query"], {0: "a"}, [0], None),
    ],
)
def test_repaired_banks(spark, values, order, bank, repaired, reason):
    frame = spark.createDataFrame([(*values, order)], ", ".join(f"{f} string" for f in FIELDS) + ", order array<string>")
    row = contracts.repaired_bank(frame, FIELDS, "order", "category_query", "general_fallback_query").first()
    assert row["reason"] == reason
    assert row["bank"] == (None if bank is None else {FIELDS[i]: v for i, v in bank.items()})
    assert row["order"] == (None if repaired is None else [FIELDS[i] for i in repaired])


def test_channels_with_a_track(spark):
    rows = [(1, ch, t, [ch + 1], 1, "valid", "passed") for ch in range(4) for t in range(2)] + [(2, 0, 0, [7], 2, "valid", "passed"), (2, 2, 0, [7], 1, "valid", "passed")]
    frames = spark.createDataFrame(rows, "episode int, channel int, frame int, mask array<bigint>, code int, status string, qc_status string")
    track = spark.createDataFrame([(1, 0, [9])], "episode int, frame int, mask array<bigint>")
    found = contracts.composed_channels(frames, track, spark.createDataFrame([(1, "right")], "episode int, arm string"))
    got = {(r["episode"], r["channel"], r["frame"]): (r["mask"], r["code"], r["status"], r["qc_status"]) for r in found.collect()}
    assert got[1, 3, 0] == ([9], 1, "valid", "not_run") and got[1, 3, 1] == ([0], 0, "valid", "not_run") and got[1, 2, 0] == ([0], 0, "not_annotated", "not_run")
    assert got[1, 1, 1] == ([2], 1, "valid", "passed") and got[2, 0, 0][1] == 2 and (2, 2, 0) not in got
    assert contracts.composition_differences(found, frames).count() == 0
    changed = found.withColumn("code", F.when(F.col("channel") == 0, 0).otherwise(F.col("code")))
    assert contracts.composition_differences(changed, frames).count() == 3


def test_digests_of_canonical_json(spark):
    value = {"b": {"z": 1, "a": [1, None, "é"]}, "a": None, 'q"': True}
    digest = hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    rows = [(1, json.dumps(value)), (2, json.dumps(value | {"sha": digest})), (3, json.dumps(value | {"sha": "0" * 64})), (4, json.dumps(value | {"sha": "short"})), (5, "[1]"), (6, None), (7, "{}")]
    frame = spark.createDataFrame(rows, "id int, value string").select("id", F.sha2(contracts.canonical_json(F.col("value"), "sha"), 256).alias("d"), contracts.self_hash_reason(F.col("value"), "sha").alias("r"))
    got = {r["id"]: (r["d"], r["r"]) for r in frame.collect()}
    assert got[1] == (digest, "none") and got[2] == (digest, None) and got[3] == (digest, "changed") and got[4] == (digest, "none") and got[5] == got[6] == (None, "json")
    assert got[7] == (hashlib.sha256(b"{}").hexdigest(), "none")


def test_records_of_all_kinds(spark):
    found = contracts.all_records(a=spark.createDataFrame([(1, "x")], "episode int, reason string"), b=spark.createDataFrame([(2, 5)], "episode int, frames int"))
    assert sorted((r["episode"], r["kind"], r["reason"], r["frames"]) for r in found.collect()) == [(1, "a", "x", None), (2, "b", None, 5)]


def test_what_is_wrong_with_files_of_states(spark):
    good, joints = [0.0] * 14, [0.0] * 12
    rows = [("ok", t, 7, good, joints) for t in range(3)] + [("gap", t, 7, good, joints) for t in (0, 2)] + [("two", 0, 7, good, joints), ("two", 1, 8, good, joints)]
    rows += [("bad", 0, 7, good[:13], joints), ("bad", 1, 7, None, joints[:3]), ("bad", 2, 7, good, [float("inf")] * 12), ("none", None, None, good, joints)]
    frame = spark.createDataFrame(rows, f"file string, frame_index bigint, episode_index bigint, {episodes.STATE.split(', ', 2)[2]}")
    got = {r["file"]: (r["odd_states"], r["odd_joints"], r["reasons"]) for r in episodes.file_violations(frame, "file", 12).collect()}
    assert got == {"ok": (0, 0, ""), "gap": (0, 0, "frames"), "two": (0, 0, "episodes"), "bad": (2, 2, "states,joints"), "none": (0, 0, "frames,episodes")}
    assert episodes.joint_violations(frame, 12).count() == 2
