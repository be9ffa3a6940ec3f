"""Files read and written: listings, JSON lines, partitions replaced, receipts; and full timelines on literal signals."""

import math

import pytest
from pyspark.sql import functions as F

from loomframe.functions import geometry
from loomframe.operators import sequence, timeline
from loomframe.sources import episodes, sinks


def test_listing_finds_files_by_name(spark, tmp_path):
    for path in ("data/chunk-000/episode_000001.bin", "video/chunk-000/episode_000001.bin", "sidecar/chunk-000/episode_000001.bin", "data/chunk-000/notes.txt"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(b"x" * 3)
    found = episodes.listing(spark, str(tmp_path), "episode_*")
    assert sorted(r["bytes"] for r in found.collect()) == [3, 3, 3]
    row = episodes.discovered(found).first()
    assert (row["episode"], row["missing"], row["reason"]) == (1, "", None)


def test_json_lines_are_read_and_filtered(spark, tmp_path):
    (tmp_path / "episodes.jsonl").write_text('{"episode_index": 1, "tasks": [" cup "], "full_structured_tasks": ["a"]}\n{"episode_index": 2, "tasks": []}\n')
    lines = spark.read.text(str(tmp_path / "episodes.jsonl"))
    rows = episodes.metadata(lines).orderBy("episode").collect()
    assert [(r["episode"], r["task_text"], r["task"]) for r in rows] == [(1, "cup", "a"), (2, None, None)]
    kept = episodes.filtered_lines(lines, "episode_index", spark.createDataFrame([(2,)], "episode_index long"))
    assert [r["kept"] for r in kept.orderBy("value").collect()] == [False, True]


def test_only_the_partitions_of_new_rows_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = lambda rows: spark.createDataFrame(rows, "run string, episode long, area long")
    sinks.publish(frame([("a", 1, 10), ("b", 2, 20)]), path, "run")
    sinks.publish(frame([("b", 2, 21)]), path, "run")
    assert sorted((r["run"], r["area"]) for r in spark.read.parquet(path).collect()) == [("a", 10), ("b", 21)]
    expected = frame([("a", 1, 10), ("b", 2, 20), ("c", 3, 30)])
    assert {(r["episode"], r["change"]) for r in sinks.verified(spark, path, expected, "episode", ("area",)).collect()} == {(2, "changed"), (3, "missing")}
    receipts = {r["episode"]: r["receipt"] for r in sinks.receipts(expected, "episode", ("area",)).collect()}
    assert len(set(receipts.values())) == 3


def posed(spark, grip, moves_at):
    rows = [(0, f, float(g), [0.01 * max(0, f - moves_at), 0.0, 0.0], [0.0, 0.0, 0.0]) for f, g in enumerate(grip)]
    return spark.createDataFrame(rows, "episode long, frame long, grip double, xyz array<double>, rpy array<double>")


def test_motion_before_closing(spark):
    grip = [1.0] * 8 + [0.7, 0.4, 0.1, 0.1, 0.1, 0.3, 0.6, 0.95, 0.95, 0.95]
    row = timeline.pick_place(posed(spark, grip, 3)).first()
    assert (row["move_start"], row["close_start"], row["close_done"], row["open_start"], row["open_done"]) == (4, 8, 12, 13, 17)
    assert timeline.pick_place(posed(spark, grip, 30)).first()["move_start"] == 8


def test_a_target_that_is_held_to_the_end(spark):
    row = timeline.target_only(posed(spark, [1.0] * 8 + [0.7, 0.4] + [0.1] * 9, 3)).first()
    assert (row["remove_start"], row["close_start"], row["close_end"], row["accepted"], row["frames"]) == (4, 8, 12, True, 19)
    events = spark.createDataFrame([(0, 4, 8, 12, None, None, 19)], "episode long, move_start long, close_start long, close_done long, open_start long, open_done long, frames long")
    hold = timeline.hold_window(events).first()["hold"]
    assert (hold["start"], hold["end"]) == (13, 18)
    shown = sequence.semantic_frames(events).orderBy("frame").collect()
    assert [(r["frame"], r["purpose"]) for r in shown] == [(f, "pre_grasp_seed_candidate") for f in (0, 1, 3, 4)] + [(13, "post_grasp_context"), (15, "post_grasp_context")]


def test_windows_of_earlier_and_later_versions(spark):
    events = spark.createDataFrame([(0, 4, 8, 12, 13, 17, 20)], "episode long, move_start long, close_start long, close_done long, open_start long, open_done long, frames long")
    for held, end in ((True, 12), (False, 12)):
        w = timeline.recorded_windows(events, F.lit(held)).first()
        assert tuple(w["target_0"]) == (4, end)
        assert tuple(w["operation"]) == tuple(w["gripper"]) == (4, 17)
        assert tuple(w["receiver_0"]) == (12, 17)


@pytest.mark.parametrize(("drive", "expected"), [(0.5, 0.02), (5.0, 0.04), (-1.0, 0.0)])
def test_joint_positions_stay_within_limits(spark, drive, expected):
    assert spark.range(1).select(geometry.joint_position(F.lit(drive), 0.0, 0.04, 0.04)).first()[0] == pytest.approx(expected)


def test_grids_end_with_their_end(spark):
    assert spark.range(1).select(geometry.grid(F.lit(0.0), F.lit(1.0), 0.4)).first()[0] == pytest.approx([0.0, 0.4, 0.8, 1.0])


def test_rotations_keep_lengths(spark):
    x, y, z = geometry.chain([([F.lit(0.3), F.lit(-0.2), F.lit(1.1)], [F.lit(0.0)] * 3)], [F.lit(1.0), F.lit(2.0), F.lit(3.0)])
    assert math.hypot(*spark.range(1).select(x, y, z).first()) == pytest.approx(math.sqrt(14))
