"""The worker over several batches, timelines of three versions, publications that stop half-way, joint trees and archives."""

import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import joints
from loomframe.sources import archives, contexts, publication
from loomframe.streaming import run_state

# --- worker

RECEIPTS = "episode long, seq long, at timestamp, status string, error string"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def outcome(spark, tmp_path, batches, deadline=60):
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, RECEIPTS).coalesce(1).write.parquet(f"{folder}/{i}")
    files = sorted(folder.glob("*/part-*.parquet"))
    for i, f in enumerate(files):  # in this order
        import os

        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(RECEIPTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    with run_state.rocks_state(spark):
        found = run_state.finished(run_state.worked(stream, deadline * 60_000, "10 minutes"), str(tmp_path / "state"), "update", "episode", "version")
    return {r["episode"]: (r["receipts"], r["status"], r["error_type"]) for r in found.collect()}


FIRST = [(1, 1, at(0), "running", None), (2, 2, at(1), "running", None), (3, 3, at(2), "running", None), (4, 4, at(3), "completed", None)]
SECOND = [(1, 5, at(30), "completed", None), (3, 6, at(20), "completed", "decode failed"), (4, 4, at(3), "completed", None), (4, 7, at(40), "running", None), (1, 1, at(0), "running", None)]
THIRD = [(2, 8, at(90), "completed", None), (5, 9, at(200), "running", None), (1, 5, at(30), "completed", None)]
EXPECTED = {1: (2, "complete", None), 2: (2, "failed", "SourceEpisodeUnavailable"), 3: (2, "failed", "SourceFailed"), 4: (2, "complete", None), 5: (1, "pending", None)}


def test_worker_in_one_batch(spark, tmp_path):
    assert outcome(spark, tmp_path, [FIRST + SECOND + THIRD]) == EXPECTED


def test_worker_in_batches_with_receipts_sent_twice(spark, tmp_path):
    # what comes again after the watermark is dropped, what comes before it counts once
    found = outcome(spark, tmp_path, [FIRST, SECOND, THIRD])
    assert {k: v[1:] for k, v in found.items()} == {k: v[1:] for k, v in EXPECTED.items()}
    assert (found[1][0], found[3][0]) == (2, 2)


def test_worker_takes_the_earliest_ready_receipt(spark, tmp_path):
    rows = [(1, 2, at(5), "completed", "x"), (1, 1, at(5), "skipped_complete", None), (1, 3, at(0), "running", None)]
    assert outcome(spark, tmp_path, [rows])[1] == (3, "complete", None)


# --- timelines


def recording(version, mode="pick_place", **changes):
    """A right one of 15 frames; target-only closes at 5 to 9 and holds."""
    loop = mode == "pick_place"
    events = {"active_arm": "right", "t_move_start": 3, "t_close_start": 5, "t_close_done": 9, "t_open_start": 10, "t_open_done": 14} if loop else {"active_arm": "right", "t_remove_start": 3, "t_close_start": 5, "t_close_end": 9}
    target = [3, 9] if version < 3 or loop else [3, 14]
    windows = {"operation": [3, 14], "target_0": target, "receiver_0": [9, 14] if loop else None, "gripper": [3, 14]}
    value = {"format_version": f"a_project_loop_context_v{version}", "episode": {"task": "move_pillbottle_pad", "episode_index": 7152, "episode_id": "007152", "camera": "cam_high"}, "frame_count": 15, "events": events, "windows": windows}
    if version == 1:
        windows["loop"] = windows.pop("operation")
        del windows["gripper"]
    else:
        value |= {"annotation_mode": mode, "timeline_kind": "pick_place" if loop else "close_hold", "required_object_roles": ["target", "receiver"] if loop else ["target"]}
    for path, new in changes.items():
        part = value
        *way, last = path.split("__")
        for step in way:
            part = part[step]
        if new is ...:
            del part[last]
        else:
            part[last] = new
    return json.dumps(value)


def decoded(spark, *values):
    rows = spark.createDataFrame([(i, v, "move_pillbottle_pad", 7152, "cam_high") for i, v in enumerate(values)], "mode_ int, value string, task string, episode long, camera string")
    return [r for r in contexts.decoded(rows).orderBy("mode_").collect()]


def test_recordings_of_all_versions(spark):
    a, b, c, d, e = decoded(spark, recording(1), recording(2), recording(3), recording(2, "target_only"), recording(3, "target_only"))
    assert [r["reason"] for r in (a, b, c, d, e)] == [None] * 5
    assert [r["version"] for r in (a, b, c, d, e)] == [1, 2, 3, 2, 3]
    assert tuple(a["gripper"]) == tuple(d["gripper"]) == (3, 14) and tuple(a["receiver_0"]) == (9, 14) and d["receiver_0"] is None
    assert tuple(d["target_0"]) == (3, 9) and tuple(e["target_0"]) == (3, 14)
    assert tuple(e["hold"]) == (10, 14) and c["hold"] is None  # opening follows closing at once
    assert d["open_start"] is None and d["open_done"] is None and d["active_arm"] == "right"


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        (None, "json"), ("", "json"), ("{oops", "json"), ("[1]", "object"), ("null", "object"), (recording(4), "format_version"), (recording(2, format_version=2), "format_version"),
        (recording(1, episode=None), "episode"), (recording(1, episode__task="other"), "episode.task"), (recording(1, episode__episode_index=7152.0), "episode.episode_index"),
        (recording(1, episode__episode_index=True), "episode.episode_index"), (recording(1, episode__episode_id="7152"), "episode.episode_id"), (recording(1, episode__camera=...), "episode.camera"),
        (recording(1, frame_count=0), "frame_count"), (recording(1, frame_count="15"), "frame_count"), (recording(1, frame_count=True), "frame_count"), (recording(2, annotation_mode="x"), "annotation_mode"), (recording(2, annotation_mode=None), "annotation_mode"),
        (recording(2, required_object_roles=...), "required_object_roles"), (recording(2, required_object_roles=["receiver", "target"]), "required_object_roles"), (recording(1, required_object_roles=["target"]), "required_object_roles"),
        (recording(3, events=[]), "events"), (recording(3, events__active_arm="both"), "active_arm"), (recording(3, windows=None), "windows"), (recording(1, annotation_mode="target_only"), "version"),
        (recording(2, timeline_kind="close_hold"), "timeline_kind"), (recording(2, events__extra=1), "events.keys"), (recording(2, "target_only", events__t_open_done=14), "events.keys"), (recording(1, events__t_open_done=14.5), "events.numbers"),
        (recording(1, events__t_close_done=5), "events.order"), (recording(3, events__t_move_start=-1), "events.order"), (recording(1, frame_count=14), "events.end"), (recording(2, "target_only", frame_count=9), "events.end"),
        (recording(1, windows__loop=[3, 13]), "windows.loop"), (recording(1, windows__gripper=[3, 9]), "windows.gripper"), (recording(1, windows__gripper=None), None), (recording(1, windows__more=1), None),
        (recording(2, windows__more=1), "windows.keys"), (recording(2, "target_only", windows__gripper=[3, 9]), "windows.gripper"), (recording(2, "target_only", windows__receiver_0=[9, 14]), "windows.receiver_0"),
        (recording(3, windows__target_0=[3, 8]), "windows.target_0"), (recording(3, windows__operation=[3, 14, 15]), "windows.operation"), (recording(3, windows__operation=[3, 14.0]), "windows.operation"),
    ],
)
def test_what_is_wrong_with_a_recording(spark, value, reason):
    (row,) = decoded(spark, value)
    assert row["reason"] == reason
    assert (row["operation"] is None) == (reason is not None)


# --- publications


def table(spark, rows):
    return spark.createDataFrame(rows, "run string, episode int, name string, stage int")


def rows_of(spark, root, like, **more):
    return sorted((tuple(r) for r in publication.published(spark, root, "t", like, ["run"], **more).collect()), key=str)


def test_publication_replaces_only_its_partitions(spark, tmp_path):
    root, a = str(tmp_path), table(spark, [("a", 1, "x", 1), ("a", 2, None, 2), ("b", 1, "y", 3)])
    assert publication.version(spark, root) == 0 and rows_of(spark, root, a) == []
    assert publication.publish(spark, {"t": a}, root, ["run"]) == 1
    b = table(spark, [("b", 9, "z", 4), ("b", 9, "z", 4)])
    assert publication.publish(spark, {"t": b}, root, ["run"]) == 2
    assert rows_of(spark, root, a) == [("a", 1, "x", 1), ("a", 2, None, 2), ("b", 9, "z", 4), ("b", 9, "z", 4)]
    assert len(rows_of(spark, root, a, at=1)) == 3


def test_a_publication_that_stops_leaves_the_old_one(spark, tmp_path, monkeypatch):
    root, a = str(tmp_path), table(spark, [("a", 1, "x", 1)])
    publication.publish(spark, {"t": a}, root, ["run"])
    new = {"t": table(spark, [("a", 2, "new", 1)])}
    for step in ("stage", "check", "commit"):  # a crash before each of the steps
        with monkeypatch.context() as m:
            m.setattr(publication, step, lambda *_, **__: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                publication.publish(spark, new, root, ["run"])
        assert rows_of(spark, root, a) == [("a", 1, "x", 1)] and publication.version(spark, root) == 1
    left = publication.unused(spark, root)
    assert len(left) == 2 and publication.vacuum(spark, root) == left and publication.unused(spark, root) == []
    assert publication.publish(spark, new, root, ["run"]) == 2 and rows_of(spark, root, a) == [("a", 2, "new", 1)]


def test_what_breaks_a_rule_is_not_published(spark, tmp_path):
    root, a = str(tmp_path), table(spark, [("a", 1, "x", 1)])
    publication.publish(spark, {"t": a}, root, ["run"])
    with pytest.raises(publication.Rejected, match="u:"):
        publication.publish(spark, {"t": table(spark, [("a", 3, "x", 1)]), "u": table(spark, [("a", -1, "x", 1)])}, root, ["run"], {"u": lambda t: t.where("episode < 0")})
    assert rows_of(spark, root, a) == [("a", 1, "x", 1)]


def test_two_cannot_commit_the_same_version(spark, tmp_path):
    root, a = str(tmp_path), table(spark, [("a", 1, "x", 1)])
    name = publication.stage({"t": a}, root, ["run"])
    made = publication.check(spark, {"t": a}, root, name, ["run"], {})
    publication.commit(spark, root, name, made, 0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        publication.commit(spark, root, name, made, 0)


def test_resume_leaves_out_what_is_there(spark, tmp_path):
    root, a = str(tmp_path), table(spark, [("a", 1, "x", 1), ("b", 1, "y", 1), (None, 5, "n", 1)])
    publication.publish(spark, {"t": a}, root, ["run"])
    assert publication.publish(spark, {"t": a}, root, ["run"], resume=True) == 1
    publication.publish(spark, {"t": table(spark, [("a", 1, "x", 1), ("b", 2, "y", 1)])}, root, ["run"], resume=True)
    stages = {r["partition"]: r["stage"] for r in publication.commits(spark, root).where("version = 2").collect()}
    first = {r["partition"]: r["stage"] for r in publication.commits(spark, root).where("version = 1").collect()}
    assert {k for k in stages if stages[k] != first[k]} == {'{"run":"b"}'} and len(stages) == 3
    assert {r[1] for r in rows_of(spark, root, a)} == {1, 2, 5}


# --- joint trees

ROBOT = """<?xml version="1.0"?><robot name="r"><link name="base"/><link name="arm"/><link name="hand"/><link name="tip"/>
<joint name="turn" type="revolute"><parent link="base"/><child link="arm"/><origin xyz="0 0 1" rpy="0 0 1.5707963267948966"/><axis xyz="0 0 2"/><limit lower="-1" upper="1"/></joint>
<joint name="slide" type="prismatic"><parent link="arm"/><child link="hand"/><origin xyz="1 0 0"/><axis xyz="1 0 0"/></joint>
<joint name="fix" type="fixed"><parent link="hand"/><child link="tip"/><origin rpy="0 1.5707963267948966 0" xyz="0 0 0.5"/></joint></robot>"""


def judged(spark, *xml):
    return joints.judged(joints.models(spark.createDataFrame(list(enumerate(xml)), "id int, xml string")))


def test_poses_of_links(spark):
    model = judged(spark, ROBOT)
    assert model.first()["root"] == "base" and model.first()["reason"] is None
    rows = [(0, 1, {"turn": math.pi / 2, "slide": 2.0}), (0, 2, None), (0, 3, {"other": 1.0}), (0, 4, {"turn": float("nan")})]
    found = joints.link_poses(model, spark.createDataFrame(rows, "id int, frame int, positions map<string,double>"), ["id"]).collect()
    got = {(r["frame"], r["link"]): r["pose"] for r in found}
    assert [got[1, "hand"][i] for i in (3, 7, 11)] == pytest.approx([-3, 0, 1], abs=1e-12)
    assert [got[1, "tip"][i] for i in (3, 7, 11)] == pytest.approx([-3, 0, 1.5], abs=1e-12)
    assert [got[2, "hand"][i] for i in (3, 7, 11)] == pytest.approx([0, 1, 1], abs=1e-12)
    assert got[2, "tip"][2] == pytest.approx(0, abs=1e-12) and got[2, "tip"][8] == pytest.approx(-1)
    assert {(r["frame"], r["reason"]) for r in found if r["link"] is None} == {(3, "unknown_joint"), (4, "position")}


@pytest.mark.parametrize(
    ("old", "new", "reason"),
    [
        ("<robot", "<machine", "xml"), ('<link name="tip"/>', '<link name="hand"/>', "link_names"), ('<link name="tip"/>', "<link/>", "link_names"), ('name="fix"', 'name="slide"', "joint_names"), ('type="fixed"', 'type="ball"', "type"),
        ('<child link="tip"/>', '<child link="toe"/>', "unknown_link"), ('<child link="tip"/>', '<child link="arm"/>', "parents"), ('xyz="1 0 0"/><axis', 'xyz="1 0"/><axis', "vector"), ('xyz="0 0 2"', 'xyz="0 0 0"', "axis"),
        ('lower="-1"', 'lower="low"', "limit"), ('<link name="tip"/>', '<link name="tip"/><link name="loose"/>', "root"), ('<parent link="hand"/>', '<parent link="tip"/>', "unreached"),
    ],
)
def test_what_is_wrong_with_a_model(spark, old, new, reason):
    assert judged(spark, ROBOT.replace(old, new, 1)).first()["reason"] == reason


def test_models_of_odd_rows(spark):
    circle = '<robot><link name="a"/><link name="b"/><link name="c"/><joint name="x" type="fixed"><parent link="b"/><child link="c"/></joint><joint name="y" type="fixed"><parent link="c"/><child link="b"/></joint></robot>'
    assert [r["reason"] for r in judged(spark, None, "", "text", "<robot/>", circle, '<robot><link name="a"/></robot>').orderBy("id").collect()] == ["xml", "xml", "xml", "link_names", "unreached", None]


# --- archives


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("archives")
    rng = np.random.default_rng(1)
    made = {}
    for episode in (3, 4, 5):
        masks = rng.random((4, 6, 20, 70)) < 0.2
        masks[:, 2] = False
        codes = archives.present(masks).astype(np.uint8)
        codes[0, 4] = 2
        path = base / "run" / f"episode_{episode:06d}.npz"
        path.parent.mkdir(exist_ok=True)
        archives.write_archive(path, masks, codes if episode != 5 else None, ["valid"] * 4, ["passed"] * 4, archives.V3 if episode != 5 else archives.V2)
        made[episode] = masks, codes
    (base / "run" / "episode_000009.npz").write_bytes(b"PK\x03\x04 not an archive")
    np.save(open(base / "run" / "episode_000010.npz", "wb"), np.zeros(3))
    return str(base), made


def test_scan_reads_what_was_written(spark, folder):
    path, made = folder
    rows = archives.scan(spark, path).collect()
    good = [r for r in rows if r["reason"] is None]
    assert {(r["episode"], r["reason"]) for r in rows if r["reason"]} == {(9, "unreadable"), (10, "unreadable")} and len(good) == 3 * 4 * 6
    for r in good:
        masks, codes = made[r["episode"]]
        bits = np.unpackbits(np.array(r["mask"], np.int64).view(np.uint8), bitorder="little").reshape(20, 128)[:, :70].astype(bool)
        assert (bits == masks[r["channel"], r["frame"]]).all() and (r["height"], r["width"], r["frames"]) == (20, 70, 6)
        expected = codes if r["episode"] != 5 else archives.present(masks).astype(int)
        assert r["code"] == expected[r["channel"], r["frame"]] and r["version"] == (3 if r["episode"] != 5 else 2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    again = archives.decoded(files, columns=("episode", "channel", "frame", "mask", "reason"))
    assert sorted((r["episode"], r["channel"] or 0, r["frame"] or 0, r["mask"] or []) for r in again.collect()) == sorted((r["episode"], r["channel"] or 0, r["frame"] or 0, r["mask"] or []) for r in rows)


def test_filters_and_columns_reach_the_reader(spark, folder):
    path, made = folder
    found = archives.scan(spark, path, columns=("episode", "channel", "frame", "code"), partitionbytes=1)
    assert found.rdd.getNumPartitions() == 5  # a file each
    some = found.where("episode > 3 and episode < 9 and channel = 1 and frame in (0, 2)")
    assert some.rdd.getNumPartitions() == 2
    assert sorted(tuple(r) for r in some.collect()) == sorted((e, 1, t, int(archives.present(made[e][0])[1, t])) for e in (4, 5) for t in (0, 2))
    plan = some._jdf.queryExecution().toString()
    assert "code" in plan and "mask:" not in plan.split("== Physical Plan ==")[1]


def test_an_empty_folder(spark, tmp_path):
    assert archives.scan(spark, str(tmp_path)).count() == 0


def parts(**changes):
    masks = np.zeros((4, 3, 2, 2), bool)
    masks[0, 1] = True
    found = {
        "format_version": np.array(archives.V3), "frame_count": np.array(3), "masks": masks, "instance_names": np.array(archives.CHANNELS), "roles": np.array(archives.ROLES),
        "annotation_status": np.array(["valid", "not_applicable", "failed", "failed"]), "qc_status": np.array(["passed", "not_applicable", "failed", "failed"]), "frame_encoding": archives.present(masks).astype(np.uint8),
    }
    return {k: v for k, v in (found | changes).items() if v is not None}


ODD = np.zeros((4, 3), np.uint8)
HELD = archives.present(parts()["masks"]).astype(np.uint8) * 2


@pytest.mark.parametrize(
    ("changes", "canonical", "rendering", "channels", "publication"),
    [
        ({}, None, None, None, None), ({"extra": np.array(1)}, "keys", None, None, "keys"), ({"qc_status": None}, "keys", None, None, "keys"), ({"roles": None}, "keys", "keys", "keys", "keys"),
        ({"format_version": np.array("v9")}, "version", "version", None, "version"), ({"frame_encoding": None}, "keys", "keys", "keys", "keys"), ({"format_version": np.array(archives.V2), "frame_encoding": None}, None, None, None, None),
        ({"frame_count": np.array(2)}, "frames", "frames", "frames", "frames"), ({"frame_count": np.array("3")}, "frame_count", "frame_count", "frame_count", "frame_count"), ({"masks": parts()["masks"].astype(np.uint8)}, "masks", None, None, "masks"),
        ({"instance_names": np.array(archives.CHANNELS[::-1])}, "names", None, "names", "names"), ({"roles": np.array(["a"] * 4)}, "roles", None, "roles", "roles"), ({"qc_status": np.array(["passed"])}, "lengths", "lengths", "lengths", "lengths"),
        ({"frame_encoding": ODD}, "encoding.presence", "encoding.presence", "encoding.presence", "encoding.presence"), ({"frame_encoding": ODD.astype(int)}, "encoding.shape", "encoding.shape", "encoding.shape", "encoding.shape"),
        ({"frame_encoding": ODD + 7}, "encoding.code", "encoding.code", "encoding.code", "encoding.code"), ({"frame_encoding": HELD}, None, None, None, None), ({"annotation_status": np.array(["failed"] + ["not_applicable"] * 3)}, None, None, None, "role.target"),
        ({"annotation_status": np.array(["valid"] * 4)}, None, None, None, "role.receiver"), ({"masks": parts()["masks"][:, :, 0]}, "masks", "masks", "masks", "masks"), ({"roles": np.arange(4)}, "strings", "strings", "strings", "strings"),
    ],
)
def test_how_strictly_archives_are_read(changes, canonical, rendering, channels, publication):
    got = [archives.archive(parts(**changes), mode, required=("target",))[0] for mode in archives.MODES]
    assert got == [canonical, rendering, channels, publication]


def test_writing_archives_from_rows(spark, tmp_path):
    rows = [(1, 0, 0, 1, [3, 0]), (1, 1, 2, 1, [0, 1]), (2, 0, 0, 1, [0, 0])]
    frames = spark.createDataFrame(rows, "episode int, channel int, frame int, code int, mask array<bigint>")
    done = {r["episode"]: (r["frames"], r["reason"]) for r in archives.write_archives(frames, str(tmp_path / "a"), 2, 10).collect()}
    assert done == {1: (3, None), 2: (1, "encoding.presence")}  # a code without pixels isn't written
    seen = archives.scan(spark, str(tmp_path)).where("mask[0] <> 0 or mask[1] <> 0").select("episode", "channel", "frame", "code", "mask")
    assert sorted(tuple(r) for r in seen.collect()) == [(1, 0, 0, 1, [3, 0]), (1, 1, 2, 1, [0, 1])]
