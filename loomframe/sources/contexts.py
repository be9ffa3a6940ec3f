"""Recorded timelines in JSON, of three versions, decoded into one shape with what is wrong with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import timeline

c = F.col
#: What a version's name ends with; what stands before it is a project's own.
VERSION = r"^(?:\w+_)?loop_context_v([123])$"
#: Keys and modes in recordings: fixed values.
PICK_PLACE, TARGET_ONLY = "pick_place", "target_only"
ROLES = {PICK_PLACE: ("target", "receiver"), TARGET_ONLY: ("target",)}
KINDS = {PICK_PLACE: "pick_place", TARGET_ONLY: "close_hold"}
EVENTS = {PICK_PLACE: ("t_move_start", "t_close_start", "t_close_done", "t_open_start", "t_open_done"), TARGET_ONLY: ("t_remove_start", "t_close_start", "t_close_end")}
WINDOWS = ("gripper", "operation", "receiver_0", "target_0")


def _at(path: str) -> Column:
    return F.try_variant_get("__v", f"$.{path}", "variant")


def _kind(path: str) -> Column:
    """Type of what is there: BIGINT, STRING, OBJECT<...>, VOID for null; null where there is nothing."""
    return F.schema_of_variant(_at(path))


def _text(path: str) -> Column:
    return F.when(_kind(path) == "STRING", F.try_variant_get("__v", f"$.{path}", "string"))


def _whole(path: str) -> Column:
    """A number without fraction or exponent; null for anything else, true and false included."""
    return F.when(_kind(path) == "BIGINT", F.try_variant_get("__v", f"$.{path}", "bigint"))


def _pair(name: str) -> Column:
    return F.when(_kind(f"windows.{name}") == "ARRAY<BIGINT>", F.try_variant_get("__v", f"$.windows.{name}", "array<bigint>"))


def _keys(path: str | None = None) -> Column:
    """Sorted keys of an object; null if there is something else or nothing."""
    return F.array_sort(F.map_keys(F.try_variant_get("__v", f"$.{path}" if path else "$", "map<string,variant>")))


def _listed(*names: str) -> Column:
    return F.array(*map(F.lit, sorted(names)))


def _present(path: str) -> Column:
    """Whether there is something other than null."""
    return F.coalesce(_kind(path) != "VOID", F.lit(False))


def decoded(recordings: DataFrame) -> DataFrame:
    """``recordings`` (value: JSON; task, episode, camera: what it should be of) decoded, with the first thing that is wrong as ``reason``.

    Adds version (1 to 3), mode, active_arm, frames, move_start, close_start, close_done, open_start, open_done, the windows
    operation, target_0, receiver_0, gripper and hold (structs of start and end), and reason: json, object, format_version,
    episode, episode.task (episode_index, episode_id, camera), frame_count, annotation_mode, required_object_roles, events,
    active_arm, windows, version (a mode that version 1 doesn't have), timeline_kind, events.keys, events.numbers,
    events.order, events.end, windows.keys, or windows and the name of the one that differs. Where there is a reason all
    else is null. Version 1 calls the operation's window loop and may leave out the gripper's; only later versions state roles and
    kind, and only version 3 keeps the target through its hold. A null value or a repeated key is ``json``.
    """
    given = recordings.columns
    v = recordings.withColumn("__v", text.whole_json(c("value")))
    steps = {
        "version": F.regexp_extract(_text("format_version"), VERSION, 1).try_cast("int"),
        "mode": F.when(_kind("annotation_mode").isNull(), F.lit(PICK_PLACE)).otherwise(_text("annotation_mode")),
        "active_arm": _text("events.active_arm"),
        "frames": _whole("frame_count"),
        "__keys": F.struct(*(_keys(p).alias(p) for p in ("episode", "events", "windows"))),
        "__kind": _text("timeline_kind"),
        "__roles": F.when(_kind("required_object_roles") == "ARRAY<STRING>", F.try_variant_get("__v", "$.required_object_roles", "array<string>")),
        "__no_roles": ~_present("required_object_roles"),
        "__id": F.struct(_text("episode.task").alias("task"), _whole("episode.episode_index").alias("episode_index"), _text("episode.episode_id").alias("episode_id"), _text("episode.camera").alias("camera")),
        "__e": F.struct(*(_whole(f"events.{n}").alias(n) for n in dict.fromkeys(EVENTS[PICK_PLACE] + EVENTS[TARGET_ONLY]))),
        "__w": F.struct(*(_pair(n).alias(n) for n in ("loop", *WINDOWS))),
        "__has": F.struct(*(_present(f"windows.{n}").alias(n) for n in ("receiver_0", "gripper"))),
        "__no_json": c("__v").isNull(),
        "__object": _keys().isNotNull(),
    }
    read = v.select("*", *(e.alias(n) for n, e in steps.items())).drop("__v")
    loop, first = c("mode") == PICK_PLACE, c("version") == 1
    e = {
        "move_start": F.when(loop, c("__e.t_move_start")).otherwise(c("__e.t_remove_start")), "close_start": c("__e.t_close_start"), "close_done": F.when(loop, c("__e.t_close_done")).otherwise(c("__e.t_close_end")),
        "open_start": F.when(loop, c("__e.t_open_start")), "open_done": F.when(loop, c("__e.t_open_done")),
    }
    timed = timeline.hold_window(timeline.recorded_windows(read.withColumns(e), c("version") == 3))

    order = F.when(loop, timeline.order_reason(*(c(n) for n in e))).otherwise(timeline.order_reason(*(c(n) for n in tuple(e)[:3])))
    keys, by_mode = c("__keys"), lambda d: F.when(loop, d[PICK_PLACE]).otherwise(d[TARGET_ONLY])
    identity = {"task": c("task"), "episode_index": c("episode"), "episode_id": F.lpad(c("episode").cast("string"), 6, "0"), "camera": c("camera")}
    differs = lambda name, window: ~F.when(c(window).isNotNull(), F.array(c(window)["start"], c(window)["end"])).eqNullSafe(c("__w")[name])
    exact = [
        F.when(keys["windows"] != _listed(*WINDOWS), "windows.keys"), F.when(differs("operation", "operation"), "windows.operation"), F.when(differs("target_0", "target_0"), "windows.target_0"),
        F.when(F.when(loop, differs("receiver_0", "receiver_0")).otherwise(c("__has.receiver_0")), "windows.receiver_0"), F.when(differs("gripper", "gripper"), "windows.gripper"),
    ]
    early = [
        F.when(differs("loop", "operation"), "windows.loop"), F.when(differs("target_0", "target_0"), "windows.target_0"), F.when(differs("receiver_0", "receiver_0"), "windows.receiver_0"),
        F.when(c("__has.gripper") & differs("gripper", "gripper"), "windows.gripper"),
    ]
    last = F.when(first, c("open_done")).when(~loop, c("close_done"))
    reason = F.coalesce(
        F.when(c("__no_json"), "json"), F.when(~c("__object"), "object"), F.when(F.coalesce(c("version"), F.lit(0)) == 0, "format_version"), F.when(keys["episode"].isNull(), "episode"),
        *(F.when(~c("__id")[n].eqNullSafe(x), f"episode.{n}") for n, x in identity.items()),
        F.when(F.coalesce(c("frames"), F.lit(0)) < 1, "frame_count"), F.when(~F.coalesce(c("mode").isin(PICK_PLACE, TARGET_ONLY), F.lit(False)), "annotation_mode"),
        F.when(F.when(c("__no_roles"), ~first).otherwise(~c("__roles").eqNullSafe(by_mode({m: F.array(*map(F.lit, r)) for m, r in ROLES.items()}))), "required_object_roles"),
        F.when(keys["events"].isNull(), "events"), F.when(~F.coalesce(c("active_arm").isin("left", "right"), F.lit(False)), "active_arm"), F.when(keys["windows"].isNull(), "windows"),
        F.when(first & ~loop, "version"), F.when(~first & ~c("__kind").eqNullSafe(by_mode({m: F.lit(k) for m, k in KINDS.items()})), "timeline_kind"),
        F.when(keys["events"] != by_mode({m: _listed("active_arm", *n) for m, n in EVENTS.items()}), "events.keys"), F.when(order == "missing", "events.numbers"), F.when(order.isNotNull(), "events.order"),
        F.when(last >= c("frames"), "events.end"), F.when(first, F.coalesce(*early)).otherwise(F.coalesce(*exact)),
    )
    told = ("version", "mode", "active_arm", "frames", *e, "operation", "target_0", "receiver_0", "gripper", "hold")
    judged = timed.withColumn("reason", reason)
    return judged.select(*given, *(F.when(c("reason").isNull(), c(n)).alias(n) for n in told), "reason")
