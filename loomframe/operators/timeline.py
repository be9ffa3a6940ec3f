"""Full timelines of one arm: motion from its pose, both kinds of events, their windows and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import CLOSED, OPEN, STABLE, by_frame, loop_events, motion_score, motion_start, target_only_events

c = F.col
#: Scores of motion that differ by less are equal.
MARGIN = 1e-9


def _with_motion(frames: DataFrame, events: DataFrame, stable: int) -> DataFrame:
    """``events`` (with close_start) and the first stable motion of the pose (xyz, rpy) before it, close_start if none."""
    w = by_frame()
    scored = frames.withColumn("score", motion_score(c("xyz"), c("rpy"), F.lag("xyz").over(w), F.lag("rpy").over(w)))
    closing = events.where("close_start is not null").select("episode", "close_start")
    moved = motion_start(scored.join(closing, "episode").select("episode", "frame", "score", "close_start"), stable=stable, margin=MARGIN)
    return events.join(moved.select("episode", "move_start"), "episode", "left").withColumn("move_start", F.coalesce("move_start", "close_start"))


def pick_place(frames: DataFrame, open_at: float = OPEN, closed_at: float = CLOSED, stable: int = STABLE) -> DataFrame:
    """The five events of every episode's first loop from (episode, frame, grip, xyz, rpy), and the outcome."""
    return _with_motion(frames, loop_events(frames, open_at, closed_at, stable), stable)


def target_only(frames: DataFrame, open_at: float = OPEN, closed_at: float = CLOSED, stable: int = STABLE) -> DataFrame:
    """remove_start, close_start, close_end, frames and whether the episode closes once and holds, by (episode, frame, grip, xyz, rpy)."""
    events = target_only_events(frames, open_at, closed_at, stable).join(frames.groupBy("episode").agg(F.count("*").alias("frames")), "episode")
    return _with_motion(frames, events, stable).withColumnRenamed("move_start", "remove_start")


def order_reason(*events: Column, strict_from: int = 1) -> Column:
    """Why events aren't in order: missing, negative, unordered; null if they are. The first pair may coincide."""
    pairs = list(zip(events, events[1:], strict=False))
    broken = [(a > b) if i < strict_from else (a >= b) for i, (a, b) in enumerate(pairs)]
    missing = F.greatest(*(e.isNull() for e in events))
    return F.when(missing, "missing").when(F.least(*events) < 0, "negative").when(F.greatest(*broken), "unordered")


def _window(start: Column, end: Column) -> Column:
    return F.when(end >= start, F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))


def recorded_windows(events: DataFrame, held: Column) -> DataFrame:
    """operation, target_0, receiver_0, gripper of every episode, as a recording of its version has them.

    Later versions (``held``) keep the target through its hold, earlier ones up to the end of closing. An episode without
    open_start is one that only holds: it has no receiver, and its operation lasts to the last frame.
    """
    loop = c("open_start").isNotNull()
    last = c("frames") - 1
    operation = _window(c("move_start"), F.when(loop, c("open_done")).otherwise(last))
    target = _window(c("move_start"), F.when(held, F.when(loop, c("open_start") - 1).otherwise(last)).otherwise(c("close_done")))
    return events.select("*", operation.alias("operation"), target.alias("target_0"), F.when(loop, _window(c("close_done"), c("open_done"))).alias("receiver_0"), operation.alias("gripper"))


def hold_window(events: DataFrame) -> DataFrame:
    """The frames between closing and opening, or to the end; null where there are none."""
    return events.withColumn("hold", _window(c("close_done") + 1, F.when(c("open_start").isNotNull(), c("open_start") - 1).otherwise(c("frames") - 1)))


def window_differences(expected: DataFrame, recorded: Column) -> DataFrame:
    """``expected`` (of ``recorded_windows``) with the names of the windows that a recording (JSON) has otherwise.

    "keys" alone if it doesn't have exactly the four windows.
    """
    names = ("gripper", "operation", "receiver_0", "target_0")
    stored = F.from_json(recorded, "struct<operation:array<bigint>,target_0:array<bigint>,receiver_0:array<bigint>,gripper:array<bigint>>")
    same = lambda n: F.when(c(n).isNotNull(), F.array(c(n)["start"], c(n)["end"])).eqNullSafe(stored[n])
    odd = F.array_join(F.array_compact(F.array(*(F.when(~same(n), n) for n in names))), ",")
    keys = F.array_sort(F.json_object_keys(recorded)) != F.array(*map(F.lit, names))
    return expected.withColumn("differs", F.when(F.coalesce(keys, F.lit(True)), "keys").otherwise(odd))


def shapes(arms: DataFrame, key: str) -> DataFrame:
    """Shape and arm of each recording from its arms' (arm, loops, holds, close_start, close_done).

    pick_place if there is exactly one loop in all, close_hold if exactly one arm closes and holds, else other; the arm is
    that of the loop, of the hold, or the one that begins first to close until it is stable: both if two begin at once, none
    if there is none.
    """
    loops, holds = F.sum("loops"), F.count_if("holds")
    start = F.when(c("close_done").isNotNull(), c("close_start"))
    starts = F.array_compact(F.collect_list(F.when(start.isNotNull(), F.struct(start.alias("at"), "arm"))))  # one of each arm
    first = F.transform(F.filter(starts, lambda s: s["at"] == F.array_min(starts)["at"]), lambda s: s["arm"])
    arm = (
        F.when(loops == 1, F.min(F.when(c("loops") == 1, c("arm")))).when(holds == 1, F.min(F.when(c("holds"), c("arm"))))
        .when(F.size(starts) == 0, "none").when(F.size(first) > 1, "both").otherwise(F.get(first, 0))
    )
    return arms.groupBy(key).agg(F.when(loops == 1, "pick_place").when(holds == 1, "close_hold").otherwise("other").alias("shape"), arm.alias("arm"))
