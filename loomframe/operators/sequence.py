"""Event detection over ordered signals.

Every step uses the same window (an episode's rows by frame), so that Spark needs one exchange and one sort for all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSED, STABLE = 0.9, 0.15, 3


def by_frame(*keys: str) -> Window:
    return Window.partitionBy(*(keys or ("episode",))).orderBy("frame")


def median3(value: str, window: Window) -> Column:
    """Median of a value and its neighbours, the ends repeated."""
    x = F.col(value)
    return F.element_at(F.sort_array(F.array(F.coalesce(F.lag(x).over(window), x), x, F.coalesce(F.lead(x).over(window), x))), 2)


def run_of(condition: Column, window: Window, length: int) -> Column:
    """Whether ``condition`` holds on this and the next ``length - 1`` frames."""
    ahead = window.rowsBetween(0, length - 1)
    return (F.min(condition.cast("int")).over(ahead) == 1) & (F.count(F.lit(1)).over(ahead) == length)


def first_run(frames: DataFrame, condition: Column, length: int = STABLE, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """First frame of the first stable run of every group (null if there is none)."""
    held = frames.withColumn("__run", run_of(condition, by_frame(*keys), length))
    return held.groupBy(*keys).agg(F.min(F.when(F.col("__run"), F.col("frame"))).alias("run_start"))


def motion_score(xyz: Column, rpy: Column, xyz_before: Column, rpy_before: Column, rotation: float = 0.05) -> Column:
    """Length of a step plus ``rotation`` times the length of the turn, its angles wrapped to half a turn."""

    def norm(d: Column) -> Column:
        return F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))

    turn = F.zip_with(rpy, rpy_before, lambda a, b: F.pmod(a - b + F.pi(), 2 * F.pi()) - F.pi())
    return norm(F.zip_with(xyz, xyz_before, lambda a, b: a - b)) + rotation * norm(turn)


def motion_start(scored: DataFrame, floor: float = 0.002, factor: float = 4.0, stable: int = STABLE, margin: float = 0.0) -> DataFrame:
    """First stable motion before closing: rows (episode, threshold, move_start) from (episode, frame, score, close_start).

    score is that of the step into a frame, null at frame 0. The threshold is the median of the first scores plus
    ``factor`` deviations, ``floor`` at least; motion at or after close_start counts as none. A score must be above it by more
    than ``margin``, so that one equal to it isn't told from it by rounding.
    """
    base = scored.where(F.col("score").isNotNull() & (F.col("frame") <= F.greatest(F.lit(1), F.least(F.col("close_start"), F.lit(3)))))
    middle = base.groupBy("episode").agg(F.percentile("score", F.lit(0.5)).alias("median"))
    spread = base.join(middle, "episode").groupBy("episode", "median").agg(F.percentile(F.abs(F.col("score") - F.col("median")), F.lit(0.5)).alias("mad"))
    limits = spread.select("episode", F.greatest(F.col("median") + factor * F.col("mad"), F.lit(floor)).alias("threshold"))
    moved = scored.join(limits, "episode").withColumn("run", run_of(F.coalesce(F.col("score") > F.col("threshold") + margin, F.lit(False)), by_frame(), stable))
    found = moved.groupBy("episode", "threshold", "close_start").agg(F.min(F.when(F.col("run") & (F.col("frame") >= 1), F.col("frame"))).alias("run_start"))
    return found.select("episode", "threshold", F.least(F.col("run_start"), F.col("close_start")).alias("move_start"))


def loop_events(frames: DataFrame, open_at: float = OPEN, closed_at: float = CLOSED, stable: int = STABLE) -> DataFrame:
    """The first close and reopen of every episode: close_start, close_done, open_start, open_done, outcome."""
    w, whole = by_frame(), Window.partitionBy("episode")
    filtered = frames.withColumn("f", median3("grip", w)).withColumn("before", F.lag("f").over(w))
    flagged = filtered.select(
        "episode", "frame", "f", "before", run_of(F.col("f") <= closed_at, w, stable).alias("is_closed"), run_of(F.col("f") >= open_at, w, stable).alias("is_open")
    )

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col("frame"))).over(whole)

    staged = flagged.withColumn("close_start", first((F.col("f") < open_at) & (F.col("f") < F.col("before"))))
    staged = staged.withColumn("close_done", first(F.col("is_closed") & (F.col("frame") >= F.col("close_start"))) + (stable - 1))
    staged = staged.withColumn("open_start", first((F.col("f") > F.col("before")) & (F.col("frame") > F.col("close_done"))))
    staged = staged.withColumn("open_done", first(F.col("is_open") & (F.col("frame") >= F.col("open_start"))) + (stable - 1))
    outcome = (
        F.when(F.col("close_start").isNull(), "no_close").when(F.col("close_done").isNull(), "no_stable_close")
        .when(F.col("open_start").isNull(), "no_open").when(F.col("open_done").isNull(), "no_stable_open").otherwise("loop")
    )
    return staged.where("frame = 0").select("episode", "close_start", "close_done", "open_start", "open_done", outcome.alias("outcome"))


def target_only_events(frames: DataFrame, open_at: float = OPEN, closed_at: float = CLOSED, stable: int = STABLE) -> DataFrame:
    """Close and hold without reopening: close_start, close_end, accepted, by the first and last frames too."""
    w, back = by_frame(), Window.partitionBy("episode").orderBy(F.col("frame").desc())
    f = frames.withColumn("f", median3("grip", w)).withColumn("left", F.row_number().over(back)).withColumn("is_open", run_of(F.col("f") >= open_at, w, stable))
    ends = f.groupBy("episode").agg(
        F.bool_and(F.when(F.col("frame") < stable, F.col("f") >= open_at)).alias("starts_open"), F.bool_and(F.when(F.col("left") <= stable, F.col("f") <= closed_at)).alias("ends_closed"),
        F.max(F.when(F.col("is_open"), F.col("frame"))).alias("last_open"),
    )
    events = loop_events(frames, open_at, closed_at, stable).select("episode", "close_start", F.col("close_done").alias("close_end"))
    accepted = F.col("close_end").isNotNull() & F.col("starts_open") & F.col("ends_closed") & ~F.coalesce(F.col("last_open") > F.col("close_end"), F.lit(False))
    return events.join(ends, "episode").select("episode", "close_start", "close_end", accepted.alias("accepted"))


def repeated_loops(frames: DataFrame, open_at: float = OPEN, closed_at: float = CLOSED, stable: int = STABLE) -> DataFrame:
    """All complete loops: after each one detection starts anew, the median's ends repeated at the new start."""

    def first(flags: np.ndarray, start: int) -> int:
        at = np.flatnonzero(flags[start:])
        return int(at[0]) + start if len(at) else -1

    def held(flags: np.ndarray) -> np.ndarray:
        n = max(0, len(flags) - stable + 1)
        return np.logical_and.reduce([flags[i : i + n] for i in range(stable)]) if n else np.zeros(0, bool)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        grip = frame.sort_values("frame")["grip"].to_numpy(float)
        out, offset = [], 0
        while offset < len(grip) - 5 and len(grip) - offset >= 2 * stable:
            g = grip[offset:]
            f = np.median(np.stack([np.r_[g[0], g[:-1]], g, np.r_[g[1:], g[-1]]]), axis=0)
            step = np.r_[0.0, np.diff(f)]
            close = first((f < open_at) & (step < 0), 0)
            closed = first(held(f <= closed_at), close) if close >= 0 else -1
            opened = first(step > 0, closed + stable) if closed >= 0 else -1
            done = first(held(f >= open_at), opened) if opened >= 0 else -1
            if done < 0:
                break
            out.append((offset + close, offset + closed + stable - 1, offset + opened, offset + done + stable - 1))
            offset = out[-1][3] + 1
        rows = pd.DataFrame(out, columns=["close_start", "close_done", "open_start", "open_done"], dtype="int64")
        return rows.assign(episode=frame["episode"].iloc[0], loop=range(len(out)))

    return frames.groupBy("episode").applyInPandas(run, "close_start long, close_done long, open_start long, open_done long, episode long, loop long")


def phase(frame: Column, close_start: Column, close_done: Column, open_start: Column) -> Column:
    """Name of the phase that a frame lies in."""
    return F.when(frame < close_start, "approach").when(frame <= close_done, "close").when(frame < open_start, "transport").otherwise("release")


def windows(events: DataFrame) -> DataFrame:
    """Frame windows of a loop's events with move_start: target, receiver, hold (null if empty), loop."""

    def window(a: Column, b: Column) -> Column:
        return F.when(b >= a, F.struct(a.cast("int").alias("start"), b.cast("int").alias("end")))

    c = F.col
    return events.select(
        "episode", window(c("move_start"), c("open_done")).alias("loop"), window(c("move_start"), c("open_start") - 1).alias("target"),
        window(c("close_done"), c("open_done")).alias("receiver"), window(c("close_done") + 1, c("open_start") - 1).alias("hold"),
    )


def uniform_sample(start: Column, end: Column, n: int) -> Column:
    """Up to ``n`` distinct frames spread evenly from start to end, halves rounded to even."""
    spread = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(start + i * (end - start) / F.lit(float(n - 1))).cast("int")))
    return F.when(end < start, F.array().cast("array<int>")).when((end == start) | F.lit(n <= 1), F.array(start.cast("int"))).otherwise(spread)


def last_known(value: Column, window: Window) -> Column:
    """The last value before this row that isn't null."""
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


def semantic_frames(events: DataFrame, seeds: int = 4, margin: int = 4) -> DataFrame:
    """episode, frame, purpose, roles of what is shown of each episode; the first purpose of a frame counts.

    Seeds are spread before closing. A pick and place has two frames after the grasp and one of placing; a target that is
    only held (open_start null) two after the grasp. frames: the episode's number of frames.
    """
    c = F.col
    loop = c("open_start").isNotNull()
    last, both, target, receiver = c("frames") - 1, F.array(F.lit("target"), F.lit("receiver")), F.array(F.lit("target")), F.array(F.lit("receiver"))

    def shown(frame: Column, rank: int, purpose: str, roles: Column) -> Column:
        inside = F.least(F.greatest(frame, F.lit(0)), last).cast("int")
        return F.struct(inside.alias("frame"), F.lit(rank).alias("rank"), F.lit(purpose).alias("purpose"), roles.alias("roles"))

    spread = uniform_sample(F.lit(0), F.greatest(F.lit(0), c("close_start") - margin), seeds)
    seed = F.transform(spread, lambda f: shown(f, 0, "pre_grasp_seed_candidate", F.when(loop, both).otherwise(target)))
    done = c("close_done")
    held = F.least(done + 1, last)
    context = F.when(loop, F.array(
        shown(F.least(done + 1, c("open_start") - 1), 1, "post_grasp_context", target), shown(F.floor((done + c("open_start")) / 2), 2, "post_grasp_context", target),
        shown(F.least(c("open_start") + 1, c("open_done")), 3, "place_context", receiver),
    )).otherwise(F.array(shown(held, 1, "post_grasp_context", target), shown(F.floor((held + last) / 2), 2, "post_grasp_context", target)))
    rows = events.select("episode", F.inline(F.concat(seed, context)))
    first = rows.groupBy("episode", "frame").agg(F.min_by(F.struct("purpose", "roles"), "rank").alias("x"))
    return first.select("episode", "frame", "x.*")


def seed_candidates(shown: DataFrame, role: str) -> DataFrame:
    """Frames of ``semantic_frames`` from which a role may be seeded."""
    return shown.where((F.col("purpose") == "pre_grasp_seed_candidate") & F.array_contains("roles", role)).select("episode", "frame")


def keyframes(events: DataFrame, first_seen: str = "first_seen") -> DataFrame:
    """episode, frames: seven frames of review from the first one in view (null: close_start), each once in that order."""
    c = F.col
    seen = F.coalesce(first_seen, "close_start")
    values = (seen, F.greatest(seen, c("close_start") - 1), c("close_done"), F.floor((c("close_done") + c("open_start")) / 2), F.greatest(c("close_done") + 1, c("open_start") - 1), c("open_start"), c("open_done"))
    return events.select("episode", F.array_distinct(F.array(*(v.cast("long") for v in values))).alias("frames"))
