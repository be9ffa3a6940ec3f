"""Measures of packed masks: a bigint holds 64 pixels, bit i being pixel i in row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.adapters import MASK_WIDTH
from .sequence import by_frame


def area(mask: Column) -> Column:
    return F.bit_count(mask)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 1 for two empty masks."""
    union = F.bit_count(a.bitwiseOR(b))
    return F.when(union == 0, 1.0).otherwise(F.bit_count(a.bitwiseAND(b)) / union)


def _bits(mask: Column, weight) -> Column:
    bit = lambda i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(F.lit(1).cast("bigint"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda s, i: s + bit(i) * weight(i))


def centroid(mask: Column, width: int = MASK_WIDTH) -> tuple[Column, Column]:
    """Mean x and y of a mask's pixels; nulls if it is empty."""
    size = F.bit_count(mask)
    return F.try_divide(_bits(mask, lambda i: i % width), size), F.try_divide(_bits(mask, lambda i: F.floor(i / width)), size)


def box(mask: Column, width: int = MASK_WIDTH) -> Column:
    """Smallest box around a mask: struct of x0, y0, x1, y1 (inclusive), null if it is empty."""
    on = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    xs, ys = F.transform(on, lambda i: i % width), F.transform(on, lambda i: F.floor(i / width).cast("int"))
    return F.when(F.size(on) > 0, F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")))


def with_neighbours(frames: DataFrame) -> DataFrame:
    """area, presence, IoU with the frame before, centroid jump and area ratio jump (nulls where a frame is empty)."""
    w = by_frame()
    cx, cy = centroid(F.col("mask"))
    known = frames.select("*", area(F.col("mask")).alias("area"), cx.alias("cx"), cy.alias("cy"))
    before = {c: F.lag(c).over(w) for c in ("mask", "area", "cx", "cy")}
    both = (F.col("area") > 0) & (before["area"] > 0)
    return known.select(
        *known.columns, (F.col("area") > 0).alias("present"), F.lag(F.col("area") > 0).over(w).alias("was_present"), F.when(both, iou(F.col("mask"), before["mask"])).alias("iou"),
        F.when(both, F.hypot(F.col("cx") - before["cx"], F.col("cy") - before["cy"])).alias("jump"), F.when(both, F.abs(F.col("area") - before["area"]) / before["area"]).alias("ratio"),
    )


def temporal_qc(frames: DataFrame, min_iou: float = 0.5, max_jump: float = 5.0, max_ratio: float = 0.4, severe: int = 2) -> DataFrame:
    """Continuity of every episode's masks, and pass, review or quarantine."""
    seen = Window.partitionBy("episode")
    rows = with_neighbours(frames).withColumns({"first": F.min(F.when(F.col("present"), F.col("frame"))).over(seen), "last": F.max(F.when(F.col("present"), F.col("frame"))).over(seen)})
    p = lambda c, q: F.percentile(c, F.lit(q))
    metrics = rows.groupBy("episode").agg(
        F.count("*").alias("window_frames"), F.count_if("present").alias("nonempty_frames"), F.avg(F.col("present").cast("int")).alias("coverage"),
        F.count_if(F.col("present") != F.col("was_present")).alias("presence_transitions"), F.count_if(~F.col("present") & F.col("frame").between(F.col("first"), F.col("last"))).alias("internal_missing_frames"),
        F.avg("iou").alias("iou_mean"), p("iou", 0.05).alias("iou_p05"), p("jump", 0.95).alias("jump_p95"), p("ratio", 0.95).alias("ratio_p95"),
    )
    flags = {"low_iou": F.col("iou_p05") < min_iou, "jump": F.col("jump_p95") > max_jump, "ratio": F.col("ratio_p95") > max_ratio}
    strong = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags.values()), F.lit(0))
    issues = (strong > 0) | (F.col("nonempty_frames") < F.col("window_frames")) | (F.col("internal_missing_frames") > 0)
    numbers = ("coverage", "iou_mean", "iou_p05", "jump_p95", "ratio_p95")
    return metrics.withColumn("status", F.when(strong >= severe, "quarantine").when(issues, "review").otherwise("pass")).withColumns({c: F.round(c, 6) for c in numbers})


def crop(mask: Column, frame: Column, start: Column, end: Column) -> Column:
    """The mask inside a window of frames, empty outside."""
    return F.when(frame.between(start, end), mask).otherwise(F.lit(0).cast("bigint"))


def encoding(mask: Column, channel: Column, frame: Column, hold_start: Column, hold_end: Column) -> Column:
    """0 for an empty mask, 2 for the target (channel 0) in its hold, else 1."""
    in_hold = F.coalesce((channel == 0) & frame.between(hold_start, hold_end), F.lit(False))
    return F.when(F.bit_count(mask) == 0, 0).when(in_hold, 2).otherwise(1).cast("tinyint")


def encoding_violations(frames: DataFrame) -> DataFrame:
    """Rows (channel, code, mask) whose code contradicts the mask."""
    present = F.bit_count("mask") > 0
    return frames.where(~F.col("code").isin(0, 1, 2) | ((F.col("code") != 0) != present) | ((F.col("code") == 2) & (F.col("channel") > 0)))


def exclusion(raw: Column, roi: Column, target: Column, receiver: Column) -> dict[str, Column]:
    """Parts of a raw mask inside its region: what target and receiver take, and what is left."""
    cropped = raw.bitwiseAND(roi)
    by_target = cropped.bitwiseAND(target)
    by_receiver = cropped.bitwiseAND(receiver).bitwiseAND(F.bitwise_not(target))
    return {"target_removed": by_target, "receiver_removed": by_receiver, "gripper": cropped.bitwiseAND(F.bitwise_not(by_target.bitwiseOR(by_receiver)))}
