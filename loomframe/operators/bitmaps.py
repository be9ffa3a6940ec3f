"""Measures of masks of any size: arrays of 64-bit words, whole words to a row, bit i of a word being its i-th pixel.

A frame of 240 by 320 pixels has 1,200 words, five to a row; rows of other widths end with empty bits. Sums of places need
no loop over pixels: the bits whose number has a given binary digit are counted at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import by_frame

c = F.col
#: For each binary digit of a bit's number, the bits that have it: 64-bit words as signed numbers.
_DIGITS = [int.from_bytes(sum(1 << i for i in range(64) if i >> j & 1).to_bytes(8, "little"), "little", signed=True) for j in range(6)]
SIGNALS = ("low_adjacent_iou_p05", "large_centroid_jump_p95", "large_area_ratio_jump_p95")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def area(mask: Column) -> Column:
    return _sum(F.transform(mask, lambda w: F.bit_count(w).cast("bigint")))


def both(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))


def either(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))


def without(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseAND(F.bitwise_not(y)))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 1 for two empty masks."""
    union = area(either(a, b))
    return F.when(union == 0, 1.0).otherwise(area(both(a, b)) / union)


def centroid(mask: Column, words: int) -> tuple[Column, Column]:
    """Mean x and y of a mask with so many words to a row; nulls if it is empty."""
    inner = lambda w: sum((F.bit_count(w.bitwiseAND(F.lit(d).cast("bigint"))).cast("bigint") * (1 << j) for j, d in enumerate(_DIGITS)), F.lit(0).cast("bigint"))
    xs = _sum(F.transform(mask, lambda w, i: inner(w) + F.bit_count(w).cast("bigint") * (i % words * 64)))
    ys = _sum(F.transform(mask, lambda w, i: F.bit_count(w).cast("bigint") * F.floor(i / words)))
    size = area(mask)
    return F.try_divide(xs, size), F.try_divide(ys, size)


def box(mask: Column, words: int) -> Column:
    """Smallest box around a mask, ends included: struct of x0, y0, x1, y1, null if it is empty."""
    on = F.filter(F.transform(mask, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: s["w"] != 0)
    rows = F.transform(on, lambda s: F.floor(s["i"] / words).cast("int"))
    low = high = on
    for step in (1, 2, 4, 8, 16, 32):  # all bits from the lowest one up, and from the highest one down
        spread = lambda kind, step: lambda s: F.struct(s["w"].bitwiseOR(F.call_function(kind, s["w"], F.lit(step))).alias("w"), s["i"].alias("i"))
        low, high = F.transform(low, spread("shiftleft", step)), F.transform(high, spread("shiftrightunsigned", step))
    x0 = F.array_min(F.transform(low, lambda s: (s["i"] % words * 64 + 64 - F.bit_count(s["w"])).cast("int")))
    x1 = F.array_max(F.transform(high, lambda s: (s["i"] % words * 64 + F.bit_count(s["w"]) - 1).cast("int")))
    return F.when(F.size(on) > 0, F.struct(x0.alias("x0"), F.array_min(rows).alias("y0"), x1.alias("x1"), F.array_max(rows).alias("y1")))


def _moved(mask: Column, words: int, by: int, upright: bool) -> Column:
    """A mask together with its copy moved by ``by`` pixels, right or down (left or up if negative).

    To the side ``by`` is under 64, and bits are carried over to the next word of a row.
    """
    zero, n = F.lit(0).cast("bigint"), abs(by)
    if upright:
        return F.transform(mask, lambda w, i: w.bitwiseOR(F.coalesce(F.get(mask, i - by * words), zero)))
    away, back = ("shiftleft", "shiftrightunsigned") if by > 0 else ("shiftrightunsigned", "shiftleft")
    before = lambda i: F.when(i % words > 0, F.get(mask, i - 1)).otherwise(zero) if by > 0 else F.when(i % words < words - 1, F.get(mask, i + 1)).otherwise(zero)
    return F.transform(mask, lambda w, i: w.bitwiseOR(F.call_function(away, w, F.lit(n))).bitwiseOR(F.call_function(back, before(i), F.lit(64 - n))))


def spread(frames: DataFrame, mask: str, words: int, radius: int, into: str) -> DataFrame:
    """``frames`` with column ``into``: a mask of whole words to a row grown by a square, words at once.

    A mask grows to each side by itself, so that nothing leaves the frame on its way; what reaches k pixels is moved by up
    to k + 1 more, so that the number of steps is that of the radius's digits.
    """
    found = frames.withColumn(into, c(mask))
    for upright in (False, True):
        sides = []
        for sign in (1, -1):
            side, reach = f"__{into}{sign}", 0
            sides.append(side)
            found = found.withColumn(side, c(into))
            while reach < radius:
                by = min(radius - reach, reach + 1, 63)
                found = found.withColumn(side, _moved(c(side), words, sign * by, upright))
                reach += by
        found = found.withColumn(into, either(*map(c, sides))).drop(*sides)
    return found


def outlines(frames: DataFrame, words: int, outline: int, halo: int) -> DataFrame:
    """``frames`` with outline and halo, bands around every mask and outside of it: up to ``outline`` pixels, and from there up to ``halo``."""
    if not 0 <= outline <= halo:
        raise ValueError("a halo is at least as wide as the outline, which isn't negative")
    both_sizes = spread(spread(frames, "mask", words, outline, "outline"), "mask", words, halo, "halo")
    return both_sizes.withColumns({"halo": without(c("halo"), c("outline")), "outline": without(c("outline"), c("mask"))})


def measured(frames: DataFrame, words: int) -> DataFrame:
    """area, cx, cy, and iou, jump and ratio against the frame before (nulls where one of both is empty)."""
    w = by_frame()
    cx, cy = centroid(c("mask"), words)
    known = frames.select("*", area(c("mask")).alias("area"), cx.alias("cx"), cy.alias("cy"))
    before = {n: F.lag(n).over(w) for n in ("mask", "area", "cx", "cy")}
    pair = (c("area") > 0) & (before["area"] > 0)
    return known.select(
        *known.columns, (c("area") > 0).alias("present"), F.lag(c("area") > 0).over(w).alias("was_present"), F.when(pair, iou(c("mask"), before["mask"])).alias("iou"),
        F.when(pair, F.hypot(c("cx") - before["cx"], c("cy") - before["cy"])).alias("jump"), F.when(pair, F.abs(c("area") - before["area"]) / before["area"]).alias("ratio"),
    )


def temporal_qc(frames: DataFrame, words: int, min_iou: float = 0.5, max_jump: float = 5.0, max_ratio: float = 0.4, severe: int = 2) -> DataFrame:
    """Continuity of every episode's masks within its output window, its issues, and pass, review or quarantine.

    frames: episode, frame, mask, start, end (of the window), reference (a mask, or null). The distance to the reference is
    the largest of any centroid in the window; without a reference, or if it is empty, it is null.
    """
    inside = frames.where(c("frame").between(c("start"), c("end")))
    rx, ry = centroid(c("reference"), words)
    seen = Window.partitionBy("episode")
    rows = measured(inside, words).withColumns({
        "first": F.min(F.when(c("present"), c("frame"))).over(seen), "last": F.max(F.when(c("present"), c("frame"))).over(seen), "far": F.hypot(c("cx") - rx, c("cy") - ry),
    })
    p = lambda n, q: F.percentile(n, F.lit(q))
    found = rows.groupBy("episode").agg(
        F.count("*").alias("window_frames"), F.count_if("present").alias("nonempty_frames"), F.avg(c("present").cast("int")).alias("coverage"),
        F.count_if(c("present") != c("was_present")).alias("presence_transitions"), F.count_if(~c("present") & c("frame").between(c("first"), c("last"))).alias("internal_missing_frames"),
        F.avg("iou").alias("iou_mean"), p("iou", 0.05).alias("iou_p05"), p("jump", 0.95).alias("jump_p95"), p("ratio", 0.95).alias("ratio_p95"), F.max("far").alias("max_reference_distance"),
    )
    strong = [F.when(rule, name) for rule, name in zip((c("iou_p05") < min_iou, c("jump_p95") > max_jump, c("ratio_p95") > max_ratio), SIGNALS, strict=True)]
    weak = [F.when(c("nonempty_frames") < c("window_frames"), "incomplete_window_coverage"), F.when(c("internal_missing_frames") > 0, "internal_missing_frames")]
    issues, signals = F.array_compact(F.array(*strong, *weak)), F.size(F.array_compact(F.array(*strong)))
    status = F.when(signals >= severe, "quarantine").when(F.size(issues) > 0, "review").otherwise("pass")
    return found.select("*", F.array_join(issues, ",").alias("issues"), status.alias("status"))
