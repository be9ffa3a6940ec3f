"""Grouped NumPy kernels for what Spark has no primitive for: hulls and greedy suppression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.adapters import MASK_WIDTH


def unpacked(mask: int, width: int = MASK_WIDTH) -> np.ndarray:
    """A packed mask as rows of booleans."""
    bits = np.unpackbits(np.array([mask], np.int64).view(np.uint8), bitorder="little")
    return bits.reshape(-1, width).astype(bool)


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the leftmost lowest point."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(order: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for q in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(chain(p) + chain(p[::-1]))


def suppress_duplicates(candidates: DataFrame, group: str | tuple[str, ...], threshold: float = 0.98) -> DataFrame:
    """candidates (group's columns, id, mask, valid) with duplicate_of: the first kept one with an IoU of ``threshold`` or more.

    Only candidates that are valid and kept themselves suppress later ones, by id.
    """
    fields = T.StructType([*candidates.schema.fields, T.StructField("duplicate_of", candidates.schema["id"].dataType)])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, kept, of = frame.sort_values("id"), [], []
        for key, mask, valid in frame[["id", "mask", "valid"]].itertuples(index=False):
            m, found = int(mask) & (2**64 - 1), None
            for other, o in kept:
                union = (m | o).bit_count()
                if union and (m & o).bit_count() / union >= threshold:
                    found = other
                    break
            if valid and found is None:
                kept.append((key, m))
            of.append(found if valid else None)
        return frame.assign(duplicate_of=pd.array(of, "Int64"))

    return candidates.groupBy(*([group] if isinstance(group, str) else group)).applyInPandas(run, fields)


def hull_area(frames: DataFrame) -> DataFrame:
    """episode, frame, corners and area of the convex hull of every mask's pixels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for mask in frame["mask"]:
                y, x = np.nonzero(unpacked(mask))
                h = convex_hull(np.stack([x, y], axis=1)) if len(x) else np.zeros((0, 2))
                a = abs(float(np.sum(h[:, 0] * np.roll(h[:, 1], -1) - h[:, 1] * np.roll(h[:, 0], -1)))) / 2 if len(h) > 2 else 0.0
                rows.append((len(h), a))
            yield frame[["episode", "frame"]].assign(corners=pd.array([r[0] for r in rows], "int32"), hull_area=[r[1] for r in rows])

    return frames.select("episode", "frame", "mask").mapInPandas(run, "episode int, frame int, corners int, hull_area double")


def chosen_quota(pool: DataFrame, per_domain: int) -> DataFrame:
    """How many left-arm episodes each of two domains gives, from counts (domain, arm, n): feasible and nearest to half.

    Ties go to balanced domains, then to the smaller first count. The pool is one row for each domain and arm.
    """
    counts = pool.groupBy("domain").agg(F.sum(F.when(F.col("arm") == "left", F.col("n")).otherwise(0)).alias("l"), F.sum(F.when(F.col("arm") == "right", F.col("n")).otherwise(0)).alias("r"))
    pair = counts.agg(F.array_sort(F.collect_list(F.struct("domain", "l", "r"))).alias("d")).select(F.get("d", 0).alias("a"), F.get("d", 1).alias("b"))
    n = F.lit(per_domain)
    options = pair.select("a", "b", F.explode(F.sequence(F.lit(0), n)).alias("x")).select("a", "b", "x", F.explode(F.sequence(F.lit(0), n)).alias("y"))
    fits = options.where("x <= a.l and y <= b.l").where((n - F.col("x") <= F.col("a.r")) & (n - F.col("y") <= F.col("b.r")))
    best = fits.orderBy(F.abs(F.col("x") + F.col("y") - n), F.abs(F.col("x") - F.col("y")), "x", "y").limit(1)
    return best.select(F.col("a.domain").alias("first_domain"), F.col("b.domain").alias("second_domain"), F.col("x").alias("first_left"), F.col("y").alias("second_left"))
