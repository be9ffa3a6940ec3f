"""Shapes of masks of any size: components, filled polygons, distances and square growth, a batch of masks at a time.

Masks are arrays of 64-bit words whose bits are pixels in row order, ``width`` to a row. A batch is unpacked once into one
tall picture in which masks lie below each other, and each step works on all of it; slices bound the picture's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of masks that are unpacked at once (64 bytes each); a larger mask is a slice of its own.
SLICE = 1 << 17


def stacked(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks below each other as rows of booleans, and each mask's first row (and the end)."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little").astype(bool)
    return bits.reshape(-1, width), np.r_[0, np.cumsum(counts * 64 // width)]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as words."""
    return np.packbits(bits.ravel(), bitorder="little").view(np.int64)


def merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of the n things that each is joined with by the pairs (a, b): union-find, all pairs at once.

    Larger roots are hung below smaller ones, then everything is pointed to its root, until no pair has two.
    """
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


class Runs:
    """The runs of set pixels of stacked masks, in row order."""

    def __init__(self, bits: np.ndarray, first: np.ndarray) -> None:
        edge = np.diff(np.pad(bits, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        self.row, self.start = np.nonzero(edge == 1)
        self.end = np.nonzero(edge == -1)[1] - 1
        self.mask = np.searchsorted(first, self.row, "right") - 1
        self.top = self.row == first[self.mask]
        self.size = self.end - self.start + 1
        self._stride = bits.shape[1] + 2

    def components(self, eight: bool) -> np.ndarray:
        """For each run the first run of its component; runs of rows below each other join where they touch."""
        reach = int(eight)
        above = (self.row - 1) * self._stride
        low = np.searchsorted(self.row * self._stride + self.end, above + self.start - reach, "left")
        high = np.searchsorted(self.row * self._stride + self.start, above + self.end + reach, "right")
        n = np.where(self.top, 0, np.maximum(high - low, 0))
        below = np.repeat(np.arange(len(n)), n)
        touched = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return merged(len(n), touched, below)


def component_measures(words: np.ndarray, counts: np.ndarray, width: int) -> dict[str, object]:
    """components4, components8, largest_fraction (8-connected, None if empty) and the words of the largest 4-component, the first of equals."""
    bits, first = stacked(words, counts, width)
    runs, n = Runs(bits, first), len(counts)
    area = np.bincount(runs.mask, weights=runs.size, minlength=n)
    found: dict[str, object] = {}
    for eight in (False, True):
        root = runs.components(eight)
        size = np.bincount(root, weights=runs.size, minlength=len(root)).astype(np.int64)
        heads = np.flatnonzero(root == np.arange(len(root)))
        found[f"components{8 if eight else 4}"] = np.bincount(runs.mask[heads], minlength=n)
        most = np.zeros(n, np.int64)
        np.maximum.at(most, runs.mask[heads], size[heads])
        if eight:
            found["largest_fraction"] = [float(m / a) if a else None for m, a in zip(most, area, strict=True)]
        else:
            best = heads[size[heads] == most[runs.mask[heads]]]
            best = best[np.r_[True, runs.mask[best][1:] != runs.mask[best][:-1]]] if len(best) else best
            kept = np.isin(root, best)
            step = np.zeros((len(bits), width + 1), np.int8)
            step[runs.row[kept], runs.start[kept]] = 1
            step[runs.row[kept], runs.end[kept] + 1] = -1
            found["largest"] = np.split(packed(np.cumsum(step[:, :-1], axis=1, dtype=np.int8).astype(bool)), np.cumsum(counts)[:-1])
    return found


def squared_distances(bits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Squared distance of each set pixel to the nearest unset one of its mask; infinite in a full mask, beyond whose edges there is nothing.

    First along columns, then the lower envelope of the parabolas that stand on a row's columns, as far as any reaches.
    """
    rows, width = bits.shape
    at = np.arange(rows)[:, None]
    owner = np.searchsorted(first, np.arange(rows), "right") - 1
    begin, end = first[owner][:, None], first[owner + 1][:, None]
    above = np.maximum.accumulate(np.where(bits, -1, at), axis=0)
    below = np.minimum.accumulate(np.where(bits, rows, at)[::-1], axis=0)[::-1]
    gap = np.minimum(np.where(above < begin, np.inf, at - above), np.where(below >= end, np.inf, below - at))
    column = gap * gap
    best = column.copy()
    for dx in range(1, width):
        if dx * dx >= best.max(initial=0):
            break
        np.minimum(best[:, dx:], column[:, :-dx] + dx * dx, out=best[:, dx:])
        np.minimum(best[:, :-dx], column[:, dx:] + dx * dx, out=best[:, :-dx])
    return best


def interior_points(words: np.ndarray, counts: np.ndarray, width: int) -> dict[str, object]:
    """px, py (pixel) and depth of the pixel deepest inside each mask, the first of equals; None if it is empty."""
    bits, first = stacked(words, counts, width)
    far = squared_distances(bits, first)
    rows: list[tuple] = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if not bits[a:b].any():
            rows.append((None, None, None))
            continue
        y, x = divmod(int(np.argmax(far[a:b])), width)
        rows.append((x, y, float(np.sqrt(far[a + y, x]))))
    return dict(zip(("px", "py", "depth"), zip(*rows, strict=True), strict=True))


def nearest_pixels(words: np.ndarray, counts: np.ndarray, width: int, x: np.ndarray, y: np.ndarray) -> list[float | None]:
    """Distance of each mask's point (x, y) to its nearest set pixel; None for an empty mask or no point."""
    bits, first = stacked(words, counts, width)
    row, column = np.nonzero(bits)
    owner = np.searchsorted(first, row, "right") - 1
    square = (column - x[owner]) ** 2 + (row - first[owner] - y[owner]) ** 2
    best = np.full(len(counts), np.inf)
    np.minimum.at(best, owner, np.where(np.isnan(square), np.inf, square))
    return [float(np.sqrt(b)) if np.isfinite(b) else None for b in best]


def grown_by_sums(mask: np.ndarray, radius: int) -> np.ndarray:
    """A mask (rows of booleans) grown by a square, from sums over all rectangles that begin at the corner."""
    if radius <= 0:
        return mask.copy()
    sums = np.pad(np.pad(mask, radius).astype(np.int32), ((1, 0), (1, 0))).cumsum(axis=0).cumsum(axis=1)
    k = 2 * radius + 1
    return sums[k:, k:] - sums[:-k, k:] - sums[k:, :-k] + sums[:-k, :-k] > 0


def contour(mask: np.ndarray, radius: int = 2) -> np.ndarray:
    """The band between a mask grown by ``radius`` and the mask shrunk by one pixel; nothing beyond the frame shrinks it."""
    return grown_by_sums(mask, radius) & ~(mask & ~grown_by_sums(~mask, 1))


def convex_fill(points: np.ndarray, height: int, words: int) -> np.ndarray:
    """Words of the pixels in the convex polygon around whole-numbered points, edges included; empty for fewer than three corners.

    Each edge bounds the columns of every row from one side; what is between the tightest bounds is set word by word.
    """
    from .kernels import convex_hull

    corners = convex_hull(points)
    out = np.zeros((height, words), np.uint64)
    if len(corners) < 3:
        return out.view(np.int64).ravel()
    y = np.arange(height)
    low, high = np.zeros(height, np.int64), np.full(height, 64 * words - 1, np.int64)
    for (x1, y1), (x2, y2) in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        dx, dy = int(x2 - x1), int(y2 - y1)
        # inside is where dx * (y - y1) >= dy * (x - x1)
        side = dx * (y - int(y1)) + dy * int(x1)
        if dy > 0:
            high = np.minimum(high, side // dy)
        elif dy < 0:
            low = np.maximum(low, -(side // -dy))
        else:
            high = np.where(side >= 0, high, -1)
    first = np.arange(words) * 64
    a = np.clip(low[:, None] - first, 0, 64)
    b = np.clip(high[:, None] - first, -1, 63)
    full = np.uint64(2**64 - 1)
    some = b >= a
    out[some] = (full << np.minimum(a, 63)[some].astype(np.uint64)) & (full >> (63 - b[some]).astype(np.uint64))
    return out.view(np.int64).ravel()


def _by_slices(frames: DataFrame, measure: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], dict[str, object]], fields: str, inputs: tuple[str, ...] = ()) -> DataFrame:
    """``frames`` (with mask) and the columns that ``measure`` gives for slices of each batch; a null mask counts as empty."""
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([*frames.schema.fields, *added.fields])
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}
    place = frames.columns.index("mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(place).value_lengths().fill_null(0).to_numpy().astype(np.int64)
            ends, start = np.cumsum(sizes), 0
            while start < len(sizes):
                base = ends[start] - sizes[start]
                stop = max(start + 1, int(np.searchsorted(ends, base + SLICE, "right")))
                part = batch.slice(start, stop - start)
                found = measure(part.column(place).flatten().to_numpy(), sizes[start:stop], part)
                more = [pa.array(found[f.name], kinds[f.dataType.simpleString()]) for f in added.fields]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=schema.names)
                start = stop

    return frames.mapInArrow(run, schema)


def components(frames: DataFrame, width: int) -> DataFrame:
    """``frames`` with components4, components8, largest_fraction and largest of every mask."""
    return _by_slices(frames, lambda words, counts, _: component_measures(words, counts, width), "components4 int, components8 int, largest_fraction double, largest array<bigint>")


def interior(frames: DataFrame, width: int) -> DataFrame:
    """``frames`` with the pixel deepest inside every mask (px, py, depth) as by exact distances, and the share of the frame where it is (u, v)."""
    found = _by_slices(frames, lambda words, counts, _: interior_points(words, counts, width), "px int, py int, depth double")
    height = F.size("mask") * 64 / width
    return found.select("*", ((F.col("px") + 0.5) / width).alias("u"), ((F.col("py") + 0.5) / height).alias("v"))


def nearest(frames: DataFrame, width: int, x: str, y: str) -> DataFrame:
    """``frames`` with the distance of the point (columns x, y) to the nearest pixel of its mask."""

    def measure(words: np.ndarray, counts: np.ndarray, part: pa.RecordBatch) -> dict[str, object]:
        px, py = (part.column(part.schema.names.index(n)).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in (x, y))
        return {"nearest": nearest_pixels(words, counts, width, px, py)}

    return _by_slices(frames, measure, "nearest double")


def grown(frames: DataFrame, width: int, radius: int, name: str = "grown") -> DataFrame:
    """``frames`` with every mask grown by a square, by sums over rectangles."""

    def measure(words: np.ndarray, counts: np.ndarray, _: pa.RecordBatch) -> dict[str, object]:
        bits, first = stacked(words, counts, width)
        return {name: [packed(grown_by_sums(bits[a:b], radius)) for a, b in zip(first[:-1], first[1:], strict=True)]}

    return _by_slices(frames, measure, f"{name} array<bigint>")


def contours(frames: DataFrame, width: int, radius: int = 2) -> DataFrame:
    """``frames`` with the contour of every mask."""

    def measure(words: np.ndarray, counts: np.ndarray, _: pa.RecordBatch) -> dict[str, object]:
        bits, first = stacked(words, counts, width)
        return {"contour": [packed(contour(bits[a:b], radius)) for a, b in zip(first[:-1], first[1:], strict=True)]}

    return _by_slices(frames, measure, "contour array<bigint>")


def filled(polygons: DataFrame, height: int, words: int) -> DataFrame:
    """``polygons`` (xs, ys: arrays of double) with mask: the pixels of the polygon around the points rounded to whole ones.

    Halves go to the even number; nulls and points that aren't finite give no mask.
    """
    schema = T.StructType([*polygons.schema.fields, *T.StructType.fromDDL("mask array<bigint>").fields])
    at = [polygons.columns.index(n) for n in ("xs", "ys")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for xs, ys in zip(*(batch.column(i).to_pylist() for i in at), strict=True):
                points = np.array([xs or (), ys or ()], float).T if len(xs or ()) == len(ys or ()) else np.full((1, 2), np.nan)
                whole = xs is not None and ys is not None and np.isfinite(points).all()
                masks.append(convex_fill(np.rint(points).astype(np.int64).reshape(-1, 2), height, words) if whole else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(masks, pa.list_(pa.int64()))], names=schema.names)

    return polygons.mapInArrow(run, schema)
