"""Projection, boxes and joint mappings in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The camera's focal length and centre: fixed values.
FOCAL, CENTRE = 358.64218, (160.0, 120.0)


def rotation(roll: Column, pitch: Column, yaw: Column) -> list[list[Column]]:
    """Rows of Rz(yaw) Ry(pitch) Rx(roll)."""
    (sr, cr), (sp, cp), (sy, cy) = ((F.sin(a), F.cos(a)) for a in (roll, pitch, yaw))
    return [[cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr], [sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr], [-sp, cp * sr, cp * cr]]


def transform(matrix: list[list[Column]], point: list[Column], offset: list[Column]) -> list[Column]:
    return [sum((m * p for m, p in zip(row, point, strict=True)), o) for row, o in zip(matrix, offset, strict=True)]


def project(x: Column, y: Column, z: Column, focal: float = FOCAL, centre: tuple[float, float] = CENTRE) -> tuple[Column, Column]:
    """Pixel of a point before a pinhole camera; nulls behind it."""
    ahead = F.when(z > 0, z)
    return focal * x / ahead + centre[0], focal * y / ahead + centre[1]


def clamped_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    """A pixel box as shares of the frame, cut to it."""
    share = lambda v, size: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / size))
    return {"x0": share(F.floor(x0), width), "y0": share(F.floor(y0), height), "x1": share(F.ceil(x1), width), "y1": share(F.ceil(y1), height)}


def joint_position(drive: Column, low: float, high: float, scale: float, offset: float = 0.0) -> Column:
    """Joint position of a drive value: affine, within the joint's limits."""
    return F.greatest(F.lit(low), F.least(F.lit(high), drive * scale + offset))


def grid(low: Column, high: Column, step: float) -> Column:
    """Values from low to high in steps, high included."""
    n = F.floor((high - low) / step + 1e-9).cast("int")
    inner = F.transform(F.sequence(F.lit(0), n), lambda i: low + i * step)
    return F.when(F.abs(low + n * step - high) < 1e-9, inner).otherwise(F.array_append(inner, high))


def chain(joints: list[tuple[list[Column], list[Column]]], point: list[Column]) -> list[Column]:
    """A point of the last link in the first one's frame; joints are (roll, pitch, yaw) and offset, first to last."""
    for angles, offset in reversed(joints):
        point = transform(rotation(*angles), point, offset)
    return point


def visible(rendered: Column, scene: Column, tolerance: float) -> Column:
    """Whether a rendered pixel is in view: both depths are finite and above 0, and no more than ``tolerance`` apart."""
    known = lambda d: (d > 0) & (d < float("inf"))
    return F.coalesce(known(rendered) & known(scene) & (F.abs(rendered - scene) <= tolerance), F.lit(False))


def saturated_blue(red: Column, green: Column, blue: Column) -> Column:
    """Whether a pixel is clearly blue."""
    return (blue >= 80) & (blue - red >= 30) & (blue - green >= 20)


#: The camera's turn and offset, and the sizes of the gripper's box in metres: fixed values.
EXTRINSIC = ((1.0, 0.0, 0.0, 0.03200001), (0.0, -0.8, -0.6, 0.45), (0.0, 0.6, -0.8, 1.35))
GRIPPER = {"tip": 0.12, "back": 0.025, "front": 0.06, "closed": 0.045, "open": 0.085, "thick": 0.05}
#: Depth from which on a point is before the camera.
NEAREST = 1e-8


def seen(world: list[Column], extrinsic: tuple[tuple[float, ...], ...] = EXTRINSIC) -> tuple[Column, Column, Column]:
    """Pixel and depth of a point of the world; the pixel is null at or behind the camera's plane."""
    turn = [[F.lit(v) for v in row[:3]] for row in extrinsic]
    x, y, z = transform(turn, world, [F.lit(row[3]) for row in extrinsic])
    ahead = F.when(z > NEAREST, z)
    return FOCAL * x / ahead + CENTRE[0], FOCAL * y / ahead + CENTRE[1], z


def gripper_corners(hand: list[Column], turn: list[list[Column]], opening: Column, size: dict[str, float] = GRIPPER) -> tuple[list[Column], list[Column], list[list[Column]]]:
    """World positions of the hand, of the point between the fingers, and of the eight corners of the box around them.

    ``turn`` is the hand's rotation; the box widens with ``opening``, cut to 0 to 1.
    """
    tip = transform(turn, [F.lit(size["tip"]), F.lit(0.0), F.lit(0.0)], hand)
    half = size["closed"] + F.greatest(F.lit(0.0), F.least(F.lit(1.0), opening)) * (size["open"] - size["closed"])
    ends, thick = (F.lit(-size["back"]), F.lit(size["front"])), (F.lit(-size["thick"]), F.lit(size["thick"]))
    return hand, tip, [transform(turn, [x, y, z], tip) for x in ends for y in (-half, half) for z in thick]


def with_gripper_roi(frames: DataFrame, pose: list[str], opening: str, width: int, height: int, margin: float = 3.0) -> DataFrame:
    """``frames`` with the gripper's place in the picture: hand_x, hand_y, tip_x, tip_y, xs and ys (corners), x0 to y1 (box), roi, reason.

    The box has ``margin`` pixels around the corners; roi has it as shares of the frame, cut to it, and is null if nothing of
    it is in the frame. If any corner is at or behind the camera all are null and reason is ``behind``; ``missing`` if a number
    is null or not finite.
    """
    known = F.lit(True)
    for name in (*pose, opening):
        known &= F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(name) < float("inf"))
    # what is used often is a column of its own, or it would be worked out again wherever it is used
    turn = rotation(*(F.col(n) for n in pose[3:]))
    turned = frames.select("*", *(v.alias(f"__r{i}{j}") for i, row in enumerate(turn) for j, v in enumerate(row)))
    hand, tip, corners = gripper_corners([F.col(n) for n in pose[:3]], [[F.col(f"__r{i}{j}") for j in range(3)] for i in range(3)], F.col(opening))
    world = turned.select("*", F.array(*(F.struct(*(v.alias(n) for v, n in zip(p, "xyz", strict=True))) for p in (hand, tip, *corners))).alias("__world"))
    points = F.transform("__world", lambda p: F.struct(*(v.alias(n) for v, n in zip(seen([p["x"], p["y"], p["z"]]), "xyz", strict=True))))
    placed = world.withColumn("__points", points).withColumn("__ok", F.coalesce(known & (F.array_min(F.transform("__points", lambda p: p["z"])) > NEAREST), F.lit(False)))
    at = lambda i, n: F.when(F.col("__ok"), F.get("__points", i)[n])
    listed = lambda n: F.when(F.col("__ok"), F.transform(F.slice("__points", 3, 8), lambda p: p[n]))
    found = placed.withColumns({"hand_x": at(0, "x"), "hand_y": at(0, "y"), "tip_x": at(1, "x"), "tip_y": at(1, "y"), "xs": listed("x"), "ys": listed("y")})
    found = found.withColumns({"x0": F.array_min("xs") - margin, "y0": F.array_min("ys") - margin, "x1": F.array_max("xs") + margin, "y1": F.array_max("ys") + margin})
    box = clamped_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(width), F.lit(height))
    roi = F.when((box["x1"] > box["x0"]) & (box["y1"] > box["y0"]), F.struct(*(v.alias(n) for n, v in box.items())))
    reason = F.when(~known, "missing").when(~F.col("__ok"), "behind")
    return found.withColumn("roi", roi).withColumn("reason", reason).drop("__world", "__points", "__ok", *(f"__r{i}{j}" for i in range(3) for j in range(3)))
