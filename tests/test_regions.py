"""Components, fills, distances, growth and the gripper's box: against plain loops over pixels, at the size of real frames too."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.functions import geometry
from loomframe.operators import bitmaps, regions

HEIGHT, WIDTH, WORDS = 240, 320, 5


def blobs(seed, height, width, n, size=30):
    rng = np.random.default_rng(seed)
    m = np.zeros((height, width), bool)
    for _ in range(n):
        y, x, h, w = rng.integers(0, height), rng.integers(0, width), rng.integers(1, size), rng.integers(1, size)
        m[y : y + h, x : x + w] ^= True
    return m


def flooded(mask, eight):
    """Components by flooding, in the order of their first pixels."""
    left, found = mask.copy(), []
    steps = [(-1, 0), (1, 0), (0, -1), (0, 1)] + [(-1, -1), (-1, 1), (1, -1), (1, 1)] * eight
    for y, x in zip(*np.nonzero(mask), strict=True):
        if not left[y, x]:
            continue
        todo, part = [(y, x)], []
        left[y, x] = False
        while todo:
            p = todo.pop()
            part.append(p)
            for dy, dx in steps:
                q = p[0] + dy, p[1] + dx
                if 0 <= q[0] < mask.shape[0] and 0 <= q[1] < mask.shape[1] and left[q]:
                    left[q] = False
                    todo.append(q)
        found.append(part)
    return found


def frames(spark, masks):
    rows = [(i, None if m is None else [int(w) for w in regions.packed(m)]) for i, m in enumerate(masks)]
    return spark.createDataFrame(rows, "id int, mask array<bigint>").withColumn("keys", F.lit("clash"))


def unpacked(words, width):
    return regions.stacked(np.array(words, np.int64), np.array([len(words)]), width)[0]


@pytest.fixture(scope="module")
def masks():
    spiral = np.zeros((HEIGHT, WIDTH), bool)
    for i in range(0, 100, 4):
        spiral[i : HEIGHT - i, i] = spiral[i : HEIGHT - i, WIDTH - 1 - i] = spiral[i, i : WIDTH - i] = spiral[HEIGHT - 1 - i, i + 4 : WIDTH - i] = True
    checks = np.indices((HEIGHT, WIDTH)).sum(axis=0) % 2 == 0
    two = np.zeros((HEIGHT, WIDTH), bool)
    two[10:12, 5] = two[10:12, 9] = True
    return [*(blobs(i, HEIGHT, WIDTH, 60) for i in range(4)), spiral, checks & blobs(9, HEIGHT, WIDTH, 5, 90), two, np.zeros((HEIGHT, WIDTH), bool), np.ones((HEIGHT, WIDTH), bool)]


@pytest.mark.parametrize("limit", [regions.SLICE, 1])
def test_components_of_real_frames(spark, masks, limit, monkeypatch):
    monkeypatch.setattr(regions, "SLICE", limit)
    got = {r["id"]: r for r in regions.components(frames(spark, masks), WIDTH).collect()}
    for i, m in enumerate(masks):
        four, eight = flooded(m, False), flooded(m, True)
        assert (got[i]["components4"], got[i]["components8"]) == (len(four), len(eight))
        if not m.any():
            assert got[i]["largest_fraction"] is None and not any(got[i]["largest"])
            continue
        assert got[i]["largest_fraction"] == pytest.approx(max(map(len, eight)) / m.sum())
        kept = np.zeros_like(m)
        kept[tuple(np.array(max(four, key=len)).T)] = True  # the first of equals
        assert (unpacked(got[i]["largest"], WIDTH) == kept).all()


def test_components_of_nothing(spark, masks):
    assert regions.components(frames(spark, masks).limit(0), WIDTH).count() == 0
    row = regions.components(frames(spark, [None]), WIDTH).first()
    assert (row["components4"], row["components8"], row["largest_fraction"], row["largest"]) == (0, 0, None, [])


def test_distances_of_real_frames(spark, masks):
    small = [blobs(i, 24, 64, 6, 15) for i in range(6)] + [np.ones((24, 64), bool), np.zeros((24, 64), bool)]
    got = {r["id"]: r for r in regions.interior(frames(spark, small), 64).collect()}
    for i, m in enumerate(small):
        off = np.argwhere(~m)
        far = np.array([[((off - (y, x)) ** 2).sum(axis=1).min() if m[y, x] and len(off) else np.inf if m[y, x] else 0 for x in range(64)] for y in range(24)])
        if not m.any():
            assert got[i]["px"] is None
            continue
        y, x = np.unravel_index(np.argmax(far), far.shape)
        assert (got[i]["px"], got[i]["py"], got[i]["depth"]) == (x, y, pytest.approx(np.sqrt(far.max())))
        assert (got[i]["u"], got[i]["v"]) == (pytest.approx((x + 0.5) / 64), pytest.approx((y + 0.5) / 24))
    large = {r["id"]: r for r in regions.interior(frames(spark, masks), WIDTH).collect()}
    box = np.pad(np.ones((11, 31), bool), ((100, 129), (50, 239)))
    assert regions.interior(frames(spark, [box]), WIDTH).first()["depth"] == 6
    assert large[7]["px"] is None and (large[8]["px"], large[8]["py"]) == (0, 0)


def test_nearest_pixel(spark, masks):
    f = frames(spark, masks).withColumns({"x": F.when(F.col("id") != 1, F.col("id") * 31.5), "y": F.lit(17.25)})
    for r in regions.nearest(f, WIDTH, "x", "y").collect():
        at = np.argwhere(masks[r["id"]])
        expected = np.sqrt(((at - (17.25, r["id"] * 31.5)) ** 2).sum(axis=1).min()) if len(at) and r["id"] != 1 else None
        assert r["nearest"] == (expected if expected is None else pytest.approx(expected))


@pytest.mark.parametrize("radius", [0, 1, 5, 70])
def test_growth_both_ways(spark, masks, radius):
    found = regions.grown(bitmaps.spread(frames(spark, masks[:6]), "mask", WORDS, radius, "wide"), WIDTH, radius)
    for r in found.collect():
        m = np.pad(masks[r["id"]], radius)
        columns = np.any([m[:, d : d + WIDTH] for d in range(2 * radius + 1)], axis=0)
        plain = np.any([columns[d : d + HEIGHT] for d in range(2 * radius + 1)], axis=0)
        assert (unpacked(r["grown"], WIDTH) == plain).all() and r["wide"] == r["grown"]


def test_outline_and_halo_lie_outside(spark, masks):
    for r in bitmaps.outlines(frames(spark, masks), WORDS, 2, 4).collect():
        m = masks[r["id"]]
        outline, halo = unpacked(r["outline"], WIDTH), unpacked(r["halo"], WIDTH)
        assert not (outline & m).any() and not (halo & (m | outline)).any()
        assert ((m | outline | halo) == regions.grown_by_sums(m, 4)).all()
    with pytest.raises(ValueError):
        bitmaps.outlines(frames(spark, masks), WORDS, 3, 2)


def test_contour_is_not_shrunk_by_the_frame():
    full = np.ones((5, 6), bool)
    assert not regions.contour(full).any()
    dot = np.zeros((5, 6), bool)
    dot[2, 2] = True
    assert regions.contour(dot, 1).sum() == 9


def test_fill_is_that_of_half_planes():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 5, 12, 40):
        for _ in range(20):
            points = rng.integers(-20, 150, (n, 2))
            got = unpacked(regions.convex_fill(points, 60, 2), 128)
            y, x = np.mgrid[:60, :128]
            lines = [(a, b) for a in points for b in points if (a != b).any() and all((b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0]) >= 0 for q in points)]
            solid = any((b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0]) > 0 for a, b in lines for q in points)
            inside = np.all([(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) >= 0 for a, b in lines], axis=0) if solid else np.zeros((60, 128), bool)
            assert (got == inside).all()


def test_fill_of_odd_polygons(spark):
    rows = [(0, [0.5, 3.5, 3.5, 0.5], [0.0, 0.0, 2.4, 2.4]), (1, None, [1.0]), (2, [1.0, float("nan"), 2.0], [1.0, 2.0, 3.0]), (3, [1.0, 5.0, 9.0], [1.0, 5.0, 9.0]), (4, [], []), (5, [1.0], [1.0, 2.0])]
    got = {r["id"]: r["mask"] for r in regions.filled(spark.createDataFrame(rows, "id int, xs array<double>, ys array<double>"), 4, 1).collect()}
    assert got[0] == [0b11111] * 3 + [0]  # 0.5 and 3.5 become 0 and 4
    assert got[1] is None and got[2] is None and got[5] is None and got[3] == got[4] == [0] * 4


POSE = (-0.0956539511680603, 0.0383211150765419, 0.9840234518051147, -0.002832249039784074, 1.265782356262207, 0.807780385017395)


def test_gripper_box(spark):
    nan = float("nan")
    rows = [(1, *POSE, 1.0), (2, 0.0, 0.0, 1.8, 0.0, 0.0, 0.0, 1.0), (3, *POSE[:5], nan, 1.0), (4, *POSE, None), (5, 3.0, 0.0, 0.9, 0.0, 0.0, 0.0, 0.5), (6, *POSE, 7.5)]
    names = ["x", "y", "z", "roll", "pitch", "yaw"]
    frame = spark.createDataFrame(rows, "id int, x double, y double, z double, roll double, pitch double, yaw double, opening double")
    got = {r["id"]: r for r in geometry.with_gripper_roi(frame, names, "opening", 320, 240).collect()}
    r = got[1]
    assert (r["hand_x"], r["hand_y"]) == (pytest.approx(121.02764577, abs=1e-6), pytest.approx(15.26118804, abs=1e-6))
    assert [r[n] for n in ("x0", "y0", "x1", "y1")] == pytest.approx([85.80406068, 8.24879147, 196.94422467, 114.92051119], abs=1e-6)
    assert (got[2]["reason"], got[3]["reason"], got[4]["reason"], got[1]["reason"]) == ("behind", "missing", "missing", None)
    assert got[2]["x0"] is None and got[2]["roi"] is None and got[3]["xs"] is None
    assert got[5]["roi"] is None and got[5]["reason"] is None  # beside the picture
    assert got[6]["x0"] == pytest.approx(got[1]["x0"])  # open beyond 1 is 1
    assert (r["roi"]["x0"], r["roi"]["y1"]) == (85 / 320, 115 / 240)


def test_box_of_shares_is_clamped(spark):
    box = geometry.clamped_box(F.lit(-1.2), F.lit(2.2), F.lit(10.1), F.lit(12.0), F.lit(20), F.lit(10))
    row = spark.range(1).select(*(v.alias(k) for k, v in box.items())).first()
    assert [row[k] for k in ("x0", "y0", "x1", "y1")] == [0.0, 0.2, 0.55, 1.0]
