"""Queries over shapes of masks of any size and the gripper's place in the picture; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import bitmaps, regions, sequence
from ..sources import adapters as src
from .catalog import _masks, query
from .reviews import _BITS, _wide

c = F.col

_NEAR = "n8 AS (SELECT dx, dy FROM range(-1, 2) a(dx), range(-1, 2) b(dy) WHERE dx <> 0 OR dy <> 0)"
_REACH = "{name} AS (SELECT episode, frame, x, y, y * 128 + x AS root FROM wh UNION SELECT r.episode, r.frame, o.x, o.y, r.root FROM {name} r, {steps} n JOIN wh o ON o.episode = r.episode AND o.frame = r.frame AND o.x = r.x + n.dx AND o.y = r.y + n.dy)"


def _components(name: str) -> str:
    """SQL for the size of each component by its first pixel."""
    return f"(SELECT episode, frame, root, count(*) AS size FROM (SELECT episode, frame, x, y, min(root) AS root FROM {name} GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)"


@query(f"""WITH RECURSIVE {_BITS}, {_NEAR}, n4 AS (SELECT * FROM n8 WHERE dx = 0 OR dy = 0), {_REACH.format(name="r4", steps="n4")}, {_REACH.format(name="r8", steps="n8")},
a AS (SELECT episode, frame, count(*) AS n, arg_max(root, (size, -root)) AS root, max(size) AS size FROM {_components("r4")} GROUP BY 1, 2), b AS (SELECT episode, frame, count(*) AS n, max(size) / sum(size) AS share FROM {_components("r8")} GROUP BY 1, 2)
SELECT bm.episode, bm.frame, coalesce(a.n, 0)::INT AS components4, coalesce(b.n, 0)::INT AS components8, round(share::DOUBLE, 6) AS largest_fraction, coalesce(size, 0) AS largest_area, (root % 128)::INT AS first_x
FROM bm LEFT JOIN a ON a.episode = bm.episode AND a.frame = bm.frame LEFT JOIN b ON b.episode = bm.episode AND b.frame = bm.frame""")
def wide_components(spark, d):
    """4- and 8-components of every mask, and its largest 4-component: area, and the column of its first pixel."""
    m = regions.components(_wide(spark, d), 128).withColumn("mask", c("largest"))
    first = F.array_min(F.filter(F.transform("mask", lambda w, i: F.when(w != 0, i)), lambda i: i.isNotNull()))
    word = F.get("mask", first)
    lowest = F.array_min(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", word, i).bitwiseAND(F.lit(1).cast("bigint")) == 1))
    return m.select("episode", "frame", "components4", "components8", F.round("largest_fraction", 6).alias("largest_fraction"), bitmaps.area(c("mask")).alias("largest_area"), (first % 2 * 64 + lowest).cast("int").alias("first_x"))


#: SQL for the lines that bound a set of whole-numbered points pt (id, x, y) from one side; ``solid`` where not all points lie on it.
_EDGES = "e AS (SELECT a.id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, max((b.x - a.x) * (q.y - a.y) - (b.y - a.y) * (q.x - a.x)) > 0 AS solid FROM pt a JOIN pt b ON a.id = b.id AND (a.x <> b.x OR a.y <> b.y) JOIN pt q ON q.id = a.id GROUP BY ALL HAVING min((b.x - a.x) * (q.y - a.y) - (b.y - a.y) * (q.x - a.x)) >= 0)"
_INSIDE = "(SELECT g.id, count(*) AS pixels, sum(x + 64 * y)::BIGINT AS places FROM (SELECT e.id, x, y FROM e, grid WHERE solid GROUP BY ALL HAVING bool_and((bx - ax) * (y - ay) - (by_ - ay) * (x - ax) >= 0)) g GROUP BY 1)"


@query(f"""WITH {_masks(0.2)}, pt AS (SELECT episode * 100000 + frame AS id, i % 8 AS x, i // 8 AS y FROM (SELECT episode, frame, unnest(range(64)) AS i, unnest(m) AS v FROM mx) WHERE v = 1), {_EDGES},
grid AS (SELECT x, y FROM range(64) a(x), range(8) b(y)), f AS {_INSIDE} SELECT episode, frame, coalesce(pixels, 0) AS pixels, coalesce(places, 0)::BIGINT AS places FROM mx LEFT JOIN f ON f.id = episode * 100000 + frame""")
def hull_fill(spark, d):
    """The pixels in the convex hull of every mask: how many, and the sum of their places."""
    on = src.mask_frames(spark, d, 0.2)
    bit = lambda i: F.call_function("shiftrightunsigned", c("mask"), i).bitwiseAND(F.lit(1).cast("bigint")) == 1
    at = F.filter(F.sequence(F.lit(0), F.lit(63)), bit)
    points = on.select("episode", "frame", F.transform(at, lambda i: (i % 8).cast("double")).alias("xs"), F.transform(at, lambda i: F.floor(i / 8).cast("double")).alias("ys"))
    return _places(regions.filled(points, 8, 1).select("episode", "frame", "mask"))


def _places(filled):
    """pixels and the sum of their places, of masks of one word to a row."""
    cx, cy = bitmaps.centroid(c("mask"), 1)
    size = bitmaps.area(c("mask"))
    return filled.withColumns({"pixels": size, "places": F.coalesce(F.round(cx * size) + 64 * F.round(cy * size), F.lit(0)).cast("long")}).drop("mask")


@query(f"""WITH {_BITS}, al AS (SELECT episode, frame, x, y FROM bm, range(128) a(x), range(4) b(y)), off AS (SELECT al.* FROM al ANTI JOIN wh ON al.episode = wh.episode AND al.frame = wh.frame AND al.x = wh.x AND al.y = wh.y),
s AS (SELECT a.episode, a.frame, a.x, a.y, min((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS far FROM wh a JOIN off b ON a.episode = b.episode AND a.frame = b.frame GROUP BY ALL),
t AS (SELECT episode, frame, arg_max(x, (far, -(y * 128 + x))) AS px, arg_max(y, (far, -(y * 128 + x))) AS py, max(far) AS far FROM s GROUP BY 1, 2),
k AS (SELECT wh.episode, wh.frame, min((wh.x - wh.frame * 3 % 128 - 0.25) ** 2 + (wh.y - 1.5) ** 2) AS near FROM wh WHERE wh.frame % 6 <> 5 GROUP BY 1, 2)
SELECT bm.episode, bm.frame, px::INT AS px, py::INT AS py, round(sqrt(far), 6) AS depth, round((px + 0.5) / 128::DOUBLE, 6) AS u, round((py + 0.5) / 4::DOUBLE, 6) AS v, round(sqrt(near), 6) AS nearest
FROM bm LEFT JOIN t ON t.episode = bm.episode AND t.frame = bm.frame LEFT JOIN k ON k.episode = bm.episode AND k.frame = bm.frame""")
def mask_distances(spark, d):
    """The pixel deepest inside every mask, and how far a point that moves along is from the mask (no point on some frames)."""
    at = c("frame")
    m = _wide(spark, d).withColumns({"x": F.when(at % 6 != 5, at * 3 % 128 + 0.25), "y": F.lit(1.5)})
    found = regions.nearest(regions.interior(m, 128), 128, "x", "y")
    return found.select("episode", "frame", "px", "py", *(F.round(n, 6).alias(n) for n in ("depth", "u", "v", "nearest")))


def _spread_sql(name: str, radius: int, source: str = "wh") -> str:
    step = f"range(-{radius}, {radius + 1})"
    return f"{name} AS (SELECT DISTINCT episode, frame, x + dx AS x, y + dy AS y FROM {source}, {step} a(dx), {step} b(dy) WHERE x + dx BETWEEN 0 AND 127 AND y + dy BETWEEN 0 AND 3)"


@query(f"""WITH {_BITS}, {_spread_sql("g1", 1)}, {_spread_sql("g2", 2)}, {_spread_sql("g70", 70)}, al AS (SELECT episode, frame, x, y FROM bm, range(128) a(x), range(4) b(y)), off AS (SELECT al.* FROM al ANTI JOIN wh ON al.episode = wh.episode AND al.frame = wh.frame AND al.x = wh.x AND al.y = wh.y), {_spread_sql("h1", 1, "off")},
n AS (SELECT episode, frame, 'w' AS k FROM wh UNION ALL SELECT episode, frame, '1' FROM g1 UNION ALL SELECT episode, frame, '2' FROM g2 UNION ALL SELECT episode, frame, '70' FROM g70 UNION ALL SELECT wh.episode, wh.frame, 'e' FROM wh ANTI JOIN h1 ON h1.episode = wh.episode AND h1.frame = wh.frame AND h1.x = wh.x AND h1.y = wh.y),
s AS (SELECT bm.episode, bm.frame, count(CASE WHEN k = 'w' THEN 1 END) AS w, count(CASE WHEN k = '1' THEN 1 END) AS one, count(CASE WHEN k = '2' THEN 1 END) AS two, count(CASE WHEN k = '70' THEN 1 END) AS most, count(CASE WHEN k = 'e' THEN 1 END) AS inner_ FROM bm LEFT JOIN n ON n.episode = bm.episode AND n.frame = bm.frame GROUP BY 1, 2)
SELECT episode, frame, one - w AS outline, two - one AS halo, most AS wide, two - inner_ AS contour, true AS same FROM s""")
def mask_outlines(spark, d):
    """Pixels of outline, halo, a wide growth and contour of every mask; the ways to grow agree."""
    m = bitmaps.spread(bitmaps.outlines(_wide(spark, d), 2, 1, 2), "mask", 2, 70, "wide")
    found = regions.contours(regions.grown(m, 128, 70), 128)
    sizes = (bitmaps.area(c(n)).alias(n) for n in ("outline", "halo", "wide", "contour"))
    return found.select("episode", "frame", *sizes, (c("wide") == c("grown")).alias("same"))


# --- the gripper's place

_POSES = """ev AS (SELECT event_id AS id, event_id % 9 * 0.05 - 0.2 AS px, event_id % 11 * 0.04 - 0.2 AS py, event_id % 20 * 0.1 AS pz, event_id % 7 * 0.9 AS pr, event_id % 5 * 0.3 - 0.6 AS pp, event_id % 13 * 0.5 AS pw, CASE WHEN event_id % 17 <> 0 THEN value / 50 END AS op FROM events),
ro AS (SELECT *, cos(pw) * cos(pp) AS a, cos(pw) * sin(pp) * sin(pr) - sin(pw) * cos(pr) AS b, cos(pw) * sin(pp) * cos(pr) + sin(pw) * sin(pr) AS c, sin(pw) * cos(pp) AS d, sin(pw) * sin(pp) * sin(pr) + cos(pw) * cos(pr) AS e, sin(pw) * sin(pp) * cos(pr) - cos(pw) * sin(pr) AS f, -sin(pp) AS g, cos(pp) * sin(pr) AS h, cos(pp) * cos(pr) AS i FROM ev),
lo AS (SELECT *, 0.12 + l AS lx, w * (0.045 + greatest(0, least(1, op)) * 0.04) AS ly, t AS lz FROM ro, (VALUES (-0.025, -1, -0.05), (-0.025, -1, 0.05), (-0.025, 1, -0.05), (-0.025, 1, 0.05), (0.06, -1, -0.05), (0.06, -1, 0.05), (0.06, 1, -0.05), (0.06, 1, 0.05)) k(l, w, t) WHERE op IS NOT NULL),
wo AS (SELECT id, px + a * lx + b * ly + c * lz AS x, py + d * lx + e * ly + f * lz AS y, pz + g * lx + h * ly + i * lz AS z FROM lo UNION ALL SELECT id, px, py, pz FROM ro WHERE op IS NOT NULL),
pc AS (SELECT id, x + 0.03200001 AS cx, -0.8 * y - 0.6 * z + 0.45 AS cy, 0.6 * y - 0.8 * z + 1.35 AS cz, row_number() OVER () AS r FROM wo),
ok AS (SELECT id FROM pc GROUP BY 1 HAVING min(cz) > 1e-8),
uv AS (SELECT id, 358.64218::DOUBLE * x / z + 160 AS u, 358.64218::DOUBLE * y / z + 120 AS v FROM (SELECT lo.id, px + a * lx + b * ly + c * lz + 0.03200001 AS x, -0.8 * (py + d * lx + e * ly + f * lz) - 0.6 * (pz + g * lx + h * ly + i * lz) + 0.45 AS y, 0.6 * (py + d * lx + e * ly + f * lz) - 0.8 * (pz + g * lx + h * ly + i * lz) + 1.35 AS z FROM lo JOIN ok USING (id)))"""


def _roi(spark, d):
    k = c("event_id")
    names = ["px", "py", "pz", "pr", "pp", "pw"]
    values = (k % 9 * 0.05 - 0.2, k % 11 * 0.04 - 0.2, k % 20 * 0.1, k % 7 * 0.9, k % 5 * 0.3 - 0.6, k % 13 * 0.5)
    e = src.table(spark, d, "events").select(k.alias("id"), *(v.alias(n) for v, n in zip(values, names, strict=True)), F.when(k % 17 != 0, c("value") / 50).alias("op"))
    return geometry.with_gripper_roi(e, names, "op", 320, 240)


@query(f"""WITH {_POSES}, b AS (SELECT id, min(u) - 3 AS x0, min(v) - 3 AS y0, max(u) + 3 AS x1, max(v) + 3 AS y1 FROM uv GROUP BY 1),
q AS (SELECT *, greatest(0, least(320, floor(x0))) / 320 AS r0, greatest(0, least(240, floor(y0))) / 240 AS s0, greatest(0, least(320, ceil(x1))) / 320 AS r1, greatest(0, least(240, ceil(y1))) / 240 AS s1 FROM b)
SELECT ev.id, round(x0, 4) AS x0, round(y0, 4) AS y0, round(x1, 4) AS x1, round(y1, 4) AS y1, round(CASE WHEN r1 > r0 AND s1 > s0 THEN r0 END, 6) AS left_share, round(CASE WHEN r1 > r0 AND s1 > s0 THEN s1 END, 6) AS bottom_share, CASE WHEN op IS NULL THEN 'missing' WHEN q.id IS NULL THEN 'behind' END AS reason FROM ev LEFT JOIN q USING (id)""")
def gripper_roi(spark, d):
    """The gripper's box in the picture of every recorded pose."""
    box = (F.round(n, 4).alias(n) for n in ("x0", "y0", "x1", "y1"))
    return _roi(spark, d).select("id", *box, F.round("roi.x0", 6).alias("left_share"), F.round("roi.y1", 6).alias("bottom_share"), "reason")


@query(f"""WITH {_POSES}, pt AS (SELECT DISTINCT id, round_even(u / 20, 0)::BIGINT AS x, round_even(v / 20, 0)::BIGINT AS y FROM uv), {_EDGES}, grid AS (SELECT x, y FROM range(64) a(x), range(12) b(y)), f AS {_INSIDE}
SELECT ok.id, coalesce(pixels, 0) AS pixels, coalesce(places, 0)::BIGINT AS places FROM ok LEFT JOIN f USING (id)""")
def gripper_fill(spark, d):
    """The polygon around the gripper's corners as pixels of 20 by 20, on 64 columns and 12 rows."""
    small = lambda n: F.transform(n, lambda v: v / 20)
    p = _roi(spark, d).select("id", small("xs").alias("xs"), small("ys").alias("ys"))
    return _places(regions.filled(p, 12, 1).where("mask is not null").select("id", "mask"))
