"""Trees of joints: models read from XML, what is wrong with them, and where each link is for given joint positions.

A model is one row and as large as the machine it describes. Its links' ways from the root are found within the row, so that
a million models, or a million frames of one, need no shuffle but the join of positions with models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry

c = F.col
_ORIGIN = "struct<_xyz: string, _rpy: string>"
SCHEMA = (
    "link array<struct<_name: string>>, joint array<struct<_name: string, _type: string, parent: struct<_link: string>, child: struct<_link: string>, "
    f"origin: {_ORIGIN}, axis: struct<_xyz: string>, limit: struct<_lower: string, _upper: string>>>"
)
TURNING, SLIDING, FIXED = ("revolute", "continuous"), "prismatic", "fixed"
#: A pose as three rows of four numbers.
IDENTITY = (1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0)
#: Length from which on an axis points somewhere.
SHORTEST = 2.220446049250313e-16


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def _vector(text: Column, default: tuple[float, float, float]) -> Column:
    """Three numbers; the default without a text, null if it isn't three finite numbers."""
    parts = F.transform(F.split(F.trim(text), r"\s+"), lambda p: p.try_cast("double"))
    # within a transform the text is split once, though its parts are looked at several times; nothing that isn't finite is less than infinity
    sound = F.transform(F.array(parts), lambda v: F.when((F.size(v) == 3) & F.forall(v, lambda x: F.abs(x) < float("inf")), v))
    return F.when(text.isNull(), F.array(*map(F.lit, default))).otherwise(F.get(sound, 0))


def models(rows: DataFrame, xml: str = "xml") -> DataFrame:
    """``rows`` with links (names) and joints of a robot's XML (name, kind, parent, child, xyz, rpy, axis, lower, upper), nulls for what isn't XML."""
    read = rows.withColumn("__m", F.when(F.col(xml).rlike(r"(?s)^\s*(<\?.*?\?>\s*)?(<!--.*?-->\s*)*<robot[\s>/]"), F.from_xml(xml, SCHEMA, {"mode": "PERMISSIVE"})))
    number = lambda t: F.trim(t).try_cast("double")

    def joint(j: Column) -> Column:
        limits = {n: number(j["limit"][f"_{n}"]) for n in ("lower", "upper")}
        stated = [j["limit"][f"_{n}"].isNotNull() & ~F.coalesce(_finite(limits[n]), F.lit(False)) for n in limits]
        fields = {
            "name": F.coalesce(j["_name"], F.lit("")), "kind": F.coalesce(j["_type"], F.lit("")), "parent": F.coalesce(j["parent"]["_link"], F.lit("")), "child": F.coalesce(j["child"]["_link"], F.lit("")),
            "xyz": _vector(j["origin"]["_xyz"], (0.0, 0.0, 0.0)), "rpy": _vector(j["origin"]["_rpy"], (0.0, 0.0, 0.0)), "axis": _vector(j["axis"]["_xyz"], (1.0, 0.0, 0.0)), **limits, "odd_limit": stated[0] | stated[1],
        }
        return F.struct(*(v.alias(n) for n, v in fields.items()))

    links = F.transform(F.coalesce("__m.link", F.array().cast("array<struct<_name:string>>")), lambda x: F.coalesce(x["_name"], F.lit("")))
    joints = F.transform(F.coalesce("__m.joint", F.array().cast(f"array<{SCHEMA.split('joint array<', 1)[1]}")), joint)
    known = c("__m").isNotNull()
    return read.select(*rows.columns, F.when(known, links).alias("links"), F.when(known, joints).alias("joints"))


def _length(axis: Column) -> Column:
    return F.sqrt(F.aggregate(axis, F.lit(0.0), lambda a, x: a + x * x))


def judged(found: DataFrame) -> DataFrame:
    """``found`` (of ``models``) with root, ways (each link's joints from the root on, by number), and the first thing that is wrong as ``reason``.

    xml, link_names (missing or repeated), joint_names, type, unknown_link, parents (a link with several), vector, axis (of a
    joint that moves), limit, root (not exactly one), unreached (links in a circle).
    """
    # columns, as what is worked out within a lambda is worked out for each of its calls
    read = found.withColumns({f"__{n}": c(f"joints.{n}") for n in ("name", "child", "parent")})
    names, children, parents = c("__name"), c("__child"), c("__parent")
    some = lambda test: F.exists("joints", test)
    moving = lambda j: j["kind"] != FIXED
    roots = F.array_except("links", children)
    ways = F.when(F.size(F.array_distinct(children)) == F.size("joints"), F.transform("links", lambda link: F.struct(link.alias("link"), _way(children, parents, link).alias("way"))))
    with_ways = read.withColumn("__roots", roots).withColumn("ways", ways)
    reason = F.coalesce(
        F.when(c("links").isNull(), "xml"), F.when((F.size("links") == 0) | F.array_contains("links", "") | (F.size(F.array_distinct("links")) < F.size("links")), "link_names"),
        F.when(F.array_contains(names, "") | (F.size(F.array_distinct(names)) < F.size(names)), "joint_names"), F.when(some(lambda j: ~j["kind"].isin(*TURNING, SLIDING, FIXED)), "type"),
        F.when(some(lambda j: ~F.array_contains("links", j["parent"]) | ~F.array_contains("links", j["child"])), "unknown_link"), F.when(F.size(F.array_distinct(children)) < F.size(children), "parents"),
        F.when(some(lambda j: j["xyz"].isNull() | j["rpy"].isNull() | j["axis"].isNull()), "vector"), F.when(some(lambda j: moving(j) & (_length(j["axis"]) <= SHORTEST)), "axis"), F.when(some(lambda j: j["odd_limit"]), "limit"),
        F.when(F.size("__roots") != 1, "root"), F.when(F.exists("ways", lambda w: w["way"].isNull()), "unreached"),
    )
    return with_ways.select(*found.columns, F.when(reason.isNull(), F.get("__roots", 0)).alias("root"), "ways", reason.alias("reason"))


def _way(children: Column, parents: Column, link: Column) -> Column:
    """Numbers of the joints from the root to a link, first to last; null where they go in a circle."""
    start = F.struct(link.alias("at"), F.array().cast("array<int>").alias("way"))

    def step(s: Column, _: Column) -> Column:
        i = F.array_position(children, s["at"]).cast("int")
        return F.when(i == 0, s).otherwise(F.struct(F.get(parents, i - 1).alias("at"), F.array_prepend(s["way"], i - 1).alias("way")))

    end = F.aggregate(children, start, step)
    return F.when(F.array_position(children, end["at"]) == 0, end["way"])


def _locals(joints: Column, position: Column) -> Column:
    """Every joint's pose in its parent: its origin, then its motion; in steps, so that each number is worked out once."""

    def numbers(j: Column) -> Column:
        q, turned = F.coalesce(F.try_element_at(position, j["name"]), F.lit(0.0)), j["kind"].isin(*TURNING)
        axis = F.when(turned, j["axis"]).otherwise(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))
        angle, slide = F.when(turned, q).otherwise(F.lit(0.0)), F.when(j["kind"] == SLIDING, q).otherwise(F.lit(0.0))
        found = {"axis": axis, "length": _length(axis), "s": F.sin(angle), "v": 1 - F.cos(angle), "slide": F.transform(j["axis"], lambda a: a * slide), "xyz": j["xyz"], "rpy": j["rpy"]}
        return F.struct(*(v.alias(n) for n, v in found.items()))

    def turns(j: Column) -> Column:
        x, y, z = (j["axis"][i] / j["length"] for i in range(3))
        s, v = j["s"], j["v"]
        motion = [1 - v * (y * y + z * z), v * x * y - s * z, v * x * z + s * y, v * x * y + s * z, 1 - v * (x * x + z * z), v * y * z - s * x, v * x * z - s * y, v * y * z + s * x, 1 - v * (x * x + y * y)]
        origin = sum(geometry.rotation(*(j["rpy"][i] for i in range(3))), [])
        return F.struct(F.array(*origin).alias("o"), F.array(*motion).alias("w"), j["slide"].alias("slide"), j["xyz"].alias("xyz"))

    def pose(j: Column) -> Column:
        row = lambda i, of: j["o"][3 * i] * of(0) + j["o"][3 * i + 1] * of(1) + j["o"][3 * i + 2] * of(2)
        column = lambda k: lambda i: j["w"][3 * i + k]
        return F.array(*(x for i in range(3) for x in (*(row(i, column(k)) for k in range(3)), j["xyz"][i] + row(i, lambda i: j["slide"][i]))))

    return F.transform(F.transform(F.transform(joints, numbers), turns), pose)


def composed(a: Column, b: Column) -> Column:
    """The pose b of something that a is the pose of."""
    return F.array(*(sum((a[4 * i + k] * b[4 * k + j] for k in range(3)), a[4 * i + 3] if j == 3 else F.lit(0.0)) for i in range(3) for j in range(4)))


def link_poses(found: DataFrame, positions: DataFrame, keys: list[str], at: str = "positions", root: tuple[float, ...] = IDENTITY) -> DataFrame:
    """keys and the other columns of ``positions`` with link, pose (three rows of four numbers) and reason, a row for each link.

    ``found`` are models (of ``judged``), of which those with a reason have no rows, ``positions`` rows with a map of joints' positions; a joint that
    it doesn't name is at 0. A position that isn't finite, or of a joint that the model doesn't have, gives one row without a link,
    reason position or unknown_joint.
    """
    # no filter, which would be pushed below the reading of XML and repeat it; models that aren't sound have no ways
    both = positions.join(found.select(*keys, "joints", F.when(c("reason").isNull(), c("ways")).alias("ways")), keys)
    q = F.coalesce(c(at), F.create_map().cast("map<string,double>"))
    unknown = F.size(F.array_except(F.map_keys(q), F.transform("joints", lambda j: j["name"]))) > 0
    broken = F.exists(F.map_values(q), lambda v: ~F.coalesce(_finite(v), F.lit(False)))
    rows = both.withColumn("reason", F.when(unknown, "unknown_joint").when(broken, "position")).withColumn("__locals", _locals(c("joints"), q))
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("link"), F.lit(None).cast("array<int>").alias("way")))
    each = rows.select(*positions.columns, "__locals", "reason", F.inline(F.when(c("reason").isNull() | c("ways").isNull(), c("ways")).otherwise(nothing)))
    pose = F.aggregate("way", F.array(*map(F.lit, root)), lambda pose, i: composed(pose, F.get("__locals", i)))
    return each.select(*positions.columns, "link", pose.alias("pose"), "reason")
