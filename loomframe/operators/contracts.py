"""What runs agree on: plans that a resumed run must keep, datasets and recordings that may be used, queries repaired, channels composed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

c = F.col

# --- plans


def plan_violations(old: DataFrame, expected: DataFrame, records: DataFrame, outputs: DataFrame, run: str = "run", key: str = "episode") -> DataFrame:
    """Why a run can't go on with its contract: rows (run, key, reason), none if it can.

    old: plans recorded so far (run, key, position, digest); expected: those of all declared episodes (run, key, place,
    digest); records (run, key, status); outputs (run, key). An old plan may be undeclared, repeated, out of order (not after
    all before it) or changed; a plan may be absent only while its record is pending and nothing is published: unplanned,
    published.
    """
    places = expected.select(run, key, "place", c("digest").alias("__digest"))
    before = Window.partitionBy(run).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(run, key).orderBy("position")
    known = old.join(places, [run, key], "left").withColumn("__nth", F.row_number().over(same)).withColumn("__high", F.max("place").over(before))
    wrong = F.when(c("place").isNull(), "undeclared").when(c("__nth") > 1, "repeated").when(c("place") <= c("__high"), "order").when(~c("digest").eqNullSafe(c("__digest")), "changed")
    absent = expected.select(run, key).join(old.select(run, key).distinct(), [run, key], "left_anti").join(records.select(run, key, "status"), [run, key], "left")
    absent = absent.join(outputs.select(run, key).distinct().withColumn("__out", F.lit(True)), [run, key], "left")
    why = F.when(~c("status").eqNullSafe("pending"), "unplanned").when(c("__out"), "published")
    return known.select(run, key, wrong.alias("reason")).unionByName(absent.select(run, key, why.alias("reason"))).where("reason is not null")


CATEGORIES = ("success", "failed", "skipped", "running", "not_run")


def dashboard(records: DataFrame, totals: DataFrame, key: str = "run") -> DataFrame:
    """For each key the records of each category, the total (declared or seen, whichever is more) and how many remain.

    records: (key, category); totals: (key, total). A category of its own, such as pending, only counts as remaining.
    """
    counts = records.groupBy(key).agg(*(F.count_if(c("category") == n).alias(n) for n in CATEGORIES), F.count("*").alias("__seen"))
    both = totals.select(key, "total").join(counts, key, "full_outer").na.fill(0, [*CATEGORIES, "__seen", "total"])
    total = F.greatest("total", "__seen")
    return both.select(key, total.alias("total"), *CATEGORIES, F.greatest(F.lit(0), total - sum((c(n) for n in CATEGORIES), F.lit(0))).alias("remaining"))


# --- datasets and recordings

_MANIFEST = "profile string, task string, camera string, episode_indices array<string>, datasets array<struct<task: string>>"


def resolved_datasets(manifests: DataFrame, mode: str, task: str | None = None) -> DataFrame:
    """root, part, task, camera, episodes, reason: what a manifest (root, value: JSON) or the parts of a collection give.

    A part's manifest is that of root/task. reason: json, profile, datasets (none), names (a part without a plain name),
    repeated (parts), absent (the task that was asked for), part (its manifest is missing), then of each part profile, task,
    camera, episodes (none), numbers, repeated_episodes. Collections give a row for each part in order of names, or one with
    their reason.
    """
    m = manifests.select("root", "value", F.from_json("value", _MANIFEST).alias("m"))
    read = m.select("root", "m.*", F.coalesce(F.get_json_object("value", "$.datasets").isNotNull(), F.lit(False)).alias("many"), F.coalesce(F.schema_of_variant(text.whole_json(c("value"))).startswith("OBJECT"), F.lit(False)).alias("ok"))
    numbers = F.transform("episode_indices", lambda e: F.when(e.rlike(r"^-?\d+$"), e.try_cast("bigint")))
    own = F.coalesce(
        F.when(~c("ok"), "json"), F.when(~c("profile").eqNullSafe(mode), "profile"), F.when(F.coalesce(c("task"), F.lit("")) == "", "task"), F.when(F.coalesce(c("camera"), F.lit("")) == "", "camera"),
        F.when(F.coalesce(F.size("episode_indices"), F.lit(0)) == 0, "episodes"), F.when(F.exists(numbers, lambda e: e.isNull()), "numbers"), F.when(F.size(F.array_distinct(numbers)) < F.size(numbers), "repeated_episodes"),
    )
    single = read.where(~c("many")).select("root", "task", "camera", numbers.alias("episodes"), own.alias("reason"))
    asked = F.when((c("reason").isNull()) & (c("task") != task), "absent") if task is not None else F.lit(None).cast("string")
    names = F.transform("datasets", lambda d: d["task"])
    plain = lambda n: n.isNotNull() & ~n.isin("", ".", "..") & ~n.contains("/")
    refused = F.coalesce(
        F.when(~c("profile").eqNullSafe(mode), "profile"), F.when(F.coalesce(F.size("datasets"), F.lit(0)) == 0, "datasets"), F.when(~F.forall(names, plain), "names"),
        F.when(F.size(F.array_distinct(names)) < F.size(names), "repeated"), F.when(~F.array_contains(names, task), "absent") if task is not None else F.lit(None).cast("string"),
    )
    chosen = F.when(refused.isNull(), names if task is None else F.array(F.lit(task))).otherwise(F.array(F.lit(None).cast("string")))
    parts = read.where("many").select("root", refused.alias("refused"), F.explode(chosen).alias("part")).withColumn("__at", F.concat_ws("/", "root", "part"))
    below = single.select(c("root").alias("__at"), "task", "camera", "episodes", "reason", F.lit(True).alias("__there"))
    found = parts.join(below, "__at", "left").select("root", "part", "task", "camera", "episodes", F.coalesce("refused", F.when(c("__there").isNull(), "part"), "reason").alias("reason"))
    children = parts.select(c("__at").alias("root")).distinct()
    alone = single.join(children, "root", "left_anti").select("root", F.lit(None).cast("string").alias("part"), "task", "camera", "episodes", F.coalesce("reason", asked).alias("reason"))
    every = found.unionByName(alone)
    return every.select("root", "part", *(F.when(c("reason").isNull(), c(n)).alias(n) for n in ("task", "camera", "episodes")), "reason")


def candidate_recordings(arms: DataFrame, recordings: DataFrame, files: DataFrame, parts: tuple[str, ...], key: str, single_loop: bool = False) -> DataFrame:
    """Shape and arm of the recordings that may be used: their geometry is valid and all their parts are there.

    arms: as for ``timeline.shapes``; recordings: (key, geometry_valid and whatever is to be kept); files: (key, part). With
    ``single_loop`` recordings without a loop are left out.
    """
    from .timeline import shapes

    there = files.where(c("part").isin(*parts)).groupBy(key).agg(F.count_distinct("part").alias("__parts")).where(c("__parts") == len(parts)).select(key)
    usable = recordings.where("geometry_valid").join(there, key, "left_semi").join(shapes(arms, key), key)
    return usable.where("shape = 'pick_place'") if single_loop else usable


def composite(episodes: DataFrame, detected: DataFrame, given: DataFrame, key: str = "episode") -> DataFrame:
    """Events and active window of each episode: those given, else those detected; with origin and reason.

    episodes: (key, frames, missing: parts that aren't there); detected: the five events (null where there is no loop); given:
    five events, those of opening null for one that only holds, and start and end of its window, both or neither. reason:
    missing, together (events without a window or the other way round), none, window (not within the frames), close_end
    (beyond the frames), hold (doesn't last to the end), loop (window and events differ).
    """
    names = ("move_start", "close_start", "close_done", "open_start", "open_done")
    g = given.select(key, *(c(n).alias(f"__{n}") for n in names), "start", "end")
    both = episodes.join(detected.select(key, *names), key, "left").join(g, key, "left")
    has_events, has_window = c("__move_start").isNotNull(), c("__window")
    both = both.withColumn("__window", c("start").isNotNull() & c("end").isNotNull())
    taken = both.withColumns({n: F.when(has_events, c(f"__{n}")).when(c("open_done").isNotNull(), c(n)) for n in names})
    taken = taken.withColumns({"start": F.when(has_events, c("start")).otherwise(c("move_start")), "end": F.when(has_events, c("end")).otherwise(c("open_done"))})
    holds = has_events & c("open_done").isNull()
    reason = (
        F.when(F.coalesce(c("missing"), F.lit("")) != "", "missing").when(has_events != has_window, "together").when(c("move_start").isNull(), "none")
        .when((c("start") < 0) | (c("end") < c("start")) | (c("end") >= c("frames")), "window").when(holds & (c("close_done") >= c("frames")), "close_end")
        .when(holds & ((c("start") != c("move_start")) | (c("end") != c("frames") - 1)), "hold").when(~holds & ((c("start") != c("move_start")) | (c("end") != c("open_done"))), "loop")
    )
    judged = taken.withColumn("origin", F.when(has_events, "recorded").when(c("move_start").isNotNull(), "detected")).withColumn("reason", reason)
    return judged.select(key, *(F.when(c("reason").isNull(), c(n)).alias(n) for n in (*names, "start", "end", "origin")), "reason")


# --- queries and frames for a review


def capped_queries(queries: Column, most: int, prior: Column) -> Column:
    """The first queries of a role, one slot kept for a prior region where there is one and ``most`` allows two."""
    return F.slice(queries, 1, F.when(F.coalesce(prior, F.lit(False)) & F.lit(most >= 2), most - 1).otherwise(F.lit(most)))


def context_frames(evidence: Column, seeds: Column) -> Column:
    """Two frames beside the seed, ascending: first and last of those that show the action, then of those that may be seeds too."""
    ends = lambda a: F.when(F.size(a) <= 2, a).otherwise(F.array(F.get(a, 0), F.get(a, F.size(a) - 1)))
    more = F.when(F.size(evidence) == 0, ends(seeds)).when(F.size(evidence) == 1, F.slice(seeds, 1, 1)).otherwise(F.slice(seeds, 1, 0))
    return F.array_sort(F.array_distinct(F.concat(ends(evidence), more)))


def repaired_bank(rows: DataFrame, fields: tuple[str, ...], order: str, keeper: str, last: str) -> DataFrame:
    """``rows`` with bank (map of field to query, repeated queries with one field only), order as repaired, and reason.

    Queries that are equal but for white space stay with ``keeper`` if it has them, else with the field that comes first in
    the order, then among fields. The order names each field with a query once, fields left out are added behind, ``last``
    comes last. reason: unknown (fields in the order), repeated (fields in the order).
    """
    listed = F.array(*map(F.lit, fields))
    plain = lambda v: F.array_join(F.filter(F.split(v, r"\s+"), lambda w: w != ""), " ")
    stated = F.transform(order, plain)
    rank = lambda f: F.when(F.array_contains("__stated", f), F.array_position("__stated", f)).otherwise(F.size("__stated") + 1)
    entry = lambda f: F.struct(plain(c(f)).alias("query"), rank(F.lit(f)).alias("rank"), F.lit(fields.index(f)).alias("at"), F.lit(f).alias("field"))
    filled = rows.withColumn("__stated", stated).withColumn("__all", F.filter(F.array(*(F.when(c(f).isNotNull(), entry(f)) for f in fields)), lambda e: e.isNotNull()))
    place = lambda e: F.struct((e["field"] != keeper).alias("k"), e["rank"].alias("r"), e["at"].alias("at"), e["field"].alias("field"))
    first = lambda q: F.array_min(F.transform(F.filter("__all", lambda e: e["query"] == q), place))["field"]
    owned = filled.withColumn("__owner", F.map_from_entries(F.transform("__all", lambda e: F.struct(e["field"], first(e["query"])))))
    kept = F.filter("__all", lambda e: F.try_element_at("__owner", e["field"]) == e["field"])
    bank = F.map_from_entries(F.transform(kept, lambda e: F.struct(e["field"], c_value(fields, e["field"]))))
    renamed = F.array_distinct(F.transform("__stated", lambda f: F.coalesce(F.try_element_at("__owner", f), f)))
    there = F.transform(kept, lambda e: e["field"])
    whole = F.concat(F.filter(renamed, lambda f: F.array_contains(there, f)), F.array_except(there, renamed))
    tail = F.when(F.array_contains(whole, last), F.array_append(F.array_remove(whole, last), F.lit(last))).otherwise(whole)
    reason = F.when(F.size(F.array_distinct("__stated")) < F.size("__stated"), "repeated").when(F.size(F.array_except("__stated", listed)) > 0, "unknown")
    judged = owned.withColumn("reason", reason)
    out = judged.withColumns({"bank": F.when(c("reason").isNull(), bank), "order": F.when(c("reason").isNull(), tail)})
    return out.drop("__stated", "__all", "__owner")


def c_value(fields: tuple[str, ...], field: Column) -> Column:
    """A row's value of the column that ``field`` names."""
    return F.coalesce(*(F.when(field == f, c(f)) for f in fields))


# --- channels


def composed_channels(frames: DataFrame, track: DataFrame, active: DataFrame, key: str = "episode") -> DataFrame:
    """Four channels of every episode with the gripper's track in its arm's one: key, channel, frame, mask, code, status, qc_status.

    frames: (key, channel, frame, mask, code, status, qc_status) of an archive, track: (key, frame, mask), active: (key, arm).
    Both gripper channels are emptied; the active one's frames are visible where they have pixels and its status is valid,
    the other one isn't annotated; QC wasn't run. Frames that the track doesn't have are empty. An episode without an arm
    keeps its objects only.
    """
    empty = lambda m: F.transform(m, lambda _: F.lit(0).cast("bigint"))
    objects, grippers = frames.where("channel < 2"), frames.where("channel >= 2").join(active.select(key, "arm"), key)
    here = c("channel") == F.when(c("arm") == "left", 2).otherwise(3)
    found = grippers.join(track.select(key, "frame", c("mask").alias("__track")), [key, "frame"], "left").withColumn("mask", F.when(here & c("__track").isNotNull(), c("__track")).otherwise(empty("mask")))
    code = F.when(F.exists("mask", lambda w: w != 0), 1).otherwise(0)
    made = found.select(key, "channel", "frame", "mask", code.alias("code"), F.when(here, "valid").otherwise("not_annotated").alias("status"), F.lit("not_run").alias("qc_status"))
    return objects.select(*made.columns).unionByName(made)


def composition_differences(composed: DataFrame, frames: DataFrame, key: str = "episode") -> DataFrame:
    """Object rows (channel, frame) of an archive that a composition has otherwise, in either direction."""
    of = lambda d: d.where("channel < 2").select(key, "channel", "frame", "mask", "code")
    return of(composed).exceptAll(of(frames)).unionByName(of(frames).exceptAll(of(composed))).select(key, "channel", "frame").distinct()


def all_records(**kinds: DataFrame) -> DataFrame:
    """Records of all kinds (skipped, excluded, results, failures) below each other, with their kind; fields that one lacks are null."""
    every = None
    for kind, rows in kinds.items():
        named = rows.withColumn("kind", F.lit(kind))
        every = named if every is None else every.unionByName(named, allowMissingColumns=True)
    return every


# --- digests


def canonical_json(value: Column, without: str | None = None) -> Column:
    """A JSON object with sorted keys and no spaces, as digests are taken of; null for what isn't an object. ``without`` a key."""
    entries = F.from_json(value, "map<string,variant>")
    keys = F.array_sort(F.filter(F.map_keys(entries), lambda k: k != F.lit(without)) if without else F.map_keys(entries))
    quoted = lambda k: F.concat(F.lit('"'), F.regexp_replace(k, r'(["\\])', r"\\$1"), F.lit('"'))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(quoted(k), F.lit(":"), F.coalesce(F.to_json(F.element_at(entries, k)), F.lit("null")))), ","), F.lit("}"))


def self_hash_reason(value: Column, key: str) -> Column:
    """Why a record that carries its own digest isn't as it was written: json, none (no digest of 64 digits), changed; null if it is."""
    stated = F.get_json_object(value, f"$.{key}")
    body = canonical_json(value, key)
    return F.when(body.isNull(), "json").when(F.coalesce(F.length(stated), F.lit(0)) != 64, "none").when(F.sha2(body, 256) != stated, "changed")
