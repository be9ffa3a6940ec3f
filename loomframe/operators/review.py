"""Runs under review: completeness, scores of runs, identity decisions, candidate rankings, plans and their bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import depth_agreement, depth_support

c = F.col
#: Decisions of an identity review, channels of a mask archive and its fields by version: fixed values.
DECISIONS = ("accept", "review", "reject")
CHANNELS = ("target_0", "receiver_0", "gripper_left", "gripper_right")
ARCHIVE = ("annotation_status", "format_version", "frame_count", "instance_names", "masks", "qc_status", "roles")
VERSIONS = ("v2", "v3")


def _yes(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def complete(roles: DataFrame, key: str, required: tuple[str, ...] = ("target", "receiver"), every: tuple[str, ...] = ("target", "receiver")) -> DataFrame:
    """Whether a resumed run may skip an episode, from its roles (role, status, qc_status).

    All of ``every`` are there once; required ones are ok and passed, the others not applicable in both.
    """
    needed = c("role").isin(*required)
    fine = F.when(needed, (c("status") == "ok") & (c("qc_status") == "passed")).otherwise((c("status") == "not_applicable") & (c("qc_status") == "not_applicable"))
    mine = roles.where(c("role").isin(*every))
    return roles.select(key).distinct().join(mine.groupBy(key).agg((_yes(F.bool_and(_yes(fine))) & (F.count("*") == len(every)) & (F.count_distinct("role") == len(every))).alias("complete")), key, "left").withColumn("complete", _yes(c("complete")))


def run_scores(roles: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """verified, valid, passed of each run's roles (role, status, qc_status): what candidates for reuse are ranked by."""
    valid, passed = _yes(c("status") == "valid"), _yes(c("qc_status") == "passed")
    applies = ~_yes(c("status") == "not_applicable")
    return roles.where(c("role").isin("target", "receiver")).groupBy(*key).agg(
        ((F.count_if(applies) > 0) & F.bool_and(~applies | (valid & passed))).cast("int").alias("verified"), F.count_if(valid).alias("valid"), F.count_if(valid & passed).alias("passed")
    )


def identity(roles: DataFrame, reviews: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Each role with its review's decision: none, invalid (unknown decision or no reason), or the decision."""
    found = reviews.select(*key, "decision", "reason", F.lit(True).alias("__there"))
    ok = _yes(c("decision").isin(*DECISIONS)) & (F.coalesce(F.trim("reason"), F.lit("")) != "")
    return roles.join(found, list(key), "left").select(*key, F.when(c("__there").isNull(), "none").when(ok, c("decision")).otherwise("invalid").alias("identity"))


def unique_by(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs once, and the keys that occur more often with their number."""
    counted = rows.withColumn("__n", F.count("*").over(Window.partitionBy(key)))
    return counted.where("__n = 1").drop("__n"), rows.groupBy(key).agg(F.count("*").alias("times")).where("times > 1")


def reusable(sources: list[DataFrame], tasks: DataFrame) -> DataFrame:
    """Records by task of several sources, those of other tasks left out: task, times, duplicate, from (the first source)."""
    every = sources[0].select("task", F.lit(0).alias("source"))
    for i, more in enumerate(sources[1:], 1):
        every = every.unionByName(more.select("task", F.lit(i).alias("source")))
    return every.join(tasks.select("task").distinct(), "task", "left_semi").groupBy("task").agg(F.count("*").alias("times"), (F.count("*") > 1).alias("duplicate"), F.min("source").alias("source"))


def collection(records: DataFrame, key: str) -> DataFrame:
    """Tasks of each collection, how many completed and failed; passed if all completed."""
    done = c("status") == "completed"
    return records.groupBy(key).agg(F.count("*").alias("tasks"), F.count_if(done).alias("completed"), F.count_if(c("status") == "failed").alias("failed"), F.bool_and(_yes(done)).alias("passed"))


def checkpoint_counts(records: DataFrame, failures: DataFrame, key: str) -> DataFrame:
    """successful, failed and failure_attempts of each run, as its manifest states them."""
    tried = failures.groupBy(key).agg(F.count("*").alias("failure_attempts"))
    counts = records.groupBy(key).agg(F.count_if(c("status") == "complete").alias("successful"), F.count_if(c("status") == "failed").alias("failed"))
    return counts.join(tried, key, "left").withColumn("failure_attempts", F.coalesce("failure_attempts", F.lit(0)))


def finalized(plans: DataFrame, records: DataFrame, key: str = "episode") -> DataFrame:
    """Every planned episode's final status: what is still pending has failed, as its source never became ready."""
    there = plans.select(key).join(records.select(key, "status"), key, "left")
    pending = F.coalesce("status", F.lit("pending")) == "pending"
    return there.select(key, F.when(pending, "failed").otherwise(c("status")).alias("status"), F.when(pending, "SourceEpisodeUnavailable").alias("error_type"), F.when(pending, "source episode did not become ready").alias("error"))


def failures(errors: DataFrame, key: str, version: str) -> DataFrame:
    """A record of each failure as JSON, and which files it comes with."""
    files = F.array_join(F.array_compact(F.array(F.lit("failure"), F.when(c("prompt").isNotNull(), "rendered_prompt"), F.when(c("response").isNotNull(), "raw_response"))), ",")
    return errors.select(key, F.to_json(F.struct(F.lit(version).alias("format_version"), "error")).alias("record"), files.alias("files"))


def case_list(cases: DataFrame, known: DataFrame, declared: Column) -> DataFrame:
    """What is wrong with each list of cases (list, episode, declared): repeated, count, unknown; null if nothing."""
    # what is counted by itself is held by itself: one task has the known episodes or the distinct ones, not both
    every = cases.groupBy("list").agg(F.count("*").alias("n"), F.count_distinct("episode").alias("distinct"), F.max(declared).alias("declared"))
    unknown = cases.select("list", "episode").join(known.select("episode"), "episode", "left_anti").select(c("list").alias("__list"), F.lit(True).alias("__unknown")).distinct()
    both = every.join(unknown, c("list").eqNullSafe(c("__list")), "left")
    return both.select("list", F.when(c("n") != c("distinct"), "repeated").when(c("n") != c("declared"), "count").when(c("__unknown"), "unknown").alias("reason"))


def planned(episodes: DataFrame, parts: dict[str, DataFrame], key: str = "episode") -> DataFrame:
    """Plans of the episodes that have all parts; each part's digest is taken along, and a second one shows a change meanwhile.

    Parts: (key, digest, digest_now). reason: missing or changed parts, or the frame shapes if these differ; null if fine.
    """
    out = episodes
    for name, rows in parts.items():
        out = out.join(rows.select(key, c("digest").alias(f"__{name}"), c("digest_now").alias(f"__{name}_now")), key, "left")
    missing = F.array_join(F.array_compact(F.array(*(F.when(c(f"__{n}").isNull(), n) for n in parts))), ",")
    changed = F.array_join(F.array_compact(F.array(*(F.when(~c(f"__{n}").eqNullSafe(c(f"__{n}_now")), n) for n in parts))), ",")
    shapes = episodes.agg(F.count_distinct("shape").alias("__shapes"))
    reason = F.when(missing != "", F.concat(F.lit("missing:"), missing)).when(changed != "", F.concat(F.lit("changed:"), changed)).when(c("__shapes") > 1, "shapes")
    return out.join(F.broadcast(shapes)).select(key, reason.alias("reason"))  # one row


def derived(frames: DataFrame, roles: DataFrame, windows: DataFrame, run: str) -> DataFrame:
    """Frames of accepted roles cut to new windows, as rows of another run: run, episode, role, frame, in_window."""
    kept = roles.where("decision <> 'reject'").select("episode", "role")
    cut = frames.join(kept, ["episode", "role"], "left_semi").join(windows, ["episode", "role"])
    return cut.select(F.lit(run).alias("run"), "episode", "role", "frame", c("frame").between(c("start"), c("end")).alias("in_window"))


def payload(objects: DataFrame, grippers: DataFrame, key: str) -> DataFrame:
    """Roles of a public record: the objects' as they are, then the active gripper's, whose review comes from its fit."""
    active = grippers.where("active").select(key, F.concat(F.lit("gripper_"), "arm").alias("role"), F.when(c("fraction") >= 0.9, "valid").otherwise("failed").alias("status"), F.when(c("fraction") >= 0.9, "passed").otherwise("failed").alias("qc_status"))
    return objects.select(key, "role", "status", "qc_status").unionByName(active)


def joint_scores(pixels: DataFrame, tolerance: float = 8.0) -> DataFrame:
    """Depth agreement of every hypothesis (frame, joint, q), over its links 7 and 8 and of each of them."""
    keyed = pixels.withColumn("hypothesis", F.struct("frame", "joint", "q"))
    both = depth_agreement(keyed, "hypothesis", tolerance)
    links = [depth_agreement(keyed.where(c("link") == n), "hypothesis", tolerance).select("hypothesis", c("consistent").alias(f"link{n}")) for n in (7, 8)]
    out = both
    for one in links:
        out = out.join(one, "hypothesis", "left")
    return out.select("hypothesis.*", "rendered", "comparable", "consistent", "fraction", "median_residual", "p90_residual", *(F.coalesce(f"link{n}", F.lit(0)).alias(f"link{n}") for n in (7, 8)))


def finger_rank(scores: DataFrame, temporal: Column, command: Column, most_residual: float | None = None) -> DataFrame:
    """Rank of every hypothesis among those of its frame and joint.

    By viability, consistent pixels, share, median and 90th residual, the weaker link's pixels, nearness to the last
    accepted and to the commanded position (null: no such prior), and the smaller q.
    """
    far = F.lit(float("inf"))
    residual = F.coalesce("median_residual", far)
    viable = F.lit(True) if most_residual is None else residual <= most_residual
    order = (
        viable.desc(), c("consistent").desc(), c("fraction").desc(), residual.asc(), F.coalesce("p90_residual", far).asc(), F.least("link7", "link8").desc(),
        F.coalesce(F.abs(c("q") - temporal), F.lit(0.0)).asc(), F.coalesce(F.abs(c("q") - command), F.lit(0.0)).asc(), c("q").asc(),
    )
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("frame", "joint").orderBy(*order)))


def supported(scores: DataFrame, pixels: int, per_link: int, fraction: float) -> Column:
    """Whether both links of a hypothesis have enough consistent pixels."""
    return depth_support(c("consistent"), c("fraction"), c("median_residual"), pixels, fraction) & (F.least("link7", "link8") >= per_link)


def top_masks(found: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The most probable mask of each frame, the first of equals; masks without a probability count as certain."""
    best = F.min_by(F.struct("index", "mask"), F.struct(-F.coalesce("probability", F.lit(1.0)), c("index")))
    return found.groupBy(*key).agg(best.alias("x")).select(*key, "x.*")


def archive_reason(version: Column, keys: Column, frames: Column, frame_count: Column, channels: Column, pixel_type: Column) -> Column:
    """Why a mask archive is refused: version, keys, frame_count, masks, frames, channels; null if it isn't.

    The format's name ends with its version. The later one also has frame_encoding; an earlier one gets it made when read.
    """
    version = F.regexp_extract(version, r"_(v\d+)$", 1)
    base = F.array(*map(F.lit, ARCHIVE))
    expected = F.when(version == VERSIONS[1], F.array_sort(F.array_append(base, F.lit("frame_encoding")))).otherwise(F.array_sort(base))
    return (
        F.when(~_yes(version.isin(*VERSIONS)), "version").when(~_yes(F.array_sort(keys) == expected), "keys").when(~_yes(frame_count >= 1), "frame_count")
        .when(~_yes(pixel_type == "bool"), "masks").when(~_yes(frames == frame_count), "frames").when(~_yes(channels == F.array(*map(F.lit, CHANNELS))), "channels")
    )


def simple_name(name: Column) -> Column:
    """Whether a run's name is one folder's: not empty, no spaces around it, no separators, no dots that lead out."""
    return _yes((name != "") & (name == F.regexp_replace(name, r"^\s+|\s+$", "")) & ~name.isin(".", "..") & ~name.rlike(r"[/\\]|\.\."))


def inside(path: Column) -> Column:
    """Whether a relative path stays within its folder: at no point more steps up than down."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    level = F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.lit(0).alias("low")), lambda a, s: F.struct((a["at"] + F.when(s == "..", -1).otherwise(1)).alias("at"), F.least(a["low"], a["at"] + F.when(s == "..", -1).otherwise(1)).alias("low")))
    return _yes((F.trim(path) != "") & ~path.startswith("/") & (level["at"] >= 0) & (level["low"] >= 0))
