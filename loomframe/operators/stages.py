"""Results of a stage taken up by later ones: saved roles put together again, and runs derived from them with checks and lineage of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import responses
from . import bitmaps

c = F.col


def rehydrated(manifests: DataFrame, roles: DataFrame, tracks: DataFrame, seeds: DataFrame, expected: DataFrame, required: tuple[str, ...], key: str = "episode") -> DataFrame:
    """Every required role of every expected episode as its stage saved it: key, role, frames, pixels, seed_frame, and reason if it can't be used.

    manifests: (key, task, camera, frame_count); roles: (key, role, status, qc_status, track, seed, seed_frame), track and seed
    naming their masks; tracks: (track, frame, mask); seeds: (seed, mask); expected: (key, task, camera, frames). reason: manifest
    (missing), task, camera, frame_count, role (not exactly one), status (not ok and passed), track (missing), frames (not each
    once), seed_frame (not one of them), seed (missing or empty).
    """
    wanted = expected.select(key, "task", "camera", c("frames").alias("__frames"), F.explode(F.array(*map(F.lit, required))).alias("role"))
    m = manifests.select(key, c("task").alias("__task"), c("camera").alias("__camera"), "frame_count", F.lit(True).alias("__m"))
    one = roles.groupBy(key, "role").agg(F.count("*").alias("__n"), *(F.first(n).alias(n) for n in ("status", "qc_status", "track", "seed", "seed_frame")))
    t = tracks.groupBy("track").agg(F.count("*").alias("frames"), F.count_distinct("frame").alias("__distinct"), F.min("frame").alias("__low"), F.max("frame").alias("__high"), F.sum(bitmaps.area(c("mask"))).alias("pixels"))
    s = seeds.select("seed", (bitmaps.area(c("mask")) > 0).alias("__seed"))
    found = wanted.join(m, key, "left").join(one, [key, "role"], "left").join(t, "track", "left").join(s, "seed", "left")
    whole = (c("frames") == c("__frames")) & (c("__distinct") == c("__frames")) & (c("__low") == 0) & (c("__high") == c("__frames") - 1)
    no = lambda rule: ~F.coalesce(rule, F.lit(False))
    reason = F.coalesce(
        F.when(c("__m").isNull(), "manifest"), F.when(~c("task").eqNullSafe(c("__task")), "task"), F.when(~c("camera").eqNullSafe(c("__camera")), "camera"), F.when(~c("frame_count").eqNullSafe(c("__frames")), "frame_count"),
        F.when(no(c("__n") == 1), "role"), F.when(no((c("status") == "ok") & (c("qc_status") == "passed")), "status"), F.when(c("frames").isNull(), "track"), F.when(no(whole), "frames"),
        F.when(no((c("seed_frame") >= 0) & (c("seed_frame") < c("__frames"))), "seed_frame"), F.when(no(c("__seed")), "seed"),
    )
    judged = found.withColumn("reason", reason)
    return judged.select(key, "role", *(F.when(c("reason").isNull(), c(n)).alias(n) for n in ("frames", "pixels", "seed_frame")), "reason")


def derived_roles(frames: DataFrame, roles: DataFrame, reviews: DataFrame, words: int, run: str, key: str = "episode") -> DataFrame:
    """Roles of another run made from saved tracks: cut to new windows, checked anew, with the review's word and where they come from.

    frames: (key, role, frame, mask), masks of so many words to a row; roles: (key, role, start, end, seed: a mask or null);
    reviews: (key, role, decision, reason). Returns run, key, role, status, failure, frames and pixels that are published,
    qc_status, and source, a digest of the whole track in any order. failure: empty_text_seed, native_track_empty_in_output_window
    (both failed), temporal_qc_quarantine and the issues, identity_qc_reject and the reason (both quarantined). Only what is ok
    publishes pixels.
    """
    both = F.struct(key, "role").alias("episode")
    tracks = frames.join(roles.select(key, "role", "start", "end", c("seed").alias("reference")), [key, "role"])
    qc = bitmaps.temporal_qc(tracks.select(both, "frame", "mask", "start", "end", "reference"), words).select("episode", c("status").alias("qc_status"), "issues")
    inside = c("frame").between(c("start"), c("end"))
    digest = F.sha2(F.concat_ws(":", *(F.sum(F.xxhash64(F.lit(i), c("frame"), F.array_join(F.transform("mask", lambda w: w.cast("string")), ",")).cast("decimal(38,0)")).cast("string") for i in (1, 2))), 256)
    seen = tracks.groupBy(both).agg(
        F.count_if(inside).alias("frames"), F.coalesce(F.sum(F.when(inside, bitmaps.area(c("mask")))), F.lit(0)).alias("pixels"), digest.alias("source"), F.coalesce(F.max(bitmaps.area(c("reference"))), F.lit(0)).alias("__seed"),
    )
    words_of = lambda t: F.array_join(F.filter(F.split(t, r"\s+"), lambda w: w != ""), " ")
    said = reviews.where("decision = 'reject'").select(both, words_of(c("reason")).alias("__why"), F.lit(True).alias("__rejected"))
    every = seen.join(qc, "episode", "left").join(said, "episode", "left")
    failure = (
        F.when(c("__seed") == 0, "empty_text_seed").when(c("pixels") == 0, "native_track_empty_in_output_window").when(c("qc_status") == "quarantine", F.concat(F.lit("temporal_qc_quarantine:"), "issues"))
        .when(c("__rejected"), F.concat(F.lit("identity_qc_reject:"), "__why"))
    )
    status = F.when(c("failure").isNull(), "ok").when(c("failure").startswith("temporal") | c("failure").startswith("identity"), "quarantined").otherwise("failed")
    judged = every.withColumn("failure", failure).withColumn("status", status)
    return judged.select(F.lit(run).alias("run"), f"episode.{key}", "episode.role", "status", "failure", "frames", F.when(c("status") == "ok", c("pixels")).otherwise(0).alias("pixels"), F.when(c("__seed") > 0, c("qc_status")).alias("qc_status"), "source")


def visual_reports(candidates: DataFrame, answers: DataFrame, keys: list[str], most_attempts: int, min_confidence: float) -> DataFrame:
    """What a model's look at a seed's candidates comes to: keys, status, selected, confidence, reason.

    candidates: (keys, candidate, valid); answers: (keys, attempt, answer, error), attempts from 1, an answer or why there was
    none. Without a valid candidate nothing is asked (rejected, basic_checks); the first answer within ``most_attempts`` counts,
    without one the last error does (error, request: and the error); an answer that can't be read is an error (answer: and
    what is wrong); what it says is rejected, ambiguous, or passed, ambiguous too below ``min_confidence`` (confidence). Seeds
    that have answers but no candidates have no row.
    """
    asked = candidates.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(c("valid"), c("candidate")))).alias("__valid"))
    tried = answers.where(c("attempt") <= most_attempts)
    heard = tried.groupBy(*keys).agg(
        F.min_by("answer", F.when(c("answer").isNotNull(), c("attempt"))).alias("__answer"), F.max_by("error", F.when(c("answer").isNull(), c("attempt"))).alias("__error"),
    )
    both = asked.join(heard, keys, "left").withColumn("__c", responses.candidate_choice(c("__answer"), c("__valid")))
    choice, none = c("__c"), F.size("__valid") == 0
    error = F.coalesce(F.when(c("__answer").isNull(), F.concat(F.lit("request:"), F.coalesce("__error", F.lit("none")))), F.concat(F.lit("answer:"), choice["error"]))
    low = choice["confidence"] < min_confidence
    status = F.when(none, "rejected").when(error.isNotNull(), "error").when(choice["decision"] == "reject_all", "rejected").when((choice["decision"] == "ambiguous") | low, "ambiguous").otherwise("passed")
    reason = F.when(none, "basic_checks").when(error.isNotNull(), error).when((choice["decision"] == "accept") & low, "confidence").otherwise(choice["reason"])
    judged = both.select(*keys, status.alias("status"), choice["selected"].alias("__s"), choice["confidence"].alias("__f"), reason.alias("reason"))
    return judged.select(*keys, "status", F.when(c("status") == "passed", c("__s")).alias("selected"), F.when(c("status").isin("passed", "ambiguous") | ((c("status") == "rejected") & (c("reason") != "basic_checks")), c("__f")).alias("confidence"), "reason")
