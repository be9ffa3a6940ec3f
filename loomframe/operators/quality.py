"""Gates, verdicts and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Statuses after which a run has failed: fixed values of the run records.
FAILED = ("failed", "sam_incomplete", "gripper_incomplete", "not_run_after_fatal_cuda", "render_failed")

#: Statuses by category, and marks of errors after which a device can't be used: fixed values.
SUCCESS = ("complete", "completed", "ok", "passed", "rendered", "succeeded", "success", "validated")
SKIPPED = ("dataset_excluded", "discovery_skipped", "planned", "skipped", "skipped_complete", "source_excluded")
RUNNING = ("in_progress", "processing", "running")
PENDING = ("pending", "queued", "ready", "waiting")
FATAL = ("cuda is unavailable", "cuda error", "cuda-capable device", "cuda initialization", "device-side assert", "unspecified launch failure", "failed to load sam3")


def mechanical_gate(area: Column, low: float, high: float, duplicate_of: Column) -> Column:
    """First reason against a candidate, in order: empty, too small, too large, duplicate; else valid."""
    return F.when(area <= 0, "empty").when(area < low, "too_small").when(area > high, "too_large").when(duplicate_of.isNotNull(), "duplicate").otherwise("valid")


def seed_gate(c: dict[str, Column], pixels: int = 24, dark: float = 0.8, components: int = 3, largest: float = 0.8, tcp: float = 20.0) -> Column:
    """All reasons against a seed, joined by commas; empty if there is none. A null measure counts against it."""

    def unless(ok: Column, name: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), name)

    reasons = [
        unless(c["pixels"] >= pixels, "pixels"), unless(c["dark"] >= dark, "dark"), unless(c["components"] <= components, "components"),
        unless(c["largest"] >= largest, "largest"), unless(c["tcp"] <= tcp, "tcp"),
    ]
    return F.concat_ws(",", *reasons)


def status_category(status: Column) -> Column:
    """A run status as one of success, skipped, not_run, running, pending, failed."""
    s = F.translate(F.lower(F.regexp_replace(F.coalesce(status, F.lit("")), r"^\s+|\s+$", "")), "- ", "__")
    return (
        F.when(s.isin(*SUCCESS), "success").when(s.isin(*SKIPPED) | s.startswith("skipped_"), "skipped").when((s == "not_run") | s.startswith("not_run_"), "not_run")
        .when(s.isin(*RUNNING), "running").when(s.isin(*PENDING) | (s == ""), "pending").otherwise("failed")
    )


def fatal(error: Column) -> Column:
    """Whether an error leaves the device unusable."""
    return F.coalesce(F.greatest(*(F.contains(F.lower(error), F.lit(m)) for m in FATAL)), F.lit(False))


def verdicts(records: DataFrame, key: str = "run") -> DataFrame:
    """passed: no record of the run failed."""
    return records.groupBy(key).agg(F.count("*").alias("records"), F.count_if(F.col("status").isin(*FAILED)).alias("failures"), (~F.bool_or(F.col("status").isin(*FAILED))).alias("passed"))


def ladder(attempts: DataFrame) -> DataFrame:
    """The attempt that each episode stops at: text before box, by seed, the first that passed or erred.

    Without one, the last with a valid candidate, else the last; tried counts the attempts up to the stop.
    """
    order = Window.partitionBy("episode").orderBy(F.when(F.col("method") == "text", 0).otherwise(1), "seed")
    ranked = attempts.withColumn("at", F.row_number().over(order))
    stop = ranked.groupBy("episode").agg(
        F.min(F.when(F.col("status").isin("passed", "error"), F.col("at"))).alias("stop"), F.max(F.when(F.col("valid"), F.col("at"))).alias("valid_at"), F.max("at").alias("last")
    )
    chosen = stop.select("episode", F.coalesce("stop", "valid_at", "last").alias("at"), F.coalesce("stop", "last").alias("tried"))
    return ranked.join(chosen, ["episode", "at"]).select("episode", "method", "seed", "status", "valid", "tried")


def fallback_seed(candidates: DataFrame, key: str = "frame") -> DataFrame:
    """The best candidate of each group when none passes: valid, pixels, largest part, dark, fewest parts, nearest."""
    far = F.coalesce(F.nullif("tcp", F.lit(0.0)), F.lit(1e9))
    best = [F.col("valid").desc(), *(F.coalesce(c, F.lit(0)).desc() for c in ("pixels", "largest", "dark")), F.coalesce("components", F.lit(0)).asc(), far.asc(), F.col("id").asc()]
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*best))).where("rank = 1").drop("rank")


def best_run(runs: DataFrame, key: str, *by: str) -> DataFrame:
    """One row for each key: the largest by the columns in turn, the smallest episode among equals."""
    order = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in by), F.col("episode").asc())
    return runs.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def measured(depth: Column) -> Column:
    """Whether a depth is a finite number above 0."""
    return F.coalesce((depth > 0) & (depth < float("inf")), F.lit(False))


def depth_agreement(pixels: DataFrame, key: str, tolerance: float = 8.0) -> DataFrame:
    """Counts, share and residuals of rendered against scene depth; pixels without a rendered depth don't count."""
    drawn = measured(F.col("rendered"))
    ok = drawn & measured(F.col("scene"))
    residual = F.col("rendered") - F.col("scene")
    near = ok & (F.abs(residual) <= tolerance)
    of = lambda c, q: F.percentile(F.when(ok, c), F.lit(q))
    return pixels.groupBy(key).agg(
        F.count_if(drawn).alias("rendered"), F.count_if(ok).alias("comparable"), F.count_if(near).alias("consistent"),
        F.round(F.coalesce(F.try_divide(F.count_if(near), F.count_if(ok)), F.lit(0.0)), 6).alias("fraction"), F.round(of(F.abs(residual), 0.5), 6).alias("median_residual"),
        F.round(of(F.abs(residual), 0.9), 6).alias("p90_residual"), F.round(of(residual, 0.5), 6).alias("signed_median"),
        F.count_if(ok & (residual < -tolerance)).alias("in_front"), F.count_if(ok & (residual > tolerance)).alias("behind"),
    )


def depth_support(pixels: Column, fraction: Column, residual: Column, least_pixels: int, least_fraction: float, most_residual: float | None = None) -> Column:
    """Whether a depth agreement carries enough: consistent pixels, their share, and, if asked for, the median residual."""
    enough = (pixels >= least_pixels) & (fraction >= least_fraction)
    return F.coalesce(enough if most_residual is None else enough & (F.coalesce(residual, F.lit(float("inf"))) <= most_residual), F.lit(False))


def below(rows: DataFrame, share: Column, least: float) -> DataFrame:
    """Rows whose share isn't a number or lies below ``least``: violations of a threshold."""
    return rows.where(share.isNotNull() & (F.isnan(share) | (share < least)))
