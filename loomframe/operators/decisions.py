"""Ladders of decisions over joined stages, and checks of what stages record about each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(*rules: tuple[str, Column], otherwise: str = "ok") -> Column:
    """Name of the first rule that holds; a null counts as no."""
    out = F.lit(otherwise)
    for name, rule in reversed(rules):
        out = F.when(F.coalesce(rule, F.lit(False)), name).otherwise(out)
    return out


def all_reasons(*rules: tuple[str, Column]) -> Column:
    """Names of all rules that hold, joined by commas."""
    return F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules))), ",")


def role_verdict(seed_area: Column, track_area: Column, temporal: Column, decision: Column) -> Column:
    """A role's status: empty seed, empty track, quarantine, rejected identity, ok."""
    return first_reason(("empty_seed", seed_area <= 0), ("empty_track", track_area <= 0), ("quarantined", temporal == "quarantine"), ("identity_rejected", decision == "reject"))


def publication(statuses: DataFrame, key: str) -> DataFrame:
    """Status of each publication from its roles': not_applicable, completed, quarantined, failed, incomplete."""
    applies = F.col("status") != "not_applicable"
    any_of = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    fold = (
        F.when(F.count_if(applies) == 0, "not_applicable").when(F.bool_and(~applies | (F.col("status") == "valid")), "completed")
        .when(any_of("quarantined"), "quarantined").when(any_of("failed"), "failed").otherwise("incomplete")
    )
    return statuses.groupBy(key).agg(fold.alias("publication"))


def reviewed(decision: Column, confidence: Column, error: Column, least: float = 0.7) -> Column:
    """Outcome of a visual review: error, rejected, ambiguous (also below ``least``), passed."""
    return first_reason(("error", error.isNotNull() | decision.isNull()), ("rejected", decision == "reject"), ("ambiguous", (decision != "accept") | (confidence < least) | confidence.isNull()), otherwise="passed")


def subset_violations(frames: DataFrame) -> DataFrame:
    """Frames whose masks break visible within consistent within evaluable within amodal."""
    outside = lambda a, b: F.col(a).bitwiseAND(F.bitwise_not(F.col(b))) != 0
    broken = all_reasons(("visible", outside("visible", "consistent")), ("consistent", outside("consistent", "evaluable")), ("evaluable", outside("evaluable", "amodal")))
    return frames.withColumn("broken", broken).where("broken <> ''")


def quality_summary(joints: DataFrame, key: str) -> DataFrame:
    """Counts and shares of eligible and non-empty frames, accepted components, and the largest joint jump."""
    eligible, filled = F.col("eligible"), F.col("visible") > 0
    return joints.groupBy(key).agg(
        F.count("*").alias("frames"), F.count_if(eligible).alias("eligible"), F.count_if(eligible & filled).alias("eligible_nonempty"),
        F.round(F.coalesce(F.try_divide(F.count_if(eligible & filled), F.count_if(eligible)), F.lit(0.0)), 6).alias("fraction"), F.sum("visible").alias("visible"),
        F.count_if("accepted").alias("accepted"), F.round(F.max("jump"), 6).alias("max_jump"),
    )


def stored_differences(stored: DataFrame, fresh: DataFrame, key: str, numbers: tuple[str, ...], tolerance: float = 1e-12) -> DataFrame:
    """Keys whose stored numbers aren't those found anew, or that only one side has."""
    both = stored.select(key, *(F.col(n).alias(f"{n}_a") for n in numbers), F.lit(1).alias("a")).join(fresh.select(key, *(F.col(n).alias(f"{n}_b") for n in numbers), F.lit(1).alias("b")), key, "full_outer")
    differs = [(n, ~(F.col(f"{n}_a").eqNullSafe(F.col(f"{n}_b")) | (F.abs(F.col(f"{n}_a") - F.col(f"{n}_b")) <= tolerance))) for n in numbers]
    reasons = F.when(F.col("a").isNull(), "not_stored").when(F.col("b").isNull(), "not_found").otherwise(all_reasons(*((n, F.coalesce(d, F.lit(True))) for n, d in differs)))
    return both.select(key, reasons.alias("differs")).where("differs <> ''")
