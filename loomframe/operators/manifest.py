"""Matching manifests, plans, records and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import fatal


def presence(episodes: DataFrame, parts: dict[str, DataFrame], key: str = "episode") -> DataFrame:
    """episodes with the names of the parts that each one lacks."""
    out = episodes.select(key)
    for name, rows in parts.items():
        out = out.join(rows.select(key).distinct().withColumn(f"__{name}", F.lit(True)), key, "left")
    missing = F.array_compact(F.array(*(F.when(F.col(f"__{n}").isNull(), n) for n in parts)))
    return out.select(key, F.array_join(missing, ",").alias("missing"))


def with_default(plans: DataFrame, records: DataFrame, key: str = "episode", status: str = "pending") -> DataFrame:
    """Each plan with its record's status, ``status`` if there is none."""
    return plans.join(records.select(key, "status"), key, "left").withColumn("status", F.coalesce("status", F.lit(status)))


def resume_actions(records: DataFrame, outputs: DataFrame, key: str = "episode") -> DataFrame:
    """What a resumed run does about each episode that has a record or an output."""
    both = records.select(key, "status").join(outputs.select(key, F.lit(True).alias("there")), key, "full_outer")
    there = F.coalesce("there", F.lit(False))
    action = (
        F.when(F.col("status").isNull(), "unknown_output").when((F.col("status") == "completed") & there, "validated_skip").when(F.col("status") == "completed", "error_output_missing")
        .when(there, "crash_recovered").otherwise("run")
    )
    return both.select(key, F.coalesce("status", F.lit("absent")).alias("status"), there.alias("has_output"), action.alias("action"))


def reconcile(old: DataFrame, new: DataFrame, fields: tuple[str, ...], key: str = "episode") -> DataFrame:
    """Differences of two contracts: rows (key, change), change being added, removed or the fields that differ."""
    a, b = (d.select(key, *(F.col(f).alias(f"{f}_{s}") for f in fields), F.lit(True).alias(s)) for d, s in ((old, "a"), (new, "b")))
    both = a.join(b, key, "full_outer")
    differ = F.array_join(F.array_compact(F.array(*(F.when(~F.col(f"{f}_a").eqNullSafe(F.col(f"{f}_b")), f) for f in fields))), ",")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise(differ)
    return both.select(key, change.alias("change")).where("change <> ''")


def fatal_cutoff(records: DataFrame, run: str = "run", order: str = "episode") -> DataFrame:
    """records with later ones of a run marked as not run after a fatal error."""
    before = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.max(fatal(F.col("error"))).over(before), F.lit(False))
    return records.withColumn("status", F.when(stopped, "not_run_after_fatal_cuda").otherwise(F.col("status")))


def lineage(artifacts: DataFrame, key: str) -> DataFrame:
    """Number of artifacts (path, sha256, bytes) of each key, their bytes, and a digest that doesn't depend on order."""
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("path", "sha256", "bytes"))), lambda a: F.concat_ws("|", a["path"], a["sha256"], a["bytes"].cast("string"))), "\n")
    return artifacts.groupBy(key).agg(F.count("*").alias("artifacts"), F.sum("bytes").alias("bytes"), F.sha2(listed, 256).alias("digest"))


def pivot_statuses(records: DataFrame, key: str, categories: tuple[str, ...], total: int | None = None) -> DataFrame:
    """Counts of each category for every key."""
    return records.groupBy(key).agg(*(F.count_if(F.col("status") == c).alias(c) for c in categories), F.count("*").alias("total"))


def selected(candidates: DataFrame, contracts: DataFrame, key: str = "episode") -> DataFrame:
    """Each candidate with outcome accepted, or why its contract (key, frames, task) excludes it."""
    known = contracts.select(key, F.col("frames").alias("__frames"), F.col("task").alias("__task"), F.lit(True).alias("__there"))
    reason = F.when(F.col("__there").isNull(), "no_contract").when(F.col("__task") != F.col("task"), "task").when(F.col("__frames") != F.col("frames"), "frames").otherwise("accepted")
    return candidates.join(known, key, "left").select(*candidates.columns, reason.alias("outcome"))


def agreement(base: DataFrame, others: dict[str, DataFrame], key: str, fields: tuple[str, ...]) -> DataFrame:
    """For each key the stages that lack it or differ in a field, as ``stage:field``; empty if all agree."""
    out = base.select(key, *fields)
    for name, rows in others.items():
        out = out.join(rows.select(key, *(F.col(f).alias(f"__{name}_{f}") for f in fields), F.lit(True).alias(f"__{name}")), key, "left")
    differ = [F.when(F.col(f"__{n}").isNull(), f"{n}:missing") for n in others]
    differ += [F.when(F.col(f"__{n}").isNotNull() & ~F.col(f).eqNullSafe(F.col(f"__{n}_{f}")), f"{n}:{f}") for n in others for f in fields]
    return out.select(key, F.array_join(F.array_sort(F.array_compact(F.array(*differ))), ",").alias("reasons"))


def preflight(issues: list[DataFrame], key: str = "episode") -> DataFrame:
    """All issues (key, issue) of each key in one row, sorted."""
    every = issues[0].select(key, "issue")
    for more in issues[1:]:
        every = every.unionByName(more.select(key, "issue"))
    return every.groupBy(key).agg(F.count("*").alias("issues"), F.array_join(F.array_sort(F.collect_set("issue")), ",").alias("kinds"))


def bank(text_rows: DataFrame, box_rows: DataFrame, key: str = "episode") -> DataFrame:
    """Text candidates, and box candidates of keys without a valid text one; lettered in order of method and seed."""
    served = text_rows.where("valid").select(key).distinct()
    every = text_rows.select("*", F.lit(0).alias("__m")).unionByName(box_rows.join(served, key, "left_anti").select("*", F.lit(1).alias("__m")))
    at = F.row_number().over(Window.partitionBy(key).orderBy("__m", "seed"))
    return every.withColumn("candidate", F.char(64 + at)).drop("__m")


def composed(objects: DataFrame, active: DataFrame) -> DataFrame:
    """Mask channels (episode, channel, frame, mask) with both gripper channels (2, 3) replaced by the active one's."""
    return objects.where("channel < 2").unionByName(active)
