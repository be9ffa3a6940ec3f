"""Tables that are published as a whole: staged, checked, and committed by one list of partitions.

A root has ``data/__stage=.../__name=.../keys...`` and ``commits/version=N``. A commit is one file that names, for every table and
partition, the stage that holds it, with its receipt. Readers follow the last commit, so that a publication that stops
anywhere before its commit leaves everything as it was. Two that commit the same version can't both: the second fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "version long, name string, stage string, partition string, rows long, digest string"


class Rejected(ValueError):
    """What was staged isn't what it should be; nothing was committed."""


def _key(keys: Sequence[str]) -> F.Column:
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("partition")


def receipts(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """partition, rows and a digest of each partition's rows, in whatever order they are."""
    row = F.to_json(F.struct(*sorted(c for c in frame.columns)), {"ignoreNullFields": "false"})
    parts = [F.sum(F.xxhash64(F.lit(i), row).cast("decimal(38,0)")).cast("string") for i in (1, 2)]
    return frame.groupBy(_key(keys)).agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(":", *parts), 256).alias("digest"))


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All commits of a root; none where nothing was published."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def version(spark: SparkSession, root: str) -> int:
    """The last commit's number, 0 before the first."""
    return commits(spark, root).agg(F.max("version")).first()[0] or 0


def stage(tables: dict[str, DataFrame], root: str, keys: Sequence[str]) -> str:
    """Write tables where no reader looks, partitioned by their keys; returns the stage's name."""
    name = uuid.uuid4().hex
    for table, frame in tables.items():
        frame.write.partitionBy(*keys).parquet(f"{root}/data/__stage={name}/__name={table}")
    return name


def staged(spark: SparkSession, root: str, name: str, table: str, like: DataFrame) -> DataFrame:
    """What was staged of a table, columns and types as in ``like``."""
    read = spark.read.schema(like.schema).parquet(f"{root}/data/__stage={name}/__name={table}")
    return read.select(*like.columns)


def check(spark: SparkSession, tables: dict[str, DataFrame], root: str, name: str, keys: Sequence[str], rules: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Receipts (name, partition, rows, digest) of a stage that holds what it should and keeps every table's rules.

    A rule turns a table into its violations. Raises ``Rejected`` with the first ones.
    """
    found = None
    for table, frame in tables.items():
        there = staged(spark, root, name, table, frame)
        seen, wanted = receipts(there, keys), receipts(frame, keys)
        odd = wanted.exceptAll(seen).union(seen.exceptAll(wanted)).select("partition").limit(3).collect()
        broken = rules[table](there).limit(3).collect() if table in rules else []
        if odd or broken:
            raise Rejected(f"{table}: {[*(r[0] for r in odd), *broken]}")
        part = seen.select(F.lit(table).alias("name"), "partition", "rows", "digest")
        found = part if found is None else found.union(part)
    return found


def commit(spark: SparkSession, root: str, name: str, made: DataFrame, base: int) -> int:
    """Make a checked stage's partitions take the place of those of the same keys in version ``base``; returns the new version."""
    before = commits(spark, root).where(F.col("version") == base)
    kept = before.join(made.select("name", "partition"), ["name", "partition"], "left_anti").select("name", "stage", "partition", "rows", "digest")
    rows = kept.unionByName(made.select("name", F.lit(name).alias("stage"), "partition", "rows", "digest"))
    # one file, which shows at once or not at all
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{root}/commits/version={base + 1}")
    return base + 1


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, keys: Sequence[str], rules: dict[str, Callable[[DataFrame], DataFrame]] | None = None, resume: bool = False) -> int:
    """Stage, check and commit tables that belong together; returns the version that holds them.

    With ``resume`` partitions that are published with the same receipt already are left out; if that leaves nothing, there
    is no new version. Null keys are partitions of their own.
    """
    base = version(spark, root)
    if resume:
        old = commits(spark, root).where(F.col("version") == base).select("name", "partition", "rows", "digest")
        left = {}
        for table, frame in tables.items():
            new = receipts(frame, keys).join(old.where(F.col("name") == table).drop("name"), ["partition", "rows", "digest"], "left_anti").select("partition")
            left[table] = frame.withColumn("__partition", _key(keys)).join(new.withColumnRenamed("partition", "__partition"), "__partition", "left_semi").drop("__partition")
        tables = {t: f for t, f in left.items() if f.limit(1).count()}
        if not tables:
            return base
    name = stage(tables, root, keys)
    return commit(spark, root, name, check(spark, tables, root, name, keys, rules or {}), base)


def published(spark: SparkSession, root: str, table: str, like: DataFrame, keys: Sequence[str], at: int | None = None) -> DataFrame:
    """A table's rows as of a version, the last one by default; columns and types as in ``like``."""
    at = version(spark, root) if at is None else at
    now = commits(spark, root).where((F.col("version") == at) & (F.col("name") == table)).select(F.col("stage").alias("__stage"), F.col("partition").alias("__partition"))
    if not now.limit(1).count():
        return spark.createDataFrame([], like.schema)
    schema = like.select(*(c for c in like.columns if c not in keys)).schema.add("__stage", "string").add("__name", "string")
    for key in keys:
        schema = schema.add(like.schema[key])
    rows = spark.read.schema(schema).parquet(f"{root}/data").where(F.col("__name") == table)
    return rows.withColumn("__partition", _key(keys)).join(now, ["__stage", "__partition"], "left_semi").select(*like.columns)


def history(spark: SparkSession, root: str) -> DataFrame:
    """version, name, partitions and rows of all commits."""
    return commits(spark, root).groupBy("version", "name").agg(F.count("*").alias("partitions"), F.sum("rows").alias("rows"))


def unused(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Folders of stages that none of the last ``keep`` versions refers to: left by what stopped, or replaced since."""
    last = version(spark, root)
    used = {r[0] for r in commits(spark, root).where(F.col("version") > last - keep).select("stage").distinct().collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = [s.getPath().getName().removeprefix("__stage=") for s in system.listStatus(path)] if system.exists(path) else []
    return sorted(f"{root}/data/__stage={s}" for s in there if s not in used)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the folders of ``unused``; run when nothing is being published."""
    gone = unused(spark, root, keep)
    for folder in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone
