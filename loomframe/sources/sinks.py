"""Writing results: once only, by partition, and with receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with sorted keys, nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def write_once(new: DataFrame, old: DataFrame, key: str, content: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows to append, and conflicts: keys that are there already with other contents."""
    a = new.withColumn("__new", canonical(*content))
    b = old.select(key, canonical(*content).alias("__old"))
    both = a.join(b, key, "left")
    return both.where("__old is null").drop("__new", "__old"), both.where("__old <> __new").select(key)


def publish(frame: DataFrame, path: str, *partition: str) -> None:
    """Replace the partitions that the rows belong to, and no others, when the whole job has succeeded."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def receipts(frame: DataFrame, key: str, content: tuple[str, ...]) -> DataFrame:
    """A receipt for each row: its key and the digest of its contents."""
    return frame.select(key, canonical(*content).alias("receipt"))


def verified(spark: SparkSession, path: str, expected: DataFrame, key: str, content: tuple[str, ...]) -> DataFrame:
    """Differences of what was written to what was to be: missing, extra or changed keys."""
    there = receipts(spark.read.parquet(path), key, content)
    both = receipts(expected, key, content).withColumnRenamed("receipt", "a").join(there.withColumnRenamed("receipt", "b"), key, "full_outer")
    change = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "changed")
    return both.select(key, change.alias("change")).where("change is not null")
