"""Views that shape general tables into the operators' inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Width of the square masks that vectors of 64 numbers become.
MASK_WIDTH = 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the folder; Spark prunes its columns and pushes filters down."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def signals(spark: SparkSession, folder: str) -> DataFrame:
    """episode, frame (from 0), grip: one row for each event of a user in time order."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("episode"), (F.row_number().over(order) - 1).alias("frame"), F.least(F.lit(1.0), F.col("value") / 50).alias("grip")
    )


def posed(spark: SparkSession, folder: str) -> DataFrame:
    """``signals`` with a pose, xyz and rpy (arrays of three), for each frame."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    grip, zero = F.least(F.lit(1.0), F.col("value") / 50), F.lit(0.0)
    return table(spark, folder, "events").select(
        F.col("user_id").alias("episode"), (F.row_number().over(order) - 1).alias("frame"), grip.alias("grip"), F.array(grip * 0.1, F.col("event_id") % 97 / 1000, zero).alias("xyz"),
        F.array(zero, zero, F.col("event_id") % 7 * F.lit(0.9)).alias("rpy"),
    )


def mask_frames(spark: SparkSession, folder: str, above: float = 0.0) -> DataFrame:
    """episode, frame, mask (bigint, bit i is pixel i in row order), prob: one mask for each vector of a label."""
    order = Window.partitionBy("label").orderBy("vec_id")
    bit = F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
        lambda m, i: m.bitwiseOR(F.when(F.get("embedding", i) > above, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))),
    )
    return table(spark, folder, "embeddings").select(F.col("label").alias("episode"), (F.row_number().over(order) - 1).alias("frame"), bit.alias("mask"))


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate rows with gate metrics, from parts: id, frame, pixels, area, dark, components, largest, tcp (may be null)."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("id"), (key % 50).alias("frame"), (F.col("p_size") * 2 - 2).cast("int").alias("pixels"), (F.col("p_size") / 55).alias("area"), (key % 100 / 100).alias("dark"),
        (key % 6).cast("int").alias("components"), (key % 11 / 10).alias("largest"), F.when(key % 7 != 0, (key % 40).cast("double")).alias("tcp"), F.col("p_brand").alias("query"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """episode, method (text, box), seed, valid, status of recorded attempts, from conversations."""
    size = F.length("text")
    status = F.when(size % 5 == 0, "passed").when(size % 17 == 0, "error").when(size % 2 == 0, "rejected").otherwise("ambiguous")
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("episode"), F.when(F.col("role") == "user", "text").otherwise("box").alias("method"), F.col("turn").alias("seed"), (size % 3 == 0).alias("valid"), status.alias("status")
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """run, episode (position in its run), status, error, from orders."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    error = F.when(F.col("o_orderkey") % 97 == 0, "CUDA error: device-side assert triggered").when(F.col("o_orderkey") % 13 == 0, "decode failed")
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("episode"), status.alias("status"), error.alias("error"), F.col("o_orderpriority").alias("task"))
