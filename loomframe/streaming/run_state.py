"""Run state as streams: readiness, latest status, finalizing, and windows over events."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..sources.adapters import table

READY = ("completed", "skipped_complete")
UNAVAILABLE = "SourceEpisodeUnavailable"


def receipts(spark: SparkSession, folder: str, files: int = 2) -> DataFrame:
    """The events of a folder as a stream of receipts (episode, seq, at, status, error), ``files`` files at a time."""
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "events*.parquet").option("recursiveFileLookup", "true").parquet(folder)
    kind = F.when(F.col("event_id") % 5 == 0, "failed").when(F.col("event_id") % 3 == 0, "skipped_complete").when(F.col("event_id") % 2 == 0, "completed").otherwise("running")
    return stream.select(F.col("user_id").alias("episode"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("at"), kind.alias("status"), F.when(F.col("event_id") % 7 == 0, "decode failed").alias("error"))


def latest_status(stream: DataFrame) -> DataFrame:
    """The last status of every episode and how many receipts it has."""
    return stream.groupBy("episode").agg(F.max_by("status", "seq").alias("status"), F.count("*").alias("receipts"))


def ready(stream: DataFrame) -> DataFrame:
    """Receipts of episodes that may go on."""
    return stream.where(F.col("status").isin(*READY))


def tumbling(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Receipts of each status in windows of time, those later than ``late`` dropped by the watermark."""
    return stream.withWatermark("at", late).groupBy(F.window("at", width).alias("w"), "status").agg(F.count("*").alias("receipts"))


class Worker(StatefulProcessor):
    """One episode's life: pending until a receipt says that its source is ready, then worked on once, or failed when none came.

    The deadline counts from the episode's first receipt, in the time of the receipts. What is kept can be told in any order:
    the earliest receipt, the earliest ready one with its error, and the numbers of receipts seen, so that one sent twice
    counts once and batches don't show. A timer at the deadline fails what isn't done by then.
    """

    def __init__(self, deadline_ms: int) -> None:
        self.deadline = deadline_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "version int, receipts long, first long, ready long, seq long, error string, status string, error_type string")
        self.seen = handle.getListState("seen", "seqs binary")

    def _row(self, key, state) -> pd.DataFrame:
        names = ("version", "receipts", "first", "ready", "seq", "error", "status", "error_type")
        now = dict(zip(names, state, strict=True))
        error = now["error"] if now["status"] == "failed" else None
        texts = {n: np.array([v], object) for n, v in (("status", now["status"]), ("error_type", now["error_type"]), ("error", error))}
        return pd.DataFrame({"episode": [key[0]], "version": [now["version"]], "receipts": [now["receipts"]], **texts})

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        known = self.known.get()
        version, receipts, first, ready, seq, error, status, kind = known or (0, 0, None, None, None, None, "pending", None)
        # the state is asked and told once for all rows that come together, not for each
        frames = list(rows)
        numbers, at = (np.concatenate([f[n].to_numpy(t) for f in frames]) for n, t in (("seq", "int64"), ("at", "datetime64[us]")))
        new = np.unique(numbers, return_index=True)[1]
        if known:
            before = [np.frombuffer(x[0], np.int64) for x in self.seen.get()]
            new = new[~np.isin(numbers[new], np.concatenate(before))] if before else new
        if len(new):
            at = at.astype("int64")
            self.seen.appendValue((numbers[new].tobytes(),))
            receipts += len(new)
            first = int(at[new].min()) if first is None else min(first, int(at[new].min()))
            states, failures = (np.concatenate([f[n].to_numpy(object) for f in frames]) for n in ("status", "error"))
            fit = new[np.isin(states[new].astype(str), READY)]
            if len(fit):
                best = int(fit[np.lexsort((numbers[fit], at[fit]))[0]])
                if ready is None or (int(at[best]), int(numbers[best])) < (ready, seq):
                    ready, seq, error = int(at[best]), int(numbers[best]), failures[best] if isinstance(failures[best], str) else None
        if kind != UNAVAILABLE:
            in_time = ready is not None and ready - first <= self.deadline * 1000
            status, kind = ("pending", None) if not in_time else ("complete", None) if error is None else ("failed", "SourceFailed")
            for timer in list(self.handle.listTimers()) if known else ():
                self.handle.deleteTimer(timer)
            if not in_time:
                self.handle.registerTimer(first // 1000 + self.deadline)
        state = (version + 1, receipts, first, ready, seq, error, status, kind)
        self.known.update(state)
        yield self._row(key, state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        version, receipts, first, ready, seq, _, _, _ = self.known.get()
        state = (version + 1, receipts, first, ready, seq, "source episode did not become ready", "failed", UNAVAILABLE)
        self.known.update(state)
        yield self._row(key, state)

    def close(self) -> None:
        pass


def worked(stream: DataFrame, deadline_ms: int, late: str = "1 hour") -> DataFrame:
    """What becomes of each episode's receipts (episode, seq, at, status, error), in update mode; ``version`` orders its rows.

    Receipts may come ``late`` by as much without changing the outcome; later ones are dropped by the watermark.
    """
    keyed = stream.select("episode", "seq", "at", "status", "error").withWatermark("at", late).groupBy("episode")
    return keyed.transformWithStateInPandas(Worker(deadline_ms), "episode long, version int, receipts long, status string, error_type string, error string", outputMode="Update", timeMode="EventTime")


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start here keep their state in RocksDB, as stateful processors ask for."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def finished(stream: DataFrame, checkpoint: str, mode: str = "complete", key: str | None = None, order: str = "batch") -> DataFrame:
    """Run a stream over what there is, to its end, and return its rows (in update mode the last of each key by ``order``).

    Rows go to Parquet beside the checkpoint, a folder for each batch, so that a batch run again replaces its rows.
    """
    at = f"{checkpoint.rstrip('/')}/{uuid.uuid4().hex}"

    def put(frame: DataFrame, batch: int) -> None:
        frame.write.mode("overwrite").parquet(f"{at}/rows/batch={batch}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    rows = stream.sparkSession.read.parquet(f"{at}/rows")
    if mode == "complete":
        return rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0]).drop("batch")
    if key:
        last = rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in (key, "batch"))), order).alias("x"))
        return last.select(key, "x.*")
    return rows.drop("batch")
