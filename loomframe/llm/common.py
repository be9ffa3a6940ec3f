"""What several text operators share: word kernels over Arrow text, checkpoints, and components of links."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's name for the words of every operator here: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one step of a kernel works on; a longer text is a step of its own.
SLICE = 1 << 20
#: Links whose components one task finds in memory (16 bytes each, and as much again for their nodes).
LINKS = 1_000_000

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_STEP = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a fixed bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse, for positions below ``n`` at least."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_STEP, pow(_STEP, -1, 2**64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=_U)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` gets the hash of any span of ``data`` (bytes)."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans: equal bytes give equal hashes wherever they lie."""
    return mix((running[end] - running[start]) * powers(len(running))[1][start] + (end - start).astype(_U))


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first, last + 1, their bytes, their offsets. Null counts as empty."""
    binary = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(binary):
        return
    buffers = binary.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(binary):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash (A-Z lower-cased), text number, start byte and end byte of every word."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, none
    inside = ~_SEPARATOR[data]
    edge = np.ones(n + 1, bool)
    edge[1:-1] = False
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return span_hash(prefix_hash(_LOWER[data]), start, end), np.searchsorted(offsets, start, "right") - 1, start, end


def grams(hashes: np.ndarray, owner: np.ndarray, k: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, owner and first word of every run of ``k`` words; with ``whole_if_short`` a text of fewer words is one run."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, _U)
    for i in range(k if n else 0):
        out += hashes[i : i + n] * _PLACE[i]
    first = np.flatnonzero(owner[:n] == owner[k - 1 :]) if n else np.zeros(0, np.int64)
    out = mix(out[first])
    if not whole_if_short or not len(hashes):
        return out, owner[first], first
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    sizes = np.diff(np.r_[heads, len(hashes)])
    short = sizes < k
    place = np.arange(len(hashes)) - np.repeat(heads, sizes)
    sums = np.add.reduceat(hashes * _PLACE[np.minimum(place, 63)], heads)[short]
    sums = mix(sums + sizes[short].astype(_U) * _PLACE[63])
    return np.r_[out, sums], np.r_[owner[first], owner[heads[short]]], np.r_[first, heads[short]]


def pack(array: np.ndarray) -> bytes:
    """Numbers as bytes, equal places together, so that the codec of the shuffle shrinks them."""
    array = np.ascontiguousarray(array)
    return array.view(np.uint8).reshape(len(array), array.itemsize).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    """The numbers that ``pack`` was given."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(kind).ravel()


def squeeze(array: np.ndarray) -> bytes:
    """``pack``, then zstandard: for what is also written, as checkpoints aren't compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pack(array))


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    """The numbers that ``squeeze`` was given."""
    import zstandard

    return unpack(zstandard.ZstdDecompressor().decompress(data), kind)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one is set only where none is named, as in tests, whose driver and executors are one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("checkpoints need a shared folder: set spark.checkpoint.dir")
    named = named or "spark-warehouse/checkpoints"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared checkpoint folder, its lineage cut."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(True)


def freed(spark: SparkSession) -> None:
    """Let the driver collect its garbage: exchanges that nobody reads any more stay on the disks until it does.

    What held them is let go a moment later than asked, hence more than once.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as a table in the shared folder.

    Unlike a checkpoint it carries nothing of its plan along, whose constraints grow from round to round of a loop until
    they fill the driver's memory.
    """
    path = f"{shared_folder(frame.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def looked_up(rows: DataFrame, table: DataFrame, key: list[str], by: str | tuple[str, ...], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row for each ``key``, though most rows may have one key.

    Rows are dealt to as many shares as there are partitions, by one or more columns ``by``. A share asks for each of its keys once,
    so that no key has more rows in a task than there are shares, or than a share of its own rows. Neither side is
    broadcast, as many such joins would fill the driver's memory with tables.
    """
    dealt = rows.withColumn("__share", F.pmod(F.xxhash64(*([by] if isinstance(by, str) else by)), F.lit(partitions(rows.sparkSession))))
    answers = dealt.select(*key, "__share").distinct().join(table.hint("merge"), key, how)
    return dealt.join(answers.hint("merge"), [*key, "__share"]).drop("__share")


def _stars(links: DataFrame, blocks: int) -> DataFrame:
    """Rows (a, b): every node b of a block of ``links`` with the smallest node a that the block's links reach from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not held:
            return
        nodes, ends = np.unique(np.concatenate([np.concatenate(x) for x in zip(*held, strict=True)]), return_inverse=True)
        a, b = ends[: len(ends) // 2], ends[len(ends) // 2 :]
        root = np.arange(len(nodes))
        while (root[a] != root[b]).any():  # larger roots hang below smaller ones, then all point to their roots
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[root]), pa.array(nodes)], names=["a", "b"])

    return links.repartition(blocks).mapInArrow(run, "a long, b long")


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """Components of ``links`` (a, b: long): rows (node, component), component being the smallest node reached.

    Links are dealt to blocks of about ``LINKS``, and each block's own components become stars around their smallest
    nodes. If there are several blocks, rounds join their stars: every round points each node to the smallest label among its
    neighbours', each label's own node to the smallest that its members have seen, and then each node to its label's own
    label, so that labels reach twice as far each time. Nothing but counts reaches the driver. A node that is linked with
    nothing has no row.
    """
    given = written(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"))
    blocks = max(1, -(-given.count() // LINKS))
    stars = written(_stars(given, blocks))
    if blocks == 1:
        return stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    both = written(stars.where("a <> b").union(stars.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    for _ in range(rounds):
        # what is used more than once is written, or the plan would hold it many times
        near = looked_up(both, labels.withColumnRenamed("node", "b"), ["b"], "a").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = written(labels.join(near.hint("merge"), "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("new")))
        # a root takes the smallest label that any of its members has seen, and they get it from there
        seen = hooked.groupBy(F.col("old").alias("node")).agg(F.min("new").alias("low"))
        hooked = written(hooked.join(seen.hint("merge"), "node", "left").select("node", "old", F.least("new", F.coalesce("low", "new")).alias("new")))
        jump = hooked.select(F.col("node").alias("new"), F.col("new").alias("far"))
        moved = written(looked_up(hooked, jump, ["new"], "node", "left").select("node", "old", F.least("new", F.coalesce("far", "new")).alias("new")))
        labels = moved.select("node", F.col("new").alias("component"))
        if moved.where("old <> new").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
