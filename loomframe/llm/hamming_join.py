"""Near-duplicates by a multi-index join of MinHash signatures: every pair under a distance, found through chunks.

A signature has SYMBOLS values of BITS bits, each the low bits of a least hash over the document's shingles; two signatures
differ in about 1 - similarity of their values. The values are cut into chunks. If two signatures differ in at most RADIUS
values, they can't differ twice in all chunks: at least one differs in one value or none. So each chunk is looked up once for
each value left out, which covers both cases, and no pair within RADIUS is missed. Pairs are then confirmed on the whole
sets of shingles.

Of equal sets one stands for all. A first round links each set with the one it meets most often, so that large groups of
near copies are joined by few pairs; a second looks at pairs of what isn't joined yet. Where a lookup brings many sets
together, most of which aren't similar enough, those meet again by their rarest shingles: two similar sets share one of
these, at places that leave room for as much overlap as their sizes ask for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, looked_up, mix, slices, written
from .shared_keys import per_document, shared_keys
from .trie_join import distinct_grams, needed

#: Values of a signature, and bits of each.
SYMBOLS, BITS = 128, 16
#: Chunks, of five or six values.
CHUNKS = 25
#: Values in which two signatures may differ so that one chunk differs in one value at most. Sets that are similar to 0.8
#: exceed it with a probability of 6e-7.
RADIUS = 2 * CHUNKS - 1
#: Sets that are brought to one set at once to be confirmed.
GROUP = 400
#: Sets that a lookup may bring together to be compared with each other; larger groups meet again by rare shingles.
CROWD = 64
#: Sets with one rare shingle that are compared at once; more are dealt by blocks.
BLOCK = 20_000
#: Shingles of many sets whose number is told to all executors: a bound, whatever the data. It only sets an order.
FREQUENT = 100_000

_U = np.uint64
_rng = np.random.default_rng(12)
_SEEDS = _rng.integers(1, 2**63, (2, SYMBOLS), dtype=np.int64).astype(_U) * _U(2) + _U(1)
_EDGES = np.linspace(0, SYMBOLS, CHUNKS + 1).astype(int)
#: Chunk of each value: a lookup leaves out one value and takes the rest of its chunk.
_CHUNK = np.repeat(np.arange(CHUNKS), np.diff(_EDGES))
_WEIGHT = mix(np.arange(1, SYMBOLS + 1, dtype=_U)) | _U(1)
_FIELDS = "doc long, n long, m0 long, m1 long, sig binary"


def signatures(keys: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """A row of SYMBOLS values for each set; sets are runs of ``keys`` that begin at ``heads``."""
    out = np.empty((len(heads), SYMBOLS), np.uint16)
    for i in range(SYMBOLS if len(heads) else 0):
        x = (keys ^ _SEEDS[0, i]) * _SEEDS[1, i]
        x ^= x >> _U(29)
        x *= _SEEDS[0, i]
        out[:, i] = np.minimum.reduceat(x, heads) & _U((1 << BITS) - 1)
    return out


def lookups(sig: np.ndarray) -> np.ndarray:
    """For each signature SYMBOLS keys: number i is that of the chunk of value i without value i; its top bits say i."""
    parts = mix((sig.astype(_U) + _U(1)) * _WEIGHT)
    sums = np.add.reduceat(parts, _EDGES[:-1], axis=1)
    return (mix(sums[:, _CHUNK] - parts) >> _U(7)) | (np.arange(SYMBOLS, dtype=_U) << _U(57))


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """Number of shingles, digest of the set and signature of every row (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                keys, owner = distinct_grams(data, offsets, k)
                counts = np.bincount(owner, minlength=last - first)
                heads = np.cumsum(counts) - counts
                full = counts > 0
                marks = []
                for salt in (0, 0x5BD1E995):
                    sums = np.zeros(len(counts), _U)
                    sums[full] = np.add.reduceat(mix(keys ^ _U(salt)), heads[full]) if full.any() else 0
                    marks.append(pa.array(mix(sums + counts.astype(_U)).view(np.int64)))
                found = iter(signatures(keys, heads[full]))
                sig = pa.array([next(found).tobytes() if f else None for f in full.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(counts.astype(np.int64)), *marks, sig], names=["doc", "n", "m0", "m1", "sig"])

    return docs.mapInArrow(run, _FIELDS)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """The distinct shingles of every row (node, text), sorted, as 64-bit numbers in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                keys, owner = distinct_grams(data, offsets, k)
                ends = np.cumsum(np.bincount(owner, minlength=last - first))
                sets = [x.tobytes() for x in np.split(keys, ends[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(sets, pa.binary())], names=["node", "keys"])

    return docs.mapInArrow(run, "node long, keys binary")


def _shared_lookups(nodes: DataFrame) -> DataFrame:
    """Rows (key, node): the lookups that at least two nodes have."""

    def keys_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sig = data.view(np.uint16).reshape(-1, SYMBOLS)
        return lookups(sig).ravel(), np.repeat(np.arange(len(sig)), SYMBOLS)

    def rows(keys: np.ndarray, owner: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(owner)], names=["key", "node"])

    return per_document(shared_keys(nodes, keys_of, "node", "sig"), rows, "key long, node long")


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose signatures differ in RADIUS values at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (_unpacked(batch.column(2)) != _unpacked(batch.column(3))).sum(axis=1) <= RADIUS
            yield batch.select([0, 1]).filter(pa.array(near))

    sig = nodes.select("node", "sig")
    left = looked_up(pairs, sig.toDF("a", "x"), ["a"], "b")
    return left.join(sig.toDF("b", "y").hint("merge"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets are similar to ``percent`` hundredths; each a's set is brought to GROUP partners at once."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lead = frame["group"].iloc[0]["a"]
        own = [np.frombuffer(k, _U) for k, m in zip(frame["keys"], frame["node"], strict=True) if m == lead]
        found = []
        for data, node in zip(frame["keys"], frame["node"], strict=True):
            other = np.frombuffer(data, _U)
            for mine in own if node != lead else ():
                at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                if (mine[at] == other).sum() >= needed(len(mine), len(other), percent):
                    found.append((lead, node))
                    break
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    spread = pairs.groupBy("a").agg((F.floor(F.count("*") / GROUP) + 1).cast("int").alias("parts"))
    dealt = looked_up(pairs, spread, ["a"], "b").select(F.struct("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part")).alias("group"), F.col("b").alias("node"))
    heads = spread.select(F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "a").select(F.struct("a", F.col("part").cast("int").alias("part")).alias("group"), F.col("a").alias("node"))
    return dealt.union(heads).join(sets.hint("merge"), "node").groupBy("group").applyInPandas(run, "a long, b long")


def _near(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels within the groups (key, node, label, n, sig) that are within RADIUS."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", ignore_index=True)
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint16).reshape(-1, SYMBOLS)
        node, label, n = (frame[c].to_numpy() for c in ("node", "label", "n"))
        found = []
        for i in range(len(node) - 1):
            rest = i + 1 + np.flatnonzero((label[i + 1 :] != label[i]) & (np.minimum(n[i + 1 :], n[i]) * 100 >= percent * np.maximum(n[i + 1 :], n[i])))
            rest = rest[(sig[rest] != sig[i]).sum(axis=1) <= RADIUS]
            found.append(np.stack([np.full(len(rest), node[i]), node[rest]], axis=1))
        return pd.DataFrame(np.concatenate(found) if found else np.zeros((0, 2), np.int64), columns=["a", "b"])

    return groups.groupBy("key").applyInPandas(run, "a long, b long").where("a <> b").distinct()


def _mixed(tokens: DataFrame, order: str = "key") -> DataFrame:
    """Rows (key, held, node, label and what else there is) of the keys whose nodes have different labels; of keys with the same nodes, the first by ``order``."""
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"s{i}") for i in (1, 2)]
    groups = tokens.groupBy("key").agg(F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high"), F.min(order).alias("at"), *marks).where("low <> high")
    return looked_up(tokens, groups.groupBy("held", "s1", "s2").agg(F.min_by("key", "at").alias("key")).select("key", "held"), ["key"], "node")


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sets have, the FREQUENT most frequent at most, sorted, and each one's rank from the rarest on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys[n > 1]), pa.array(n[n > 1])], names=["key", "n"])

    often = sets.select("keys").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    keys = often.orderBy(F.col("n").desc(), "key").limit(FREQUENT).select("key", "n").orderBy("n", "key").toArrow().column(0).to_numpy().view(_U)
    order = np.argsort(keys)
    return keys[order], order


def _rare(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels of a crowd (node, label) that may be similar enough, by their rarest shingles.

    A set's shingles are ordered from rare to frequent. If two sets share as many as their sizes ask for, then the first one
    that they share leaves at least so many in each of both, itself included.
    """
    known = crowd.sparkSession.sparkContext.broadcast(_frequent(sets.join(crowd.select("node"), "node", "left_semi")))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = known.value
        for batch in batches:
            parts = []
            for i, data in enumerate(batch.column(2).to_pylist()):
                keys = np.frombuffer(data, _U)
                at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1) if len(hot) else None
                often = np.where(hot[at] == keys, rank[at] + 1, 0) if len(hot) else np.zeros(len(keys), np.int64)
                first = keys[np.lexsort((keys, often))][: len(keys) - -(-percent * len(keys) // 100) + 1]
                parts.append((np.full(len(first), i), first.view(np.int64), np.arange(len(first)), np.full(len(first), len(keys))))
            if parts:
                row, key, place, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(n), pa.array(place)], names=["key", "node", "label", "n", "place"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n", "node"], ignore_index=True)
        node, label, n, place = (frame[c].to_numpy() for c in ("node", "label", "n", "place"))
        found = []
        low = np.searchsorted(n, -(-percent * n // 100))
        for i in range(len(n)):  # with each set not larger than itself
            rest = np.arange(low[i], i)
            common = needed(n[rest], n[i], percent)
            rest = rest[(label[rest] != label[i]) & (common <= n[i] - place[i]) & (common <= n[rest] - place[rest])]
            found.append(np.stack([np.minimum(node[rest], node[i]), np.maximum(node[rest], node[i])], axis=1))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    leads = crowd.join(sets.hint("merge"), "node").select("node", "label", "keys").mapInArrow(lead, "key long, node long, label long, n long, place long")
    # of shingles with the same sets the first one counts, which comes first in all of them
    dealt = _mixed(leads, "place").withColumn("parts", F.ceil(F.col("held") / BLOCK).cast("int"))
    # what is held by more is dealt by blocks, every two blocks together once
    paired = dealt.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("parts") - 1, F.lit(0)))).alias("with"))
    groups = paired.select(F.struct("key", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j")).alias("group"), "node", "label", "n", "place")
    return groups.groupBy("group").applyInPandas(meet, "a long, b long").where("a <> b").distinct()


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its number of distinct k-word shingles, the smallest id that links reach, and whether it is that one.

    Columns: the id, n_shingles, component_id, kept. Documents link when the Jaccard similarity of their sets is ``percent``
    hundredths or more and their signatures differ in RADIUS values at most (for 80, all but 6e-7 of such pairs; a smaller
    ``percent`` needs other constants and is refused). Words are lower-cased in A-Z; a document of fewer words than k has its
    whole sequence as one shingle; null, empty and blank texts have none and link with nothing. Texts are taken whole.
    Rows with a null id are left out; rows that share an id are one document with several texts, a row each. An empty
    table gives an empty result, and further columns aren't read.
    """
    if percent < 80:
        raise ValueError("signatures are made for similarities of 0.8 and more")
    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
    signed = written(_signed(texts, k))
    nodes = written(signed.where("n > 0").groupBy("m0", "m1", "n", "sig").agg(F.min("doc").alias("node")))
    shared = written(_shared_lookups(nodes.select("node", "sig")))
    able = shared.select("node").distinct()
    sets = written(_sets(texts.withColumnRenamed("doc", "node").join(able, "node", "left_semi").select("node", "text"), k).where(F.octet_length("keys") > 0))

    # first: every set with the one that it meets most often
    leaders = shared.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a <> high").drop("high")
    votes = looked_up(shared, leaders, ["key"], "node").where("a <> node").groupBy("node", "a").agg(F.count("*").alias("votes"))
    chosen = votes.groupBy("node").agg(F.max_by("a", F.struct("votes", -F.col("a"))).alias("a")).select("a", F.col("node").alias("b"))
    links = written(_confirmed(_close(chosen, nodes), sets, percent))
    labels = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    for _ in range(2):
        labels = written(labels)
        higher = looked_up(labels, labels.toDF("label", "up"), ["label"], "node", "left")
        labels = higher.select("node", F.coalesce("up", "label").alias("label"))

    # then: sets that aren't joined yet
    marked = shared.join(labels.hint("merge"), "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = written(_mixed(marked))
    small = mixed.where(F.col("held") <= CROWD).join(nodes.select("node", "n", "sig").hint("merge"), "node")
    crowd = written(mixed.where(F.col("held") > CROWD).select("node", "label").distinct())
    pairs = written(_near(small.select("key", "node", "label", "n", "sig"), percent).union(_close(_rare(crowd, sets, percent), nodes)).distinct())

    named = looked_up(signed.where("n > 0").select("doc", "n", "m0", "m1"), nodes.select("m0", "m1", "node"), ["m0", "m1"], "doc").select("doc", "n", "node")
    rows = written(named.union(signed.where("n = 0").select("doc", "n", F.col("doc").alias("node"))))
    several = rows.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a <> high").select("doc", "a")
    same = looked_up(rows.select("doc", "node").distinct(), several, ["doc"], "node").select("a", F.col("node").alias("b"))
    final = components(links.union(_confirmed(pairs, sets, percent)).union(same))
    found = looked_up(rows, final, ["node"], "doc", "left")
    component = F.coalesce("component", "node")
    return found.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc") == component).alias("kept"))
