"""Jaccard join of n-gram sets by tries whose branches share partial overlaps.

Only n-grams that two documents have can be common, so that a document fewer than three quarters of whose n-grams are
shared has no partner. What is left is ordered by hash; equal sets become one class; classes are dealt to groups, and in
each group a trie over the ordered sets is traversed by all sets as probes, all sets under a branch sharing the overlap so
far. A probe leaves a branch when the n-grams that remain can't bring the overlap to the threshold, or when all that lies
under it is linked with the probe already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, grams, looked_up, mix, partitions, words
from .shared_keys import per_document, shared_keys

#: Sets that one group of the join holds; larger groups are dealt out by blocks of this size.
GROUP = 400
#: Sets beyond which a key counts as one that many have.
OFTEN = 64
#: Keys that many sets have and that are told to all executors: a bound, whatever the data.
FREQUENT = 100_000


def distinct_grams(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word hashes of each text and the text's number; fewer words than k make one gram."""
    hashes, owner, _, _ = words(data, offsets)
    keys, owner, _ = grams(hashes, owner, k, whole_if_short=True)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], owner[new]


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Smallest overlap of sets of sizes ``a`` and ``b`` whose Jaccard similarity is ``percent`` hundredths."""
    return -((-percent * (a + b)) // (100 + percent))


#: Elements of a stretch that are looked up at once, before probes that can't reach the threshold any more are left behind.
STEP = 64


class Trie:
    """Ordered sets sorted as sequences; a node is a run of them with the stretch that they share."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, rest: np.ndarray | None = None) -> None:
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        sets = [sets[i] for i in order]
        self.order, self.sizes = order, np.asarray(sizes)[order].astype(np.int64)
        # elements that come after those given, of which nothing is known
        self.rest = np.zeros(len(order), np.int64) if rest is None else np.asarray(rest)[order].astype(np.int64)
        self.start = np.cumsum([0, *(len(s) for s in sets)])
        self.length = np.diff(self.start) + self.rest
        values, self.rank = np.unique(np.concatenate(sets), return_inverse=True)
        self.width = len(values)
        # set and element as one number, in order: all sets are searched at once
        self.entries = np.repeat(np.arange(len(sets)), np.diff(self.start)) * self.width + self.rank
        self.shared = np.zeros(len(order), np.int64)  # with the set before
        for i in range(1, len(order)):
            a, b = sets[i - 1], sets[i]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared[i] = differ[0] if len(differ) else n
        self.component = np.unique(np.asarray(labels)[order], return_inverse=True)[1]

    def links(self, percent: int, join: bool = True) -> Iterator[tuple[int, int]]:
        """Pairs of sets (their numbers) that are similar enough, as many as join everything that can be joined.

        Without ``join`` every pair of different components that may still be similar enough. All sets go down the trie
        together as probes: those at a node have their overlaps with the path to it, counted once for all sets below.
        """
        n = len(self.order)
        stack = [(0, n, 0, np.arange(n), np.zeros(n, np.int64), np.diff(self.start))]
        while stack:
            low, high, depth, probes, overlap, left = stack.pop()
            leaf = high - low == 1
            keep = probes > low  # every pair is met once, at the set that sorts first
            own = self.component[low]
            if (self.component[low:high] == own).all():
                keep &= self.component[probes] != own
            least, most = self.sizes[low:high].min(), self.sizes[low:high].max()
            size = self.sizes[probes]
            keep &= (most * 100 >= percent * size) & (size * 100 >= percent * least)
            end = self.start[low + 1] - self.start[low] if leaf else self.shared[low + 1 : high].min()
            longest = self.length[low:high].max()
            while True:
                # the overlap that is needed against what there is and what can still come
                keep &= overlap + np.minimum(left + self.rest[probes], longest - depth) >= needed(size, np.maximum(least, -(-percent * size // 100)), percent)
                if not keep.all():
                    probes, overlap, left, size = probes[keep], overlap[keep], left[keep], size[keep]
                if not len(probes) or depth == end:
                    break
                stretch = self.rank[self.start[low] + depth : self.start[low] + min(end, depth + STEP)]
                depth += len(stretch)
                wanted = probes[:, None] * self.width + stretch
                found = np.searchsorted(self.entries, wanted)
                hit = self.entries[np.minimum(found, len(self.entries) - 1)] == wanted
                overlap = overlap + hit.sum(axis=1)
                left = self.start[probes + 1] - found[:, -1] - hit[:, -1]
                keep = np.ones(len(probes), bool)
            if not len(probes):
                continue
            if not leaf:
                cuts = [low, *(low + 1 + np.flatnonzero(self.shared[low + 1 : high] == end)).tolist(), high]
                stack += [(a, b, depth, probes, overlap, left) for a, b in zip(cuts, cuts[1:], strict=False)]
            elif join:
                for probe in probes[overlap >= needed(self.sizes[probes], self.sizes[low], percent)].tolist():
                    if self.component[probe] != self.component[low]:
                        self.component[self.component == self.component[probe]] = self.component[low]
                        yield self.order[probe], self.order[low]
            else:
                yield from ((self.order[probe], self.order[low]) for probe in probes.tolist())


def _pack48(keys: np.ndarray) -> bytes:
    """48-bit values as bytes, six each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    """The values that ``_pack48`` was given."""
    planes = np.zeros((len(data) // 6, 8), np.uint8)
    planes[:, :6] = np.frombuffer(data, np.uint8).reshape(6, -1).T
    return planes.view("<u8").ravel()


def _frequent(sets: DataFrame) -> np.ndarray:
    """Keys that many sets have, ``FREQUENT`` at most, sorted; which they are only sets an order."""
    parts = partitions(sets.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_unpack48(k.as_py()) for batch in batches for k in batch.column(0)]
        if held:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            # a key of more than OFTEN sets has its share of them in some partition
            often = n > max(2, OFTEN // parts)
            yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(n[often])], names=["key", "n"])

    found = sets.select("keys").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > OFTEN)
    return np.sort(found.orderBy(F.col("n").desc(), "key").limit(FREQUENT).select("key").toArrow().column(0).to_numpy())


def _leading(sets: DataFrame, percent: int) -> DataFrame:
    """member, n, have, lead of every set: the n-grams of which a partner must have one.

    The order is by hash, n-grams of many sets last (bit 48 of a value), so that a set's leading n-grams are rare ones: as
    many as remain when one fewer than ``percent`` hundredths of all are taken from the end.
    """
    frequent = sets.sparkSession.sparkContext.broadcast(_frequent(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value.view(np.uint64)
        for batch in batches:
            leads = []
            for n, data in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
                keys = _unpack48(data.as_py())
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
                    keys = np.sort(np.where(hot[at] == keys, keys | np.uint64(1 << 48), keys))
                leads.append(keys[: len(keys) + (-n * percent) // 100 + 1].view(np.int64))
            offsets = np.r_[0, np.cumsum([len(x) for x in leads])].astype(np.int32)
            values = np.concatenate(leads) if leads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["member", "n", "have", "lead"])

    return sets.select("member", "n", "have", "keys").mapInArrow(run, "member long, n long, have long, lead array<long>")


def _joined(groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within the groups (group, member, n, keys)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame["member"].to_numpy()
        trie = Trie([_unpack48(k) for k in frame["keys"]], frame["n"].to_numpy(), members)
        found = [(members[a], members[b]) for a, b in trie.links(percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return groups.select("group", "member", "n", "keys").groupBy("group").applyInPandas(run, "a long, b long")


def _near(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) within the groups (group, member, label, n, rest, keys) that may be links.

    keys are a set's leading n-grams from the group's own on, rest counts what follows them; sets of one label are
    joined already.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame["member"].to_numpy()
        trie = Trie([np.asarray(k, np.int64).view(np.uint64) for k in frame["keys"]], frame["n"].to_numpy(), frame["label"].to_numpy(), frame["rest"].to_numpy())
        found = {(min(members[a], members[b]), max(members[a], members[b])) for a, b in trie.links(percent, join=False)}
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return groups.groupBy("group").applyInPandas(run, "a long, b long").distinct()


def _starred(pairs: DataFrame) -> DataFrame:
    """Groups (group, member) of each leader with its members (leader, member), at most about GROUP in each."""
    spread = pairs.groupBy("leader").agg((F.floor(F.count("*") / GROUP) + 1).cast("int").alias("parts"))
    followers = pairs.join(spread, "leader").select("leader", F.pmod(F.xxhash64("member"), "parts").cast("int").alias("part"), "member")
    heads = spread.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("member"))
    return followers.union(heads).select(F.struct("leader", "part").alias("group"), "member")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its number of distinct k-word shingles and the smallest document that links reach.

    Columns: the id, n_shingles, component_id. Two documents link when the Jaccard similarity of their sets is
    ``percent`` hundredths or more. Words are lower-cased in A-Z; a document of fewer words than k has its whole
    sequence as one shingle; null, empty and blank texts have none and link with nothing (component_id is their own
    id). Texts are taken whole. Equal sets are one class, however many documents hold it. Rows with a null id are left
    out; rows that share an id count as one document with all their shingles. An empty table gives an empty result, and
    further columns aren't read.
    """
    packed = shared_keys(docs, lambda data, offsets: distinct_grams(data, offsets, k), id_column, text)

    def rows(keys: np.ndarray, owner: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        ids, counts = ids[order], counts[order]
        one = np.r_[True, ids[1:] != ids[:-1]]
        counts, ids = np.maximum.reduceat(counts, np.flatnonzero(one)), ids[one]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[fresh], owner[fresh]
        have = np.bincount(np.searchsorted(ids, owner), minlength=len(ids))
        keep = (have > 0) & (have * 100 >= counts * percent)
        ends = np.cumsum(have)
        sums = np.r_[np.uint64(0), np.cumsum(mix(keys), dtype=np.uint64)], np.r_[np.uint64(0), np.cumsum(mix(keys ^ np.uint64(0x5BD1E995)), dtype=np.uint64)]
        marks = [mix(s[ends] - s[ends - have]) for s in sums]
        alone = have != counts  # some shingle is its own, so that no other document has the same set
        marks[0] = np.where(alone, ids.view(np.uint64), marks[0])
        marks[1] = np.where(alone, np.uint64(0), marks[1] | np.uint64(1))
        keys = keys >> np.uint64(16)
        whole = [_pack48(keys[b - h : b]) if k else None for b, h, k in zip(ends.tolist(), have.tolist(), keep.tolist(), strict=True)]
        columns = [pa.array(ids), pa.array(counts), pa.array(have), pa.array(marks[0].view(np.int64)), pa.array(marks[1].view(np.int64)), pa.array(whole, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc", "n", "have", "m0", "m1", "keys"])

    sets = cut(per_document(packed, rows, "doc long, n long, have long, m0 long, m1 long, keys binary"))
    able = sets.where("keys is not null").select("doc", "m0", "m1")
    classes = cut(looked_up(able, able.groupBy("m0", "m1").agg(F.min("doc").alias("rep")), ["m0", "m1"], "doc").select("doc", "rep"))
    single = classes.where("doc = rep").select("doc")
    own = sets.select(F.col("doc").alias("member"), "n", "have", "keys").join(single.withColumnRenamed("doc", "member"), "member", "left_semi")
    leads = cut(_leading(own, percent))

    # first: every class with the class that shares most of its leading n-grams
    tokens = cut(leads.select("member", F.explode("lead").alias("token")))
    leaders = tokens.groupBy("token").agg(F.min("member").alias("leader"), F.count("*").alias("held")).where("held > 1").drop("held")
    votes = tokens.join(leaders, "token").where("leader <> member").groupBy("member", "leader").agg(F.count("*").alias("votes"))
    chosen = votes.groupBy("member").agg(F.max_by("leader", F.struct("votes", -F.col("leader"))).alias("leader"))
    links = cut(_joined(_starred(chosen.select("leader", "member")).join(own, "member"), percent))
    joined = components(links)

    # then: classes that aren't joined yet and have a leading n-gram in common
    marked = cut(
        tokens.join(leaders.select("token"), "token", "left_semi").join(joined.withColumnRenamed("node", "member"), "member", "left")
        .select("member", "token", F.coalesce("component", "member").alias("label"))
    )
    # n-grams with the same members are one group, that of the smallest
    members = [F.bit_xor(F.xxhash64("member", F.lit(i))).alias(f"s{i}") for i in (1, 2)]
    mixed = (
        marked.groupBy("token").agg(F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high"), *members).where("low <> high")
        .groupBy("held", "s1", "s2").agg(F.min("token").alias("token")).select("token", F.ceil(F.col("held") / GROUP).cast("int").alias("parts"))
    )
    dealt = marked.join(mixed, "token").select("token", "parts", F.pmod(F.xxhash64("member"), "parts").cast("int").alias("part"), "member", "label")
    # a group's members in blocks, every two blocks together once
    paired = dealt.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("parts") - 1, F.lit(0)))).alias("with"))
    blocks = paired.select(F.struct("token", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j")).alias("group"), "token", "member", "label")
    # of each set only the leading n-grams from the group's own on: pairs are looked at where their first common one is
    sent = blocks.join(leads, "member").select("group", "member", "label", "n", "have", (F.array_position("lead", F.col("token")) - 1).alias("skip"), "lead")
    sent = sent.select("group", "member", "label", "n", (F.col("have") - F.size("lead")).alias("rest"), F.slice("lead", F.col("skip").cast("int") + 1, F.size("lead")).alias("keys"))
    pairs = cut(_near(sent, percent))
    again = _starred(pairs.select(F.col("a").alias("leader"), F.col("b").alias("member"))).join(own, "member")
    final = components(links.union(_joined(again, percent)))

    rows = sets.select("doc", "n").join(classes, "doc", "left").select("doc", "n", F.coalesce("rep", "doc").alias("rep"))
    found = looked_up(rows, final.withColumnRenamed("node", "rep"), ["rep"], "doc", "left")
    return found.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
