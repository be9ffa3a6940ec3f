"""A trie of conversations by their turns, and what lies under each of its nodes, rolled up by bands of depths.

A node is known by a chained digest of the turns that lead to it. Totals of subtrees come from three sums, however deep
the trie: every node adds to its ancestors within its band of depths; tops of bands add to the tops above them; each
completed top adds to the nodes of the band right above it. Bands are about as high as the square root of the depth, so
that no node goes to more rows than there are depths in a band, or bands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, looked_up, partitions, written

#: Bytes of a node's name.
NAME = 16
#: The least height of a band.
HEIGHT = 16
#: Original turns of a base that a conversation may take, and the ids that share a base.
TAKEN, FAMILY = 4, 20
#: Ids that one piece of a list of ends holds.
PIECE = 1 << 16
ROOT = bytes(NAME)


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv, kind, at, digest, words) of all conversations rebuilt from their base's first turns and their own rest.

    ``kind`` 0 is a turn of the base, 1 an own one, 2 a row that every conversation has, turns or not; ``at`` orders turns
    of a kind. Turns are ordered by turn (null first), then role, then text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").alias("conv"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")) - 1
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.concat("role", "text")), 256))
    words = F.size(F.regexp_extract_all("text", F.lit(WORD), 0)).cast("long")
    turns = written(turns.select("conv", place.cast("long").alias("at"), digest.alias("digest"), words.alias("words")))

    taken = lambda conv: F.crc32(F.col(conv).cast("string").cast("binary")) % TAKEN
    own = turns.where(F.col("at") >= taken("conv")).select("conv", F.lit(1).alias("kind"), "at", "digest", "words")
    heads = turns.where("at = 0").select("conv")
    # a base has fewer than TAKEN such turns and at most two families of followers, one on either side of zero
    followers = heads.select(F.col("conv").alias("follower"), (F.col("conv") - F.col("conv") % FAMILY).alias("conv"))
    given = turns.where((F.col("at") < TAKEN - 1) & (F.col("conv") % FAMILY == 0)).join(followers, "conv").where(F.col("at") < taken("follower"))
    lent = given.select(F.col("follower").alias("conv"), F.lit(0).alias("kind"), "at", "digest", "words")
    ends = heads.select("conv", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return own.union(lent).union(ends)


_PATHS = "conv long, depth long, node binary, words long, ends boolean, parent binary, path binary, tops binary, above binary"


def _paths(turns: DataFrame, height: int) -> DataFrame:
    """A row for each node on each conversation's way, with the names of its ancestors that sums need.

    ``path``: those of its band, itself last; only for tops of bands: ``tops``, the tops down to itself, and ``above``, the
    path of the band before.
    """
    parts = partitions(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def step(depth: int, node: bytes, words: int) -> tuple:
            nonlocal path, tops
            parent, above, top = node_before, None, None
            if depth % height == 0:
                above, path, tops = path, b"", tops + node
                top = tops
            path += node
            return conv, depth, node, words, False, parent, path, top, above

        conv, depth, node_before, path, tops, held, rows = None, 0, b"", b"", b"", None, []
        for batch in batches:
            for c, kind, digest, words in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if c != conv:
                    conv, depth, node_before, path, tops = c, 0, b"", b"", b""
                    held = step(0, ROOT, 0)
                    node_before = ROOT
                if kind == 2:  # the conversation's last row
                    rows.append((*held[:4], True, *held[5:]))
                else:
                    rows.append(held)
                    depth += 1
                    node = hashlib.blake2b(node_before + digest, digest_size=NAME).digest()
                    held = step(depth, node, words)
                    node_before = node
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    sent = turns.repartition(parts, "conv").sortWithinPartitions("conv", "kind", "at")
    return sent.mapInArrow(run, _PATHS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = [c.split()[0] for c in _PATHS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _names(path: str) -> Column:
    """The names that a path holds, one after the other."""
    return F.explode(F.transform(F.sequence(F.lit(0), (F.octet_length(path) / NAME).cast("int") - 1), lambda i: F.substring(F.col(path), i * NAME + 1, F.lit(NAME))))


def _summed(rows: DataFrame, path: str) -> DataFrame:
    """leaves and saved of all rows, added to every node of their path."""
    return rows.select(_names(path).alias("node"), "leaves", "saved").groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _ends(paths: DataFrame) -> DataFrame:
    """node and the digest of the ids that end there, ascending, joined by commas.

    Ids are sorted over the whole table and packed by pieces, so that a node where a third of all conversations end is
    spread over many tasks until its few pieces are hashed one after the other.
    """
    parts = partitions(paths.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids)).encode()], pa.binary())], names=["node", "first", "ids"])

        node, ids = None, []
        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (n != node or len(ids) >= PIECE):
                    yield sent()
                    ids = []
                node = n
                ids.append(c)
        if ids:
            yield sent()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends_sha256"])

        node, running = None, None
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if n == node:
                    running.update(b",")
                elif node is not None:
                    yield sent()
                if n != node:
                    node, running = n, hashlib.sha256()
                running.update(ids)
        if node is not None:
            yield sent()

    last = paths.where("ends").select("node", "conv")
    pieces = last.repartitionByRange(parts, "node", "conv").sortWithinPartitions("node", "conv").mapInArrow(pack, "node binary, first long, ids binary")
    return pieces.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations, a row for each node.

    Conversation c takes the first crc32(c) % 4 turns of conversation c - c % 20 and, after as many of its own, its own. A
    node is a sequence of (role, text) with which rebuilt conversations start. Columns, long: conv_id, its smallest
    member; depth; parent_conv_id, its parent's conv_id (root: null); n_convs, members; n_children; n_leaves, childless nodes in
    its subtree; saved_tokens, over its subtree the words of each node's last turn times its members but one; and
    ends_sha256 of the ids of members that end there.

    Null role or text counts as empty; a null turn comes first; turns that tie are ordered by role, then text; repeated rows
    are turns of their own; rows with a null conv_id are left out; an empty table gives no row. Texts are taken whole;
    further columns aren't read. A conversation is walked through turn by turn, however long it is.
    """
    turns = written(rebuilt_turns(conversations))
    longest = turns.where("kind < 2").groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    height = max(HEIGHT, isqrt(longest) + 1)
    paths = written(_paths(turns, height))
    told = ["node", "depth", "words", "parent", "path", "tops", "above"]
    counts = paths.groupBy(*told).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum(F.col("ends").cast("long")).alias("n_ends"))
    nodes = written(counts.withColumn("leaves", (F.col("n_ends") == F.col("n_convs")).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")))

    within = written(_summed(nodes.select("path", "leaves", "saved"), "path"))
    tops = nodes.where("tops is not null").select("node", "depth", "tops", "above")
    completed = _summed(tops.join(within, "node").select("tops", "leaves", "saved"), "tops")
    passed = _summed(tops.where("depth > 0").join(completed, "node").select("above", "leaves", "saved"), "above")
    none = F.lit(0).cast("long")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parts = (
        within.select("node", "leaves", "saved", none.alias("n_children")).union(passed.select("node", "leaves", "saved", none))
        .union(children.select("node", none, none, "n_children"))
    )
    totals = parts.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("n_children").alias("n_children"))
    rows = nodes.select("node", "conv_id", "depth", "parent", "n_convs").join(totals, "node").join(_ends(paths), "node", "left")
    heads = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = looked_up(rows, heads, ["parent"], "node", "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))
