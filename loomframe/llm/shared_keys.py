"""Which keys do two documents share? A packed exchange that answers without a row for every key.

A mapper gathers the keys of a block of documents, sorts them, and sends each range of keys as one packed row. Keys that
several documents of the block have are known to be shared there and then: they go on as they are, and a single entry
tells the range's reducer of them, so that a key that a third of all documents hold costs one entry a block. The reducer
of a range finds the keys that two blocks have in common. What is returned is packed by group of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, pack, partitions, slices, unpack

#: Keys that a mapper gathers before it sorts them and sends them on.
BLOCK = 1_000_000
_FIELDS = "target int, kind int, keys binary, docs binary"
_NAMES = ["target", "kind", "keys", "docs"]
_UNSURE, _SHARED, _SIZES = 0, 1, 2
#: Keys go by their upper 48 bits, sorted, of which some 30 remain to be sent. Two keys that agree in these count as
#: shared, which only keeps a document in the running: of 10**13 distinct keys every thirtieth would be mistaken.
_KEPT = ~np.uint64(0xFFFF)
#: The low bit of a key that is sent tells that the key is known to be shared.
_LOW = np.uint64(1)


def share_of(values: np.ndarray, parts: int) -> np.ndarray:
    """The part of ``parts`` equal ranges of 64-bit values in which each value lies."""
    return ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _rows(kind: int, target: np.ndarray, keys: np.ndarray, docs: np.ndarray) -> Iterator[tuple]:
    """A packed row for each run of equal ``target``."""
    cuts = np.flatnonzero(np.r_[True, target[1:] != target[:-1], True]) if len(target) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(target[a]), kind, pack(keys[a:b]), pack(docs[a:b])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def _batches(rows: Iterator[tuple], limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + len(row[3])
        if size > limit:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _by_document(kind: int, keys: np.ndarray, docs: np.ndarray, parts: int) -> Iterator[tuple]:
    target = share_of(mix(docs.view(np.uint64)), parts)
    order = np.argsort(target, kind="stable")
    yield from _rows(kind, target[order], keys[order], docs[order])


def shared_keys(docs: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], id_column: str, text: str) -> DataFrame:
    """Packed rows (target, kind, keys, docs) by group of documents: the keys that at least two documents have.

    ``keys_of(bytes, offsets)`` gives keys (uint64) and the number of the text that each belongs to, a text's keys being
    distinct. Rows of kind 1 hold keys and their documents; rows of kind 2 hold numbers of keys and their documents.
    Feed the result to ``per_document``. Rows with a null id are left out.
    """
    parts = partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[tuple]:
            keys, owner = np.concatenate(held_keys), np.concatenate(held_docs)
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            new = np.r_[True, keys[1:] != keys[:-1]]
            run = np.cumsum(new) - 1
            often = np.bincount(run)[run] > 1
            single = ~often | new
            yield from _rows(_UNSURE, share_of(keys[single], parts), keys[single] | often[single].astype(np.uint64), owner[single])
            yield from _by_document(_SHARED, keys[often], owner[often], parts)

        held_keys, held_docs, held = [], [], 0
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            counts = np.zeros(len(ids), np.int64)
            for first, last, data, offsets in slices(batch.column(1)):
                keys, owner = keys_of(data, offsets)
                keys = keys & _KEPT
                counts[first:last] = np.bincount(owner, minlength=last - first)
                held_keys.append(keys)
                held_docs.append(ids[first:last][owner])
                held += len(keys)
                if held >= BLOCK:
                    yield from _batches(flush())
                    held_keys, held_docs, held = [], [], 0
            yield from _batches(_by_document(_SIZES, counts.astype(np.uint64), ids, parts))
        if held:
            yield from _batches(flush())

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owner = [], []
        for batch in batches:
            kinds = np.asarray(batch.column(1))
            for i in np.flatnonzero(kinds == _UNSURE):
                keys.append(unpack(batch.column(2)[i].as_py(), np.uint64))
                owner.append(unpack(batch.column(3)[i].as_py(), np.int64))
            if (kinds != _UNSURE).any():
                yield batch.filter(pa.array(kinds != _UNSURE))
        if not keys:
            return
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        known, keys = (keys & _LOW).astype(bool), keys & ~_LOW
        run = np.cumsum(np.r_[True, keys[1:] != keys[:-1]]) - 1
        shared = (np.bincount(run)[run] > 1) & ~known
        yield from _batches(_by_document(_SHARED, keys[shared], owner[shared], parts))

    # what is known goes through the reducers as it is: target is then a group of documents, not a range of keys
    sent = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long"), text).mapInArrow(send, _FIELDS)
    return sent.repartitionById(parts, F.col("target")).mapInArrow(resolve, _FIELDS)


def per_document(packed: DataFrame, make: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """Bring the packed rows of each group of documents together and let ``make`` turn them into rows.

    ``make(keys, owners, counts, ids)`` gets the shared keys and their documents, sorted by document and key, and the
    number of all keys of every document of the group.
    """
    parts = partitions(packed.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[list, list]] = {_SHARED: ([], []), _SIZES: ([], [])}
        for batch in batches:
            for kind, keys, docs in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                found[kind][0].append(unpack(keys.as_py(), np.uint64))
                found[kind][1].append(unpack(docs.as_py(), np.int64))
        if not found[_SIZES][0]:
            return
        none = np.zeros(0, np.uint64)
        keys, owner = (np.concatenate([none.astype(t), *x]) for t, x in zip((np.uint64, np.int64), found[_SHARED], strict=True))
        order = np.lexsort((keys, owner))
        yield make(keys[order], owner[order], np.concatenate(found[_SIZES][0]).astype(np.int64), np.concatenate(found[_SIZES][1]))

    return packed.repartitionById(parts, F.col("target")).mapInArrow(gather, schema)
