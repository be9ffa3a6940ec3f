"""Benchmark items inside documents: size-partitioned MinHash containment search with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .trie_join import distinct_grams

#: Shingles of items that are sent to the executors at once; more items are searched in further passes.
ITEM_GRAMS = 1_000_000
#: Items of fewer shingles than this are looked up by every shingle, as a sketch could miss them.
SHORT = 8


def _bins(keys: np.ndarray, size_class: np.ndarray | int) -> np.ndarray:
    """Bin of each hash in a sketch of two bins for each shingle of the class's largest document; grows with the hash."""
    return ((keys >> np.uint64(32)) << np.asarray(size_class, np.uint64) + np.uint64(1)) >> np.uint64(32)


def _classes(sizes: np.ndarray) -> np.ndarray:
    """Partition of a document by size: c holds sizes above 2**(c-1) and up to 2**c."""
    return np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)


class ItemIndex:
    """Sketches of the items for every size partition, and their shingles for confirmation."""

    def __init__(self, names: list, keys: np.ndarray, owner: np.ndarray) -> None:
        order = np.lexsort((keys, owner))
        self.names, self.keys, self.owner = names, keys[order], owner[order]
        self.sizes = np.bincount(owner, minlength=len(names))
        self.start = np.r_[0, np.cumsum(self.sizes)]
        self.sketches: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sketch(self, size_class: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted bin minima of one partition and their items; for short items all shingles."""
        if size_class not in self.sketches:
            bins = _bins(self.keys, size_class)
            least = np.r_[True, (bins[1:] != bins[:-1]) | (self.owner[1:] != self.owner[:-1])][: len(bins)]
            least |= self.sizes[self.owner] < SHORT
            order = np.argsort(self.keys[least], kind="stable")
            self.sketches[size_class] = self.keys[least][order], self.owner[least][order]
        return self.sketches[size_class]

    def search(self, keys: np.ndarray, owner: np.ndarray, texts: int, threshold: float) -> Iterator[tuple[int, int, int]]:
        """(text, item, common shingles) for the items that the texts contain; keys sorted by text and hash."""
        sizes = np.bincount(owner, minlength=texts)
        starts, classes = np.r_[0, np.cumsum(sizes)], _classes(sizes)
        of = classes[owner]
        bins = _bins(keys, of)
        least = np.r_[True, (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])][: len(bins)]
        for size_class in np.unique(of):
            values, items = self.sketch(int(size_class))
            here = np.flatnonzero(of == size_class)
            low, high = np.searchsorted(values, keys[here]), np.searchsorted(values, keys[here], "right")
            hit = high > low
            here, low, high = here[hit], low[hit], high[hit]
            if not len(here):
                continue
            many = high - low
            entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item, text = items[entry], np.repeat(owner[here], many)
            # a bin matches if its minimum is the same on both sides; short items match by any shingle
            counts = np.repeat(least[here], many) | (self.sizes[item] < SHORT)
            for pair in np.unique(text[counts] * len(self.names) + item[counts]):
                text_at, item_at = divmod(int(pair), len(self.names))
                mine = self.keys[self.start[item_at] : self.start[item_at + 1]]
                theirs = keys[starts[text_at] : starts[text_at + 1]]
                found = np.searchsorted(theirs, mine)
                common = int(np.count_nonzero(theirs[np.minimum(found, len(theirs) - 1)] == mine))
                if common >= threshold * len(mine) - 1e-9:
                    yield text_at, item_at, common


def find_items(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.75, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and an item whose k-word shingles the document contains to ``threshold`` or more.

    Columns: doc_id, item_id, n_shingles (of the item), containment (exact). Documents are partitioned by their number of
    shingles; each partition has sketches with two bins for every shingle of its largest document, so that a shingle that
    an item shares with a document is its bin's minimum with a chance of 0.79 or more whatever the document's length.
    Items of fewer than eight shingles are looked up by all of them. Every candidate is confirmed by counting.
    An item of fewer words than k is one shingle, which only a document of just these words contains; null, empty and
    blank texts contain nothing and are contained nowhere. Repeated items and documents give repeated pairs; null ids are
    kept. Empty tables give no pairs. Items go to the executors in passes of about ``ITEM_GRAMS`` shingles; documents
    stay where they are read.
    """
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("item_id", items.schema[item_id].dataType),
        T.StructField("n_shingles", T.LongType()), T.StructField("containment", T.DoubleType()),
    ])
    total = items.select(F.sum(F.length(item_text)).alias("n")).first()["n"] or 0
    passes = int(total // (4 * ITEM_GRAMS)) + 1  # a shingle for every four characters at most, but for odd texts
    found = None
    for at in range(passes):
        part = items.select(item_id, item_text).where(F.pmod(F.xxhash64(item_id, item_text), F.lit(passes)) == at).toArrow()
        names, item_type, keys, owner = part.column(0).to_pylist(), part.schema.field(0).type, [], []
        for first, _, data, offsets in slices(pa.array(part.column(1).to_pylist(), pa.string())):
            own = distinct_grams(data, offsets, k)
            keys.append(own[0])
            owner.append(own[1] + first)
        if not keys:
            continue
        shared = spark.sparkContext.broadcast(ItemIndex(names, np.concatenate(keys), np.concatenate(owner)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, item_type=item_type) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = []
                for first, last, data, offsets in slices(batch.column(1)):
                    keys, owner = distinct_grams(data, offsets, k)
                    if len(keys):
                        rows += [(first + t, i, c) for t, i, c in index.search(keys, owner, last - first, threshold)]
                if rows:
                    texts, which, common = (np.array(x) for x in zip(*rows, strict=True))
                    sizes = index.sizes[which]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(texts)), pa.array([index.names[i] for i in which], item_type), pa.array(sizes, pa.int64()), pa.array(common / sizes)], names=schema.names)

        pairs = docs.select(id_column, text).mapInArrow(run, schema)
        found = pairs if found is None else found.unionAll(pairs)
    return found if found is not None else spark.createDataFrame([], schema)
