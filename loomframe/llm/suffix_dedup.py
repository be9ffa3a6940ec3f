"""Repeated strings of bytes, found by a suffix array that a distributed difference-cover algorithm sorts.

Texts are parsed into phrases that end at content-defined anchors, so that equal strings are parsed alike wherever they
lie. Phrases whose surroundings occur once in the corpus can't lie in a repeat and are set aside. The suffixes of what is
left are sorted by difference cover: triples at two of three places are sorted and named, the names' own suffixes are
sorted in the same way, the remaining third is merged in, and each suffix's prefix is compared with its neighbours'. What
isn't a neighbour's as a whole, the ends of repeats above all, is then settled window by window, by hash: the suffix order
spares most windows inside repeats, but what it doesn't spare the hashes decide.

Phrases lie packed in as many groups of documents as there are shuffle partitions. In every step a group asks the owners
of ranges about its distinct triples, ranks or keys, and gets packed answers back in its own order: what occurs in a third
of all documents is asked about once by each group, whatever range it falls in.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, partitions, prefix_hash, slices, span_hash, squeeze, unsqueeze
from .shared_keys import share_of

#: Bytes of an anchor, mean bytes between anchors, and bytes of a repeat before its first anchor that a phrase covers.
GRAM, EVERY = 12, 40
#: Anchors that a mapper gathers before it sorts them and sends them on.
BLOCK = 1_000_000
#: A packed row: the partition it goes to, who sends it or of what kind it is, and its columns.
_WIRE = "target int, sender int, data array<binary>"
#: Kinds of phrases and lone windows on their way; and as known to be repeated.
_PHRASE, _LONE, _SHARED = 0, 1, 2
#: Triples that each group of documents gives as bounds of ranges to choose from.
SAMPLE = 64
#: Questions that the owner of a range answers, about; and the fewest ranges, so that small steps are shared out too.
RANGE, FEWEST = 100_000, 8
Arrays = list[np.ndarray]


def phrases(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Phrases and lone windows of texts (places relative to each text).

    owner, start, anchor of every phrase: an anchor and the window starts for which it is the first anchor, at most
    ``reach`` of them. lone_owner, lone: window starts without an anchor within ``reach``. running: prefix hashes.
    """
    reach = length - length * 9 // 25
    n = len(data)
    running = prefix_hash(data)
    at = np.arange(max(0, n - GRAM + 1))
    grams = span_hash(running, at, at + GRAM)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(at)]
    anchors = np.flatnonzero((grams % np.uint64(EVERY) == 0) & (at + GRAM <= ends))
    owner = np.searchsorted(offsets, anchors, "right") - 1
    before = np.r_[np.int64(-1), anchors[:-1]]
    first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
    start = np.maximum(np.where(first, offsets[owner], before + 1), anchors - reach + 1)
    fits = (start + length <= offsets[owner + 1]) & (anchors + length - reach <= offsets[owner + 1])
    # a window is lone if the next anchor of its text is reach bytes away or more
    starts = np.arange(n)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    following = np.searchsorted(anchors, starts)
    near = np.where(following < len(anchors), anchors[np.minimum(following, len(anchors) - 1)] if len(anchors) else n, 2 * n + reach)
    lone = np.flatnonzero((near - starts >= reach) & (starts + length <= offsets[text + 1])) if n else starts
    return {"owner": owner[fits], "start": start[fits], "anchor": anchors[fits], "lone": lone, "lone_owner": text[lone] if n else lone, "running": running}


def _wired(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (target, sender, columns of whole numbers or ready bytes) packed for an exchange."""

    def batch() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["target", "sender", "data"])

    held, size = [], 0
    for target, sender, columns in rows:
        data = [c if isinstance(c, bytes) else squeeze(c.astype(np.int64, copy=False)) for c in columns]
        held.append((int(target), int(sender), data))
        size += sum(map(len, data))
        if size > 16 << 20 or len(held) >= 2048:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, list[bytes]]]]]:
    """Each target of a partition with its packed rows, in the senders' order."""
    found = defaultdict(list)
    for batch in batches:
        for target, sender, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found[target].append((sender, data))
    for target in sorted(found):
        yield target, sorted(found.pop(target), key=lambda row: row[0])


def _open(data: list[bytes]) -> Arrays:
    return [unsqueeze(d, np.int64) for d in data]


def _joined(rows: list[list[bytes]], width: int) -> Arrays:
    """The columns of several packed rows, end to end."""
    opened = [_open(r) for r in rows]
    return [np.concatenate([np.zeros(0, np.int64), *(r[i] for r in opened)]) for i in range(width)]


def _cuts(target: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last + 1 of each run of equal targets."""
    edges = np.flatnonzero(np.r_[True, target[1:] != target[:-1], True]) if len(target) else np.zeros(0, int)
    return zip(edges[:-1], edges[1:], strict=True)


def _split(target: np.ndarray, sender: int, columns: Arrays) -> Iterator[tuple]:
    """A row for each target, in which places keep their order."""
    order = np.argsort(target, kind="stable")
    target, columns = target[order], [c[order] for c in columns]
    for a, b in _cuts(target):
        yield target[a], sender, [c[a:b] for c in columns]


def _distinct(columns: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of distinct rows of the columns, each row's number among them, and how often each occurs."""
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = mix(key * np.uint64(3) + c.view(np.uint64))
    _, first, number, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return first, number, times


def _not_after(others: Arrays, keys: Arrays) -> np.ndarray:
    """For each row of ``keys``, how many of ``others`` come before it or are equal to it."""
    n = len(others[0])
    mine = np.r_[np.zeros(n, np.int8), np.ones(len(keys[0]), np.int8)]
    order = np.lexsort((mine, *(np.r_[a, b] for a, b in zip(reversed(others), reversed(keys), strict=True))))
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(1 - mine[order])
    return out[n:]


def _group_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return share_of(mix(doc.view(np.uint64)), parts)


def _ranges(questions: int, parts: int) -> int:
    """How many ranges so many questions are dealt to: not more than they need, as each group writes each range a row."""
    return min(parts, max(FEWEST, questions // RANGE + 1))


def _bounds(samples: DataFrame, width: int, parts: int, by: tuple[int, ...]) -> Arrays:
    """Bounds of ranges chosen from samples of SAMPLE rows at most for each group of documents; last, how many it asks about."""
    rows = [r[0] for r in samples.select("data").collect()]
    columns = _joined(rows, width)
    order = np.lexsort([columns[i] for i in reversed(by)])
    ranges = _ranges(int(_joined([r[width:] for r in rows], 1)[0].sum()), parts)
    some = order[(np.arange(1, ranges) * len(order)) // ranges] if len(order) else order
    return [c[some] for c in columns]


def _consult(state: DataFrame, ask: Callable[[Arrays], tuple[np.ndarray, Arrays]], answer: Callable[[int, np.ndarray, Arrays], Arrays], conclude: Callable[[int, Arrays, Arrays], Arrays]) -> DataFrame:
    """Every group's new state after the owners of ranges have answered it.

    ``ask(state)``: the owner of each of its questions, and their columns. ``answer(owner, asker, columns)``: columns of
    answers, a row a question. ``conclude(group, state, answers)``: the new state; answers lie in the questions' order.
    """
    parts = partitions(state.sparkSession)

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for target, found in _read(batches):
                yield from _split(*(lambda owner, columns: (owner, target, columns))(*ask(_open(found[0][1]))))

        yield from _wired(rows())

    def answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for owner, found in _read(batches):
                columns = _joined([data for _, data in found], len(found[0][1]))
                sizes = [len(unsqueeze(data[0], np.int64)) for _, data in found]
                askers = np.repeat(np.array([sender for sender, _ in found]), sizes)
                replies = answer(owner, askers, columns)
                for a, b in _cuts(askers):
                    yield askers[a], owner, [r[a:b] for r in replies]

        yield from _wired(rows())

    def concluding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for target, found in _read(batches):
                held = _open(found[0][1])
                owner, questions = ask(held)
                order = np.argsort(owner, kind="stable")
                replies = _joined([data for _, data in found[1:]], len(found[1][1]) if len(found) > 1 else 0)
                for i, r in enumerate(replies):
                    replies[i] = np.empty(len(order), np.int64)
                    replies[i][order] = r
                yield target, -1, conclude(target, held, replies)

        yield from _wired(rows())

    answers = state.mapInArrow(asking, _WIRE).repartitionById(parts, F.col("target")).mapInArrow(answering, _WIRE)
    return cut(state.union(answers).repartitionById(parts, F.col("target")).mapInArrow(concluding, _WIRE))


def _each(state: DataFrame, make: Callable[[int, Arrays], Arrays]) -> DataFrame:
    """``make(group, state)`` for every group, where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _wired((target, -1, make(target, _open(found[0][1]))) for target, found in _read(batches))

    return state.mapInArrow(run, _WIRE)


def _only(state: DataFrame, *fields: int) -> DataFrame:
    return state.select("target", "sender", F.array(*(F.get("data", F.lit(i)) for i in fields)).alias("data"))


def _at(names: np.ndarray, i: np.ndarray) -> np.ndarray:
    return np.r_[names, 0][np.minimum(i, len(names))]


def _sampled(n: int) -> np.ndarray:
    """Places 1, 4, 7, ..., then 2, 5, 8, ...."""
    return np.r_[np.arange(1, n, 3), np.arange(2, n, 3)]


def _triples(names: np.ndarray) -> tuple[Arrays, np.ndarray, np.ndarray]:
    """Distinct triples at the sampled places, each place's number among them, and how often each occurs."""
    at = _sampled(len(names))
    columns = [_at(names, at + k) for k in range(3)]
    first, number, times = _distinct(columns)
    return [c[first] for c in columns], number, times


def _some(columns: Arrays, target: int, asked: int) -> Arrays:
    """A sample of the rows, and the number of a group's questions."""
    n = len(columns[0])
    at = np.random.default_rng([target, n]).choice(n, min(n, SAMPLE), replace=False)
    return [*(c[at] for c in columns), np.array([asked])]


def _named(sequences: DataFrame) -> tuple[DataFrame, int]:
    """The sampled triples' names by group, in the order of ``_sampled`` with a gap of 0, and how many aren't alone."""
    parts = partitions(sequences.sparkSession)

    def some(target: int, held: Arrays) -> Arrays:
        triples, _, _ = _triples(held[0])
        return _some(triples, target, len(triples[0]))

    bounds = _bounds(_each(sequences, some), 3, parts, (0, 1, 2))

    def ask(held: Arrays) -> tuple[np.ndarray, Arrays]:
        triples, _, _ = _triples(held[0])
        return _not_after(bounds, triples), triples

    def answer(owner: int, askers: np.ndarray, t: Arrays) -> Arrays:
        order = np.lexsort((t[2], t[1], t[0]))
        new = np.r_[True, np.any([c[order][1:] != c[order][:-1] for c in t], axis=0)]
        name = np.empty(len(order), np.int64)
        name[order] = np.cumsum(new)
        return [(owner << 40) + name, np.bincount(name)[name]]

    def conclude(target: int, held: Arrays, replies: Arrays) -> Arrays:
        _, number, times = _triples(held[0])
        if not replies:
            return [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        names, ones = replies[0][number], len(range(1, len(held[0]), 3))
        return [np.r_[names[:ones], 0, names[ones:]], np.array([((replies[1] > 1) | (times > 1))[number].sum()])]

    found = _consult(sequences, ask, answer, conclude)
    return _only(found, 0), sum(int(_open(r[0])[0].sum()) for r in _only(found, 1).select("data").collect())


def _suffixes(held: Arrays) -> tuple[Arrays, np.ndarray]:
    """Distinct suffixes as (i % 3, first two names, own rank, ranks of the next two), and each place's number among them."""
    names, ranked = held
    n = len(names)
    rank = np.zeros(n + 3, np.int64)
    rank[_sampled(n)] = np.delete(ranked, len(range(1, n, 3)))
    i = np.arange(n)
    columns = [i % 3, names, _at(names, i + 1), rank[:n], rank[1 : n + 1], rank[2 : n + 2]]
    # what isn't compared isn't kept: a sampled suffix is told from another by its own rank
    columns[4], columns[5] = np.where(i % 3 == 2, 0, columns[4]), np.where(i % 3 == 1, 0, columns[5])
    first, number, _ = _distinct(columns)
    return [c[first] for c in columns], number


def _order_key(m: int) -> tuple[int, ...]:
    """Columns by which a sampled suffix of kind ``m`` is compared with an unsampled one."""
    return (1, 4) if m < 2 else (1, 2, 5)


def _merged(sequences: DataFrame, ranked: DataFrame) -> DataFrame:
    """Ranks of all suffixes by group: the unsampled third merged into the sampled ones, whose ranks are given."""
    parts = partitions(sequences.sparkSession)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _wired((target, -1, [found[1][1][0], found[0][1][0]]) for target, found in _read(batches))

    both = cut(sequences.union(ranked.withColumn("sender", F.lit(-2))).repartitionById(parts, F.col("target")).mapInArrow(together, _WIRE))

    def unsampled(target: int, held: Arrays) -> Arrays:
        c, _ = _suffixes(held)
        return _some([x[c[0] == 0] for x in c], target, len(c[0]))

    bounds = _bounds(_each(both, unsampled), 6, parts, (1, 4))

    def ask(held: Arrays) -> tuple[np.ndarray, Arrays]:
        c, _ = _suffixes(held)
        owner = np.zeros(len(c[0]), np.int64)
        for m in range(3):
            here = np.flatnonzero(c[0] == m)
            owner[here] = _not_after([bounds[k] for k in _order_key(m)], [c[k][here] for k in _order_key(m)])
        return owner, c

    def answer(owner: int, askers: np.ndarray, c: Arrays) -> Arrays:
        first, number, _ = _distinct(c)
        c = [x[first] for x in c]
        sampled, rest = np.flatnonzero(c[0] != 0), np.flatnonzero(c[0] == 0)
        sampled = sampled[np.argsort(c[3][sampled], kind="stable")]
        rest = rest[np.lexsort((c[4][rest], c[1][rest]))]
        before = np.zeros(len(rest), np.int64)
        for m in (1, 2):
            some = sampled[c[0][sampled] == m]
            before += _not_after([c[k][some] for k in _order_key(m)], [c[k][rest] for k in _order_key(m)])
        place = np.empty(len(first), np.int64)
        place[rest] = np.arange(len(rest)) + before
        place[sampled] = np.arange(len(sampled)) + np.searchsorted(before, np.arange(len(sampled)), "right")
        return [(owner << 40) + place[number] + 1]

    def conclude(target: int, held: Arrays, replies: Arrays) -> Arrays:
        return [replies[0][_suffixes(held)[1]]]

    return _consult(both, ask, answer, conclude)


def _ranks(sequences: DataFrame, enough: int, depth: int = 1) -> DataFrame:
    """Ranks of the suffixes of every group's sequence, ordered by their first ``enough`` names at least."""
    names, shared = _named(sequences)
    ranked = _ranks(names, enough, depth * 3) if depth * 3 < enough and shared else names
    return _merged(sequences, ranked)


def suffix_ranks(sequences: DataFrame, enough: int) -> DataFrame:
    """doc, ranks (array): ranks of all suffixes of the sequences (doc, names: array of positive longs).

    Ranks are ordered by what the suffixes start with; ``enough`` is the number of names beyond which it doesn't matter.
    Suffixes end with their sequence.
    """
    parts = partitions(sequences.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                docs = np.asarray(batch.column(0), np.int64)
                for doc, target, names in zip(docs, _group_of(docs, parts), batch.column(1).to_pylist(), strict=True):
                    yield target, 0, [np.array([doc]), np.array(names, np.int64)]

        yield from _wired(rows())

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for target, found in _read(batches):
                each = [_open(data) for _, data in found]
                ends = [np.array([-1 - (target << 32) - i]) for i in range(len(each))]
                yield target, -1, [np.concatenate([np.r_[e[1], end] for e, end in zip(each, ends, strict=True)]), np.array([e[0][0] for e in each]), np.array([len(e[1]) for e in each])]

        yield from _wired(rows())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _read(batches):
            (ranks,), (_, docs, sizes) = (_open(data) for _, data in found)
            firsts = np.cumsum(sizes + 1) - sizes - 1
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array([ranks[a : a + n].tolist() for a, n in zip(firsts, sizes, strict=True)], pa.list_(pa.int64()))], names=["doc", "ranks"])

    groups = cut(sequences.select("doc", "names").mapInArrow(send, _WIRE).repartitionById(parts, F.col("target")).mapInArrow(group, _WIRE))
    ranks = _ranks(_only(groups, 0), enough).withColumn("sender", F.lit(-2))
    return ranks.union(groups).repartitionById(parts, F.col("target")).mapInArrow(spread, "doc long, ranks array<long>")


def _sent(kind: int, columns: Arrays, parts: int) -> Iterator[tuple]:
    """Keys (column 0) and what belongs to them (the document in column 1) of one block, on their way to where repeats are found.

    Keys that the block has twice are known to be repeated: they go on to their documents, one entry tells the others.
    """
    order = np.argsort(columns[0], kind="stable")
    key, rest = columns[0][order], [c[order] for c in columns[1:]]
    new = np.r_[True, key[1:] != key[:-1]]
    run = np.cumsum(new) - 1
    often = np.bincount(run)[run] > 1
    one = ~often | new
    flagged = (key[one] & ~np.uint64(1)) | often[one]
    yield from _split(share_of(key[one], parts), kind, [flagged.view(np.int64), *(r[one] for r in rest)])
    yield from _split(_group_of(rest[0][often], parts), kind + _SHARED, [key[often].view(np.int64), *(r[often] for r in rest)])


def _shared(sent: DataFrame) -> DataFrame:
    """Packed by group of documents: what is sent whose key occurs twice (kind + _SHARED)."""
    parts = partitions(sent.sparkSession)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(list)
        for batch in batches:
            kinds = np.asarray(batch.column(1))
            for i in np.flatnonzero(kinds < _SHARED):
                held[int(kinds[i])].append(batch.column(2)[int(i)].as_py())
            if (kinds >= _SHARED).any():
                yield batch.filter(pa.array(kinds >= _SHARED))
        for kind, rows in held.items():
            columns = _joined(rows, len(rows[0]))
            key = columns[0].view(np.uint64)
            known, key = (key & np.uint64(1)).astype(bool), key & ~np.uint64(1)
            order = np.argsort(key, kind="stable")
            run = np.cumsum(np.r_[True, key[order][1:] != key[order][:-1]]) - 1
            again = order[(np.bincount(run)[run] > 1) & ~known[order]]
            yield from _wired(_split(_group_of(columns[1][again], parts), kind + _SHARED, [c[again] for c in columns]))

    return sent.repartitionById(parts, F.col("target")).mapInArrow(resolve, _WIRE)


def _flush(held: dict[int, list[Arrays]], parts: int) -> Iterator[pa.RecordBatch]:
    for kind, blocks in held.items():
        yield from _wired(_sent(kind, [np.concatenate(c) for c in zip(*blocks, strict=True)], parts))


def _phrases(docs: DataFrame, length: int) -> DataFrame:
    """By group: names and breaks of its shared phrases in a row, and the phrases' doc, start, anchor, key, prefix and place.

    Fields: 0 names, 1 doc, 2 start, 3 anchor, 4 key, 5 prefix (0: its 400 bytes don't fit), 6 place among the names,
    7 and 8 doc and start of repeated lone windows, 9 the most names that a prefix spans, and the number of phrases, 10 the
    hashes of the lone windows.
    """
    parts, around = partitions(docs.sparkSession), length * 9 // 25

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            for first, _, data, offsets in slices(batch.column(1)):
                p = phrases(data, offsets, length)
                running, o, s, a = p["running"], p["owner"], p["start"], p["anchor"]
                if len(o):
                    own = span_hash(running, s, a + 1) >> np.uint64(1)
                    fits = a + length <= offsets[o + 1]
                    prefix = np.where(fits, span_hash(running, s, np.where(fits, a + length, a)) | np.uint64(1), np.uint64(0))
                    held[_PHRASE].append([span_hash(running, a, a + around), ids[first:][o], s - offsets[o], a - offsets[o], own.view(np.int64), prefix.view(np.int64)])
                o, s = p["lone_owner"], p["lone"]
                if len(o):
                    held[_LONE].append([span_hash(running, s, s + length), ids[first:][o], s - offsets[o]])
                size += len(p["owner"]) + len(o)
                if size >= BLOCK:
                    yield from _flush(held, parts)
                    held, size = defaultdict(list), 0
        yield from _flush(held, parts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for target, found in _read(batches):
                key, doc, start, anchor, own, prefix = _joined([d for k, d in found if k == _PHRASE + _SHARED], 6)
                lone = _joined([d for k, d in found if k == _LONE + _SHARED], 3)
                order = np.lexsort((start, doc))
                key, doc, start, anchor, own, prefix = (c[order] for c in (key, doc, start, anchor, own, prefix))
                key &= ~1
                # before a phrase that doesn't follow on the last one stands a name of its own, and one at the end
                gap = np.r_[False, (doc[1:] != doc[:-1]) | (start[1:] != anchor[:-1] + 1)][: len(doc)]
                place = np.arange(len(doc)) + np.cumsum(gap)
                names = -1 - (target << 32) - np.arange(len(doc) + gap.sum() + 1)
                names[place] = own + 1
                group = np.cumsum(np.r_[False, doc[1:] != doc[:-1]])[: len(doc)] << 32
                spanned = np.searchsorted(group + start, group + anchor + length) - np.arange(len(doc))
                yield target, -1, [names, doc, start, anchor, key, prefix, place, lone[1], lone[2], np.array([2 * spanned.max(initial=0) + 2, len(doc)]), lone[0]]

        yield from _wired(rows())

    return cut(_shared(docs.mapInArrow(send, _WIRE)).repartitionById(parts, F.col("target")).mapInArrow(gather, _WIRE))


def _judged(found: DataFrame, enough: int) -> DataFrame:
    """By group: doc, start, anchor, key, prefix of its phrases, and whether their prefixes are those of neighbours."""
    parts = partitions(found.sparkSession)
    ranked = _ranks(_only(found, 0), enough)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for target, rows in _read(batches):
            (ranks,), columns = (_open(data) for _, data in rows)
            yield from _wired(iter([(target, -1, [*columns[:5], ranks[columns[5]]])]))

    both = ranked.withColumn("sender", F.lit(-2)).union(_only(found, 1, 2, 3, 4, 5, 6))
    state = cut(both.repartitionById(parts, F.col("target")).mapInArrow(placed, _WIRE))

    def ask(held: Arrays) -> tuple[np.ndarray, Arrays]:
        first, _, times = _distinct([held[5], held[4]])
        rank = held[5][first]
        return rank >> 40, [rank, held[4][first], times]

    def answer(owner: int, askers: np.ndarray, c: Arrays) -> Arrays:
        first, number, _ = _distinct(c[:2])
        rank, prefix = (x[first] for x in c[:2])
        many = np.bincount(number, c[2]) > 1
        order = np.lexsort((prefix, rank))
        same = prefix[order][1:] == prefix[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[order] = (np.r_[False, same] | np.r_[same, False])[: len(order)]
        return [((twice | many) & (prefix != 0))[number]]

    def conclude(target: int, held: Arrays, replies: Arrays) -> Arrays:
        return [*held[:5], replies[0][_distinct([held[5], held[4]])[1]] if replies else held[4]]

    return _consult(state, ask, answer, conclude)


def _asked(judged: DataFrame, ranges: int) -> DataFrame:
    """By group: doc, start, anchor of the phrases whose windows are to be settled one by one.

    They are those that aren't repeated as a whole, and one copy of each repeated one that has surroundings in common.
    """

    def questions(held: Arrays) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (key, prefix or 0 where not repeated): their places, and each phrase's number."""
        first, number, _ = _distinct([held[3], held[4] * held[5]])
        return first, number

    def ask(held: Arrays) -> tuple[np.ndarray, Arrays]:
        first, _ = questions(held)
        key = held[3][first]
        return share_of(key.view(np.uint64), ranges), [key, (held[4] * held[5])[first]]

    def answer(owner: int, askers: np.ndarray, c: Arrays) -> Arrays:
        key, prefix = c
        _, number = np.unique(key, return_inverse=True)
        wanted = np.bincount(number, prefix == 0)[number] > 0
        first, _, _ = _distinct(c)
        chosen = np.zeros(len(key), bool)
        chosen[first] = True
        return [(prefix == 0) | (wanted & chosen)]

    def conclude(target: int, held: Arrays, replies: Arrays) -> Arrays:
        if not replies:
            return held[:3]
        first, _ = questions(held)
        picked = np.zeros(len(held[0]), bool)
        picked[first] = replies[0].astype(bool)
        picked |= held[5] == 0
        return [c[picked] for c in held[:3]]

    return _consult(judged, ask, answer, conclude)


def _bodies(docs: DataFrame) -> DataFrame:
    """All texts, compressed by group of documents: doc, bytes, text."""
    import zstandard

    parts = partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)

        def rows() -> Iterator[tuple]:
            for target, texts in held.items():
                raw = [t for _, t in texts]
                yield target, 0, [np.array([d for d, _ in texts]), np.array([len(t) for t in raw]), packer.compress(b"".join(raw))]

        held, size = defaultdict(list), 0
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            for doc, target, text in zip(ids.tolist(), _group_of(ids, parts).tolist(), batch.column(1), strict=True):
                held[target].append((doc, (text.as_py() or "").encode()))
                size += len(held[target][-1][1]) + 64
                if size >= 32 << 20:
                    yield from _wired(rows())
                    held, size = defaultdict(list), 0
        yield from _wired(rows())

    return docs.mapInArrow(send, _WIRE)


def _texts(found: list[tuple[int, list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, offsets and bytes of each block of a group's texts."""
    import zstandard

    for sender, data in found:
        if sender == 0:
            doc, sizes = _open(data[:2])
            yield doc, np.r_[0, np.cumsum(sizes)], np.frombuffer(zstandard.ZstdDecompressor().decompress(data[2]), np.uint8)


def _of_block(doc: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``owners`` lie in a block of documents, and their documents' numbers in it; a pair for each row of an id."""
    order = np.argsort(doc, kind="stable")
    low, high = np.searchsorted(doc[order], owners), np.searchsorted(doc[order], owners, "right")
    n = high - low
    inside = np.repeat(np.arange(len(owners)), n)
    return inside, order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _windows(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """Packed by group: repeated windows (key, doc, start) among those that start within the phrases asked about."""
    parts = partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for _, found in _read(batches):
            phrase = _joined([data for sender, data in found if sender < 0], 3)
            for doc, offsets, data in _texts(found):
                inside, at = _of_block(doc, phrase[0])
                if not len(inside):
                    continue
                n = phrase[2][inside] - phrase[1][inside] + 1
                owner = np.repeat(at, n)
                start = np.repeat(phrase[1][inside] - np.cumsum(n) + n, n) + np.arange(n.sum()) + offsets[owner]
                fits = start + length <= offsets[owner + 1]
                owner, start = owner[fits], start[fits]
                if len(np.unique(doc)) < len(doc):  # rows of one id are asked about each other's phrases too
                    once = np.unique(start, return_index=True)[1]
                    owner, start = owner[once], start[once]
                held[_LONE].append([span_hash(prefix_hash(data), start, start + length), doc[owner], start - offsets[owner]])
                size += len(start)
                if size >= BLOCK:
                    yield from _flush(held, parts)
                    held, size = defaultdict(list), 0
        yield from _flush(held, parts)

    return _shared(asked.union(_bodies(docs)).repartitionById(parts, F.col("target")).mapInArrow(send, _WIRE))


def remove_repeats(docs: DataFrame, length: int = 400, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text without the bytes of any ``length``-byte string that also starts elsewhere, in it or in another text.

    Columns: the id, n_bytes, n_removed, n_spans (maximal removed runs), spans (array of start, end in bytes), kept
    (binary, the bytes that stay), longest_shared: the longest stretch, in bytes, of strings of nine twenty-fifths of
    ``length`` at anchors that occur elsewhere too, so that repeats which are too short to go show there. Repeats may
    overlap, don't cross texts, and are judged on the input. A null text is empty; texts shorter than ``length`` stay
    whole; an empty table gives an empty result; rows with a null id are left out; rows that share an id are texts of
    their own, each with a result; further columns aren't read. Places are counted in UTF-8 bytes.
    """
    parts = partitions(docs.sparkSession)
    docs = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
    found = _phrases(docs, length)
    facts = [_open(r[0])[0] for r in _only(found, 9).select("data").collect()]
    judged = _judged(found, max((int(f[0]) for f in facts), default=0))
    windows = _windows(docs, _asked(judged, _ranges(sum(int(f[1]) for f in facts), parts)), length)

    def spans(target: int, held: Arrays) -> Arrays:
        twice = held[5] != 0
        return [held[0][twice], held[1][twice], held[2][twice] + length, held[4][twice]]

    lone = _each(_only(found, 7, 8, 10), lambda target, held: [held[0], held[1], held[1] + length, held[2]])
    settled = windows.select("target", F.lit(-2).alias("sender"), "data")
    shared = _only(found, 1, 3).withColumn("sender", F.lit(-3))
    around = length * 9 // 25
    result = "doc long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary, longest_shared long"

    def runs(covered: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8))).reshape(-1, 2)

    def covered(doc: np.ndarray, offsets: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray, fits=None) -> np.ndarray:
        """Bytes of a block that lie in the spans of its documents."""
        inside, at = _of_block(doc, owner)
        if fits is not None:
            right = fits(inside, at)
            inside, at = inside[right], at[right]
        size = np.diff(offsets)[at]
        depth = np.zeros(offsets[-1] + 1, np.int64)
        np.add.at(depth, offsets[at] + np.minimum(start[inside], size), 1)
        np.add.at(depth, offsets[at] + np.minimum(end[inside], size), -1)
        return np.cumsum(depth[:-1]) > 0

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _read(batches):
            ready = _joined([data for sender, data in rows if sender == -1], 4)
            single = _joined([data for sender, data in rows if sender == -2], 3)
            owner, start, end, key = (np.concatenate(c) for c in zip(ready, (single[1], single[2], single[2] + length, single[0]), strict=True))
            near = _joined([data for sender, data in rows if sender == -3], 2)
            for doc, offsets, data in _texts(rows):
                fits = None
                if len(np.unique(doc)) < len(doc):  # of the rows of one id those that hold the string at the place
                    running = prefix_hash(data)

                    def fits(inside: np.ndarray, at: np.ndarray, offsets=offsets, running=running) -> np.ndarray:
                        a, b = offsets[at] + start[inside], offsets[at] + end[inside]
                        whole = b <= offsets[at + 1]
                        found = span_hash(running, np.where(whole, a, 0), np.where(whole, b, 0))
                        return whole & ((found ^ key[inside].view(np.uint64)) >> np.uint64(1) == 0)

                gone = covered(doc, offsets, owner, start, end, fits)
                also = covered(doc, offsets, near[0], near[1], near[1] + around)
                out = []
                for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    mine = gone[a:b]
                    cut_out = runs(mine)
                    longest = int(np.diff(runs(also[a:b])).max(initial=0))
                    out.append((int(doc[i]), int(b - a), int(mine.sum()), len(cut_out), [{"start": x, "end": y} for x, y in cut_out.tolist()], data[a:b][~mine].tobytes(), longest))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc", "n_bytes", "n_removed", "n_spans", "spans", "kept", "longest_shared"])

    known = _each(judged, spans).union(lone).union(settled).union(shared)
    return known.union(_bodies(docs)).repartitionById(parts, F.col("target")).mapInArrow(keep, result).withColumnRenamed("doc", id_column)
