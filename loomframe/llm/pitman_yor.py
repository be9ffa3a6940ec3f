"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling, and the texts' probabilities under it.

The context of a token is the word before it, each with a restaurant of its own. All of them share one
parent, the restaurant of single words, whose base is uniform over the vocabulary and one unknown word. A restaurant's
tables for a word are customers of the parent. In a sweep all who have one dish in one restaurant leave their tables and
are seated again, one after the other, given everybody else; what others do in the same sweep is known from the last one.

Tokens are dealt to the executors by word, so that all restaurants' seats for one word, and the word's own in the parent,
lie in one place; the end, which every text has, is dealt by context. What a sweep needs from elsewhere are the totals of
the restaurants, of which a part asks for those of its own contexts, and a few numbers on all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, partitions, slices, squeeze, unsqueeze, words
from .shared_keys import share_of

#: Tokens that a mapper gathers before it sorts them and sends them on.
BLOCK = 1_000_000
#: Hash of a text's end, which is also what stands before its first word.
END = np.uint64(0x243F6A8885A308D3)
#: Customers come in groups, of so many times fewer than are seated already, one at least.
SHARE = 16


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context (the hash before it) and text of every token: a text's words, then its end."""
    hashes, owner, _, _ = words(data, offsets)
    n = np.bincount(owner, minlength=len(offsets) - 1) + 1
    ends = np.cumsum(n) - 1
    token = np.full(int(n.sum()), END)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = hashes
    return token, np.r_[END, token[:-1]], np.repeat(np.arange(len(n)), n)


def chance(keys: np.ndarray, sweep: int, seated: int) -> np.ndarray:
    """Numbers from 0 to 1 that depend on the keys, the sweep and the place in it alone, wherever they are drawn."""
    return (mix(keys + mix(np.array([sweep * 0x9E3779B9 + seated + 1], np.uint64))) >> np.uint64(11)) / float(1 << 53)


def seat(customers: np.ndarray, weight, discount: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """Tables at which each dish's customers sit, drawn as they come in; weight(which, tables): that of a new table."""
    tables = np.minimum(customers, 1)
    at = np.flatnonzero(customers > 1)
    seated = 1
    while len(at):
        group = np.minimum(max(1, seated // SHARE), customers[at] - seated)
        new = weight(at, tables[at])
        new = new / (new + seated + (group - 1) / 2 - discount * tables[at])
        tables[at] += np.floor(group * new + chance(keys[at], sweep, seated)).astype(np.int64)
        seated += max(1, seated // SHARE)
        at = at[customers[at] > seated]
    return tables


class Seats:
    """The types (word and context) of one part of the vocabulary, with the tables of each sample so far."""

    def __init__(self, words_of: np.ndarray, types_of_word: np.ndarray, known: np.ndarray, context: np.ndarray, customers: np.ndarray) -> None:
        self.known, self.context, self.customers, self.words = known, context.astype(np.int64), customers, words_of
        self.word = np.repeat(np.arange(len(types_of_word)), types_of_word)
        self.heads = np.cumsum(types_of_word) - types_of_word
        self.keys = mix(words_of)[self.word] + mix(known + np.uint64(1))[self.context]
        self.end = words_of == END

    def parents(self, tables: np.ndarray, of_end: int | None = None) -> np.ndarray:
        """Customers of the parent restaurant: the tables of all contexts for each word; those of the end are given."""
        found = np.add.reduceat(tables, self.heads) if len(self.heads) else np.zeros(0, np.int64)
        return found if of_end is None else np.where(self.end, of_end, found)

    def by_context(self, numbers: np.ndarray) -> np.ndarray:
        """Sums over the types of each context, in the order of ``known``."""
        return np.bincount(self.context, numbers, len(self.known)).astype(np.int64)


_KINDS = {"words": np.uint64, "types_of_word": np.int32, "known": np.uint64, "context": np.uint32, "customers": np.int64, "tokens_of_type": np.int32, "doc": np.int64, "n": np.int32, "tables": np.int64, "parent_tables": np.int64, "context_customers": np.int64, "context_tables": np.int64}


def _unpacked(cells: dict[str, bytes]) -> dict[str, np.ndarray]:
    found = {name: unsqueeze(cell, _KINDS[name]) for name, cell in cells.items() if name in _KINDS}
    return found | {"known": np.cumsum(found["known"], dtype=np.uint64)}


def _met(frames: list[DataFrame], make: Callable[[int, dict[str, bytes]], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``make(target, cells)`` gives for each part of the vocabulary, whose packed cells the frames hold; a task has one part only."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, bytes] = {}
        target = None
        for batch in batches:
            target = batch.column("target")[0].as_py()
            for name in batch.schema.names:
                if name != "target":
                    cells |= {name: value.as_py() for value in batch.column(name).drop_null()}
            del batch
        if target is not None:
            yield make(target, cells)

    return whole.repartitionById(partitions(whole.sparkSession), F.col("target")).mapInArrow(run, schema)


def _steps(numbers: np.ndarray) -> bytes:
    """Numbers in order, packed as differences."""
    return squeeze(np.diff(numbers, prepend=numbers.dtype.type(0)))


def _dealt(docs: DataFrame, train: Column, id_column: str, text: str) -> DataFrame:
    """One row for each part of the vocabulary: its types with their training counts, and all documents' tokens of them.

    Contexts are numbers among the row's own, which are ``known``, by hash.
    """
    parts = partitions(docs.sparkSession)
    fields = "target int, words binary, tokens_of_word binary, known binary, context binary, doc binary, n binary"
    names = [f.split()[0] for f in fields.split(", ")]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            w, k, d, sign = (np.concatenate(x) for x in held)
            known, k = np.unique(k, return_inverse=True)
            order = np.lexsort((d, k, w))
            w, k, d, sign = w[order], k[order], d[order], sign[order]
            heads = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
            n = np.diff(np.r_[heads, len(w)]).astype(np.int32) * sign[heads]
            w, k, d = w[heads], k[heads], d[heads]
            target = share_of(np.where(w == END, mix(known + np.uint64(1))[k], w), parts)
            order = np.argsort(target, kind="stable")
            w, k, d, n, target = w[order], k[order], d[order], n[order], target[order]
            cuts = np.flatnonzero(np.r_[True, target[1:] != target[:-1], True])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                new = np.flatnonzero(np.r_[True, w[a + 1 : b] != w[a : b - 1]])
                own, number = np.unique(k[a:b], return_inverse=True)
                cells = (w[a:b][new], np.diff(np.r_[new, b - a]).astype(np.int32), np.diff(known[own], prepend=np.uint64(0)), number.astype(np.uint32), d[a:b], n[a:b])
                yield pa.RecordBatch.from_arrays([pa.array([int(target[a])], pa.int32()), *(pa.array([squeeze(c)], pa.binary()) for c in cells)], names=names)

        held: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            signs = np.where(np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool), np.int32(1), np.int32(-1))
            for first, _, data, offsets in slices(batch.column(1)):
                w, k, owner = tokens_of(data, offsets)
                for into, x in zip(held, (w, k, ids[first:][owner], signs[first:][owner]), strict=True):
                    into.append(x)
                if sum(map(len, held[0])) >= BLOCK:
                    yield from flush()
                    held = [[], [], [], []]
        if held[0]:
            yield from flush()

    schema = "target int, words binary, types_of_word binary, known binary, context binary, customers binary, tokens_of_type binary, doc binary, n binary"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], [], [], []]
        target = None
        for batch in batches:
            for row in range(batch.num_rows):
                target = batch.column(0)[row].as_py()
                cells = (unsqueeze(batch.column(i + 1)[row].as_py(), t) for i, t in enumerate((np.uint64, np.int32, np.uint64, np.uint32, np.int64, np.int32)))
                for into, x in zip(held, cells, strict=True):
                    into.append(x)
        if target is None:
            return
        # words and contexts by their numbers among all here
        held[2] = [np.cumsum(x, dtype=np.uint64) for x in held[2]]
        own, known = (np.unique(np.concatenate(held[i])) for i in (0, 2))
        w = np.concatenate([np.repeat(np.searchsorted(own, x).astype(np.uint32), times) for x, times in zip(held[0], held[1], strict=True)])
        k = np.concatenate([np.searchsorted(known, x).astype(np.uint32)[number] for x, number in zip(held[2], held[3], strict=True)])
        d, n = np.concatenate(held[4]), np.concatenate(held[5])
        held.clear()
        order = np.lexsort((d, k, w))
        w, k, d, n = w[order], k[order], d[order], n[order]
        heads = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (k[1:] != k[:-1])])
        cells = (own, np.bincount(w[heads], minlength=len(own)).astype(np.int32), np.diff(known, prepend=np.uint64(0)), k[heads], np.add.reduceat(np.maximum(n, 0).astype(np.int64), heads), np.diff(np.r_[heads, len(w)]).astype(np.int32), d, n)
        yield pa.RecordBatch.from_arrays([pa.array([target], pa.int32()), *(pa.array([squeeze(c)], pa.binary()) for c in cells)], names=[f.split()[0] for f in schema.split(", ")])

    sent = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long"), text, train).mapInArrow(send, fields)
    return cut(sent.repartitionById(parts, F.col("target")).mapInArrow(merge, schema))


def _by_owner(known: np.ndarray, numbers: list[np.ndarray], parts: int) -> list[tuple[int, bytes, bytes]]:
    """Contexts, in order, and their numbers as they go to the owners of the contexts' ranges."""
    to, both = share_of(known, parts), np.stack(numbers)
    cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
    return [(int(to[a]), _steps(known[a:b]), squeeze(both[:, a:b].ravel())) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _totals(sent: DataFrame, width: int) -> DataFrame:
    """What parts (sender) tell an owner of their contexts, summed over all parts and told to each: target, owner, numbers, places.

    ``sent`` holds ``width`` numbers for each of a sender's contexts (numbers), and which contexts these are: by hash (known), or
    where this was told before, by their places among the owner's (places). So a context costs each part that has it one
    entry, and none knows all contexts.
    """
    schema = "target int, owner int, numbers binary, places binary"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[str, dict[int, bytes]] = {"known": {}, "places": {}, "numbers": {}}
        owner = None
        for batch in batches:
            for row in batch.to_pylist():
                owner = row["owner"]
                for name, cells in told.items():
                    if row[name] is not None:
                        cells[row["sender"]] = row[name]
        if owner is None:
            return
        senders = sorted(told["numbers"])
        if told["known"]:
            known = [np.cumsum(unsqueeze(told["known"][x], np.uint64), dtype=np.uint64) for x in senders]
            keys = np.unique(np.concatenate(known))
            places = [np.searchsorted(keys, x).astype(np.uint32) for x in known]
        else:
            places = [np.cumsum(unsqueeze(told["places"][x], np.uint32), dtype=np.uint32) for x in senders]
        totals = np.zeros((width, 1 + max(int(x[-1]) for x in places)), np.int64)
        for sender, at in zip(senders, places, strict=True):
            totals[:, at] += unsqueeze(told["numbers"][sender], np.int64).reshape(width, -1)
        for sender, at in zip(senders, places, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([sender], pa.int32()), pa.array([owner], pa.int32()), pa.array([squeeze(totals[:, at].ravel())], pa.binary()), pa.array([_steps(at)], pa.binary())], names=["target", "owner", "numbers", "places"])

    return cut(sent.select("owner", "sender", "known", "places", "numbers").repartitionById(partitions(sent.sparkSession), F.col("owner")).mapInArrow(add, schema))


def _of_contexts(totals: DataFrame, names: list[str]) -> DataFrame:
    """Totals by part (target): a packed column for each name, in the order of the part's contexts."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = sorted((row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)), key=lambda r: r[1])
        if told:
            numbers = np.concatenate([unsqueeze(row[2], np.int64).reshape(len(names), -1) for row in told], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([told[0][0]], pa.int32()), *(pa.array([squeeze(x)], pa.binary()) for x in numbers)], names=["target", *names])

    told = totals.select("target", "owner", "numbers").repartitionById(partitions(totals.sparkSession), F.col("target"))
    return cut(told.mapInArrow(gather, "target int, " + ", ".join(f"{n} binary" for n in names)))


def _summed(rows: DataFrame, size: int) -> list[int]:
    """Sums of the numbers in the column facts."""
    return list(rows.agg(*(F.coalesce(F.sum(F.get("facts", F.lit(i))), F.lit(0)) for i in range(size))).first())


def score_texts(docs: DataFrame, train: Column, samples: int = 2, burn_in: int = 1, strength: float = 1.0, seed: int = 7, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probability of every text under a model learnt from the rows of ``train``.

    Columns: the id, n_tokens, n_known (in training tokens), train_tokens, base_score (add-one single words), score (mean
    of the samples' predictive probabilities, in log10). A null, empty or blank text has one token, its end. Rows with a
    null id are left out, rows that share an id are one document; null in ``train`` counts as false; without training
    rows both scores are those of the uniform base. An empty table gives an empty result; further columns aren't read.
    Discounts are set from how many types occur once and twice. What is drawn depends on words, contexts and sweeps, not
    on where it is drawn, so that scores are the same, but for rounding, however the rows and partitions lie.
    """
    rows = _dealt(docs, F.coalesce(train, F.lit(False)), id_column, text)
    types = rows.select("target", "words", "types_of_word", "known", "context", "customers")
    parts = partitions(docs.sparkSession)

    def seats_of(c: dict[str, np.ndarray]) -> Seats:
        return Seats(c["words"], c["types_of_word"], c["known"], c["context"], c["customers"])

    def totals(c: dict[str, np.ndarray]) -> list[int]:
        seats = seats_of(c)
        seen = seats.customers > 0
        kinds = seats.parents(seen.astype(np.int64))
        ends, kinds = kinds[seats.end].sum(), kinds[~seats.end]
        return [seen.sum(), (seats.customers == 1).sum(), (seats.customers == 2).sum(), (kinds > 0).sum(), (kinds == 1).sum(), (kinds == 2).sum(), ends, seats.parents(seats.customers)[seats.end].sum(), seats.customers.sum()]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                c = _unpacked({name: batch.column(name)[row].as_py() for name in batch.schema.names})
                seats = seats_of(c)
                owners = _by_owner(seats.known, [seats.by_context(seats.customers), seats.by_context(seats.customers > 0)], parts)
                cells = [pa.array([[x[i] for x in owners]], pa.list_(t)) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([batch.column("target").slice(row, 1), pa.array([[int(x) for x in totals(c)]], pa.list_(pa.int64())), *cells], names=["target", "facts", "owner", "known", "numbers"])

    told = cut(types.mapInArrow(first, "target int, facts array<long>, owner array<int>, known array<binary>, numbers array<binary>"))
    facts = _summed(told, 9)
    end_tables, end_customers, trained = facts[6:]
    # the end is one word, wherever its contexts lie
    facts[3:6] = [n + more for n, more in zip(facts[3:6], (end_tables > 0, end_tables == 1, end_tables == 2), strict=True)]
    size = facts[3]
    owned = _totals(told.select(F.col("target").alias("sender"), F.inline(F.arrays_zip("owner", "known", "numbers"))).withColumn("places", F.lit(None).cast("binary")), 2)
    places = owned.select("owner", F.col("target").alias("sender"), F.lit(None).cast("binary").alias("numbers"), "places")
    asked = _of_contexts(owned, ["context_customers", "context_tables"])
    context_customers, context_tables = asked.select("target", "context_customers"), asked.select("target", "context_tables")
    discounts = [float(np.clip(a / max(1, a + 2 * b), 0.05, 0.95)) for a, b in ((facts[1], facts[2]), (facts[4], facts[5]))]
    uniform = 1.0 / (size + 1)
    state = None
    parent_customers, parent_tables, drawn = facts[0], size, []

    def parent_p(customers: np.ndarray, own: np.ndarray, total: int, all_tables: int) -> np.ndarray:
        return (customers - discounts[1] * own + (strength + discounts[1] * all_tables) * uniform) / (strength + total)

    for sweep in range(burn_in + samples):
        known = (parent_customers, parent_tables, end_tables)

        def draw(target: int, cells: dict[str, bytes], known=known, sweep=sweep) -> pa.RecordBatch:
            total, all_tables, of_end = known
            c = _unpacked(cells)
            seats = seats_of(c)
            before = c.get("tables", np.minimum(seats.customers, 1))
            guests = seats.parents(before, of_end)
            above = c.get("parent_tables", np.minimum(guests, 1))
            # without those who are seated again: others' tables here, the word's other guests above and all others
            others = c["context_tables"][seats.context] - before
            there = guests[seats.word] - before
            base = np.maximum(there - discounts[1] * np.minimum(above[seats.word], there), 0) + (strength + discounts[1] * all_tables) * uniform

            def below(at: np.ndarray, now: np.ndarray, others=others, base=base, before=before) -> np.ndarray:
                return (strength + discounts[0] * (others[at] + now)) * (base[at] + now) / (strength + total - before[at] + now)

            def over(at: np.ndarray, now: np.ndarray, above=above) -> np.ndarray:
                return (strength + discounts[1] * (all_tables - above[at] + now)) * uniform

            after = seat(seats.customers, below, discounts[0], seats.keys, sweep)
            # all parts with contexts of the end draw the same tables for it, from what they all know
            above = seat(seats.parents(after, of_end), over, discounts[1], mix(seats.words), sweep)
            end = above[seats.end]
            sums = [above[~seats.end].sum(), seats.parents(after)[seats.end].sum(), end.sum(), len(end), after.sum()]
            owners = _by_owner(seats.known, [seats.by_context(after)], parts)
            cells = [pa.array([[x[i] for x in owners]], pa.list_(t)) for i, t in ((0, pa.int32()), (2, pa.binary()))]
            return pa.RecordBatch.from_arrays([pa.array([target], pa.int32()), pa.array([squeeze(after)], pa.binary()), pa.array([squeeze(above)], pa.binary()), pa.array([[int(x) for x in sums]], pa.list_(pa.int64())), *cells], names=["target", "tables", "parent_tables", "facts", "owner", "numbers"])

        last = [] if state is None else [state.select("target", "tables", "parent_tables")]
        state = cut(_met([types, context_tables, *last], draw, "target int, tables binary, parent_tables binary, facts array<long>, owner array<int>, numbers array<binary>"))
        others, end_tables, end_above, ends, parent_customers = _summed(state, 5)
        parent_tables = others + end_above // max(1, ends)  # each part with contexts of the end has the same number
        sent = state.select(F.col("target").alias("sender"), F.inline(F.arrays_zip("owner", "numbers"))).withColumn("places", F.lit(None).cast("binary"))
        context_tables = _of_contexts(_totals(sent.unionByName(places).withColumn("known", F.lit(None).cast("binary")), 1), ["context_tables"])
        if sweep >= burn_in:
            i, names = len(drawn), {"tables": "tables", "parent_tables": "above", "context_tables": "of_context"}
            sample = [frame.select("target", *(F.col(n).alias(f"{short}{i}") for n, short in names.items() if n in frame.columns)) for frame in (state, context_tables)]
            drawn.append((sample, parent_customers, parent_tables, end_tables))

    totals_of = [x[1:] for x in drawn]
    kinds = {"doc": np.int64, "n_tokens": np.int32, "n_known": np.int32, "base": np.float64, "score": np.float64}
    packed = "target int, sender int, " + ", ".join(f"{name} binary" for name in kinds)

    def score(target: int, cells: dict[str, bytes]) -> pa.RecordBatch:
        c = _unpacked(cells)
        seats = seats_of(c)
        p = np.zeros(len(seats.context))
        for i, (total, all_tables, of_end) in enumerate(totals_of):
            now, above, of_context = (unsqueeze(cells[f"{name}{i}"], np.int64) for name in ("tables", "above", "of_context"))
            below = parent_p(seats.parents(now, of_end), above, total, all_tables)[seats.word]
            p += (seats.customers - discounts[0] * now + (strength + discounts[0] * of_context[seats.context]) * below) / (strength + c["context_customers"][seats.context])
        count = seats.parents(seats.customers, end_customers)[seats.word]
        base = np.log10((count + 1.0) / (trained + size + 1.0))
        times, n = c["tokens_of_type"], np.abs(c["n"]).astype(float)
        docs_here, at = np.unique(c["doc"], return_inverse=True)
        sums = [np.bincount(at, n * np.repeat(x, times)) for x in (np.ones(len(p)), (count > 0).astype(float), base, np.log10(p / len(totals_of)))]
        to = share_of(mix(docs_here.view(np.uint64)), parts)
        order = np.argsort(to, kind="stable")
        to, sums = to[order], [x[order].astype(t) for x, t in zip((docs_here, *sums), kinds.values(), strict=True)]
        cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
        rows = [(int(to[a]), target, *(squeeze(x[a:b]) for x in sums)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i < 2 else pa.binary()) for i, c in enumerate(zip(*rows, strict=True))], names=["target", "sender", *kinds])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums by document; parts of the vocabulary are added in their order, so that the sums don't depend on what came first."""
        rows = sorted((row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(1, 2 + len(kinds))), strict=True)), key=lambda r: r[0])
        if rows:
            cells = [np.concatenate([unsqueeze(row[i + 1], t) for row in rows]) for i, t in enumerate(kinds.values())]
            ids, at = np.unique(cells[0], return_inverse=True)
            sums = [np.bincount(at, x.astype(float)) for x in cells[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(s.astype(np.int64)) for s in sums[:2]), *(pa.array(s) for s in sums[2:])], names=list(kinds))

    whole = [rows, context_customers, *(frame for sample, *_ in drawn for frame in sample)]
    sent = _met(whole, score, packed).repartitionById(parts, F.col("target"))
    scored = sent.mapInArrow(total, "doc long, n_tokens long, n_known long, base double, score double")
    return scored.select(F.col("doc").alias(id_column), "n_tokens", "n_known", F.lit(trained).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
