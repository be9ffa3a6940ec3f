"""What filters do to a corpus in every order: a document's failures as one mask, all orders' outcomes as one integer.

A mask of failures settles what happens to a document at every step of every order. Each mask stands for one wide integer
with a field for each outcome of each step (600 steps for five filters), a field being wide enough for the count of any
table. Sums of such integers count everything at once; what reaches the end of a part is taken apart again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

#: Bits of a field: a sum stays below 2**63, as the rows of a table do, so that no field runs into the next.
FIELD = 64
#: What a step does to a document, a group of fields each.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Parts whose sums a task holds at once; beyond it they are passed on and added up later.
HELD = 1024


def _orders(letters: str) -> list[str]:
    return ["".join(order) for order in permutations(letters)]


def wide_counters(letters: str) -> list[int]:
    """The wide integer of every code: failures of ``letters`` (a bit each), then good, then toxic."""
    orders, n = _orders(letters), len(letters)
    found = []
    for code in range(1 << (n + 2)):
        fails = [bool(code >> i & 1) for i in range(n)]
        good, toxic = code >> n & 1, code >> (n + 1) & 1
        fields = np.zeros((len(OUTCOMES), len(orders), n), "<u8")
        for o, order in enumerate(orders):
            gone = False
            for s, letter in enumerate(order):
                failing = fails[letters.index(letter)]
                removed = failing and not gone
                fields[:, o, s] = (not failing and not gone, removed, failing and gone, failing and sum(fails) == 1, removed and good, removed and toxic)
                gone |= failing
        found.append(int.from_bytes(fields.tobytes(), "little"))
    return found


def _sums(letters: str, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, code, n) to rows (part, total): the sum of the codes' integers, n times each."""
    wide, size = wide_counters(letters), len(_orders(letters)) * len(letters) * len(OUTCOMES) * FIELD // 8

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([t.to_bytes(size, "little") for t in held.values()], pa.binary())], names=["part", "total"])

    held: dict[str, int] = {}
    for batch in rows:
        for row in pa.Table.from_batches([batch]).group_by(["part", "code"]).aggregate([("n", "sum")]).to_pylist():
            held[row["part"]] = held.get(row["part"], 0) + row["n_sum"] * wide[row["code"]]
            if len(held) > HELD:
                yield sent()
                held.clear()
    if held:
        yield sent()


def _unpacked(letters: str, part: str, total: int) -> pa.RecordBatch:
    """A row for each step of each order from the sum of a part."""
    orders, n = _orders(letters), len(letters)
    data = total.to_bytes(len(OUTCOMES) * len(orders) * n * FIELD // 8, "little")
    fields = np.frombuffer(data, "<u8").astype(np.int64).reshape(len(OUTCOMES), -1)
    letter = np.array([letters.index(x) for order in orders for x in order])
    shapley = np.bincount(letter, weights=None, minlength=n) * 0
    np.add.at(shapley, letter, fields[OUTCOMES.index("removed")])
    columns = [pa.array([part] * len(letter), pa.string()), pa.array(np.repeat(orders, n)), pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)))]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(f) for f in fields), pa.array(shapley[letter])], names=["part", "filter_order", "step", *OUTCOMES, "shapley"])


def _added(letters: str, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, total), sorted by part, to the steps of each part."""
    part, total = None, 0
    for batch in rows:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if part is not None and name != part:
                yield _unpacked(letters, part, total)
                total = 0
            part, total = name, total + int.from_bytes(data.as_py(), "little")
    if part is not None:
        yield _unpacked(letters, part, total)


def text_failures(text: str) -> dict[str, Column]:
    """Failures told by the text alone: A few words, B few distinct words, C many capitals, D a mark of markup."""
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), 0)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": capitals * 100 > F.length(text) * 10,
        "D": F.col(text).rlike(r"[#$%&*|]"),
    }


def audit_filters(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "lang", copies: str = "E") -> DataFrame:
    """What filters A to D and ``copies`` (a text equal to that of a smaller id) do in every order, by part.

    One row for each part, order (``filter_order``) and ``step``, with counts of documents: kept, removed, redundant (fails,
    but removed before), unique_fails (fails this filter alone), good_lost and toxic_lost (removed here and labelled so),
    shapley (what the filter removes, summed over all orders). Null text counts as empty, null part as the empty string. A
    document is good or toxic if any of its labels says so; rows that share an id are documents of their own with the
    same labels and no copies of each other; a row with a null id is neither a copy nor has copies or labels. An empty table
    gives no row; texts are taken whole; further columns aren't read.

    The text is reduced to a digest and a mask where it is read. Copies are folded by digest before they meet, so that a
    text that a third of all documents have is a few rows in the end.
    """
    base = docs.select(F.col(id_column).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    failures = text_failures("text")
    letters = "".join(failures) + copies
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures.values())), F.lit(0))
    read = base.select("doc", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("doc")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flag = lambda name, bit: F.when(F.col(name), 1 << bit).otherwise(0)
    rows = read.join(known, "doc", "left").select("doc", "part", "digest", (F.col("mask") + flag("good", len(letters)) + flag("toxic", len(letters) + 1)).alias("code"))

    # rows of one id and text, then rows of one text: each step sums before it shuffles
    one = rows.groupBy("digest", "part", "code", "doc").agg(F.count("*").alias("n"))
    by_text = one.groupBy("digest", "part", "code").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc").isNull(), F.col("n"))), F.lit(0)).alias("free"),
        F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n"))).alias("low"),
    )
    # a text has as many rows here as it has parts and kinds of labels
    lowest = F.min("low.doc").over(Window.partitionBy("digest"))
    first = F.col("free") + F.when(F.col("low.doc") == lowest, F.col("low.n")).otherwise(0)
    split = by_text.select("part", "code", "n", first.alias("first"))
    copied = F.struct((F.col("code") + (1 << letters.index(copies))).alias("code"), (F.col("n") - F.col("first")).alias("n"))
    counted = split.select("part", F.explode(F.array(F.struct("code", F.col("first").alias("n")), copied)).alias("x")).select("part", "x.code", "x.n").where("n > 0")

    fields = ", ".join(f"{o} long" for o in OUTCOMES)
    totals = counted.mapInArrow(lambda rows: _sums(letters, rows), "part string, total binary")
    steps = totals.repartition("part").sortWithinPartitions("part").mapInArrow(lambda rows: _added(letters, rows), f"part string, filter_order string, step int, {fields}, shapley long")
    return steps
