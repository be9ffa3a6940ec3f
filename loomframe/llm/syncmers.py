"""Document fingerprints from closed syncmers, with DataFrame functions only."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import partitions

#: Words of an anchor and of the inner runs that decide whether it is one.
K, S = 5, 2
#: A longer word counts as several, so that a text without white space has anchors too.
_TOKEN = r"[^\x20\x09-\x0D]{1,16}"
#: Ids by whose quantiles rows are dealt into ranges.
_QUANTILES = 64


def with_fingerprint(frame: DataFrame, text: str, name: str) -> DataFrame:
    """``frame`` with the anchors of ``text`` as array ``name``, in the text's order and each once.

    A run of K words is an anchor if the smallest hash among its inner runs of S words is that of its first or last one:
    a closed syncmer. That depends on nothing around it. A text of fewer words has all of them as its one anchor, a text
    without words or a null none.
    """
    w, s = f"__{name}_words", f"__{name}_inner"
    less = F.greatest(F.size(w) - (S - 1), F.lit(0))
    inner = F.zip_with(F.slice(w, 1, less), F.slice(w, S, less), lambda a, b: F.xxhash64(a, b))

    def anchor(i: Column) -> Column:
        at = [F.get(F.col(s), i + d) for d in range(K - S + 1)]
        closed = F.least(at[0], at[-1]) <= F.least(*at[1:-1])
        return F.when(closed, F.hash(at[0], at[S], F.get(F.col(w), i + K - 1)))

    runs = F.array_distinct(F.array_compact(F.transform(F.sequence(F.lit(0), F.size(w) - K), anchor)))
    short = F.when(F.size(w) > 0, F.array(F.hash(F.col(w)))).otherwise(F.array().cast("array<int>"))
    return (
        frame.withColumn(w, F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), 0), lambda t: F.xxhash64(t)))
        .withColumn(s, inner)
        .withColumn(name, F.when(F.size(w) >= K, runs).otherwise(short))
        .drop(w, s)
    )


def fingerprint_text(anchors: str) -> Column:
    """Anchors as hexadecimal numbers joined by hyphens."""
    return F.array_join(F.transform(anchors, lambda a: F.lower(F.hex(a.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), "-")


def likeness(a: str, b: str) -> Column:
    """Common anchors of all anchors of two fingerprints; 1 if neither has any."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, 1.0).otherwise(common / either)


def _ranges(docs: DataFrame, id_column: str) -> Column:
    """A number for each range of ids, larger ids never in a smaller range, about equally many rows in each."""
    cuts = docs.select(F.percentile_approx(id_column, [i / _QUANTILES for i in range(_QUANTILES + 1)], 10_000).alias("q")).first()["q"]
    if not cuts:
        return F.lit(-1)
    cuts = sorted(set(cuts))
    parts = max(1, ceil(8 * partitions(docs.sparkSession) / len(cuts)))
    bounds = F.array(*map(F.lit, cuts))
    at = F.greatest(F.size(F.filter(bounds, lambda c: c <= F.col(id_column))) - 1, F.lit(0))
    low = F.get(bounds, at)
    high = F.coalesce(F.get(bounds, at + 1), low + 1)
    inside = F.floor((F.col(id_column) - low).cast("double") * parts / (high - low)).cast("long")
    return F.coalesce(at.cast("long") * parts + F.least(F.greatest(inside, F.lit(0)), F.lit(parts - 1)), F.lit(-1))


def with_next(docs: DataFrame, id_column: str, text: str, name: str = "anchors") -> DataFrame:
    """Every row's id and text with its fingerprint, and those of the next row by descending id (the first after the last).

    Columns: id, text, ``name``, next_text, ``name``_next. Rows are dealt by ranges of ids; the first row of every range
    also goes, as a guest, to the end of the range before it, so that one exchange of the texts is enough. Rows with equal
    ids follow each other by text; null ids come last.
    """
    docs = docs.select(id_column, F.coalesce(text, F.lit("")).alias(text))
    ranged = docs.withColumn("range", _ranges(docs, id_column))
    heads = ranged.groupBy("range").agg(F.max(id_column).alias("head"))
    # a row for each range: their number follows the partitions, not the data
    order = Window.orderBy(F.col("range").desc())
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.col("range").desc())
    hosts = heads.select(F.col("range").alias("host"), F.coalesce(F.lead("range").over(order), F.first("range").over(every)).alias("range"), F.when(F.lead("range").over(order).isNull(), F.first("head").over(every)).otherwise(F.lead("head").over(order)).alias("head"))
    guests = ranged.join(F.broadcast(hosts), "range").where(F.col(id_column).eqNullSafe(F.col("head"))).select(id_column, text, F.col("host").alias("range"), F.lit(True).alias("guest"))
    dealt = ranged.withColumn("guest", F.lit(False)).unionByName(guests).repartition(partitions(docs.sparkSession), "range")
    known = with_fingerprint(dealt, text, name)
    follow = Window.partitionBy("range").orderBy("guest", F.col(id_column).desc_nulls_last(), text)
    return known.select(id_column, text, name, "guest", F.lead(text).over(follow).alias("next_text"), F.lead(name).over(follow).alias(f"{name}_next")).where(~F.col("guest")).drop("guest")


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited copy, whose last third is replaced by the next text's beginning.

    Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts count as
    empty; texts are taken whole; repeated rows are each other's neighbours; an empty table gives an empty result; a
    single row is its own neighbour. Further columns aren't read.
    """
    rows = with_next(docs, id_column, text)
    size = F.length(text)
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), size - third), F.substring("next_text", F.lit(1), third))
    edited_rows = with_fingerprint(rows.withColumn("edited", edited), "edited", "edited_anchors")
    return edited_rows.select(
        id_column, size.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint_text("anchors").alias("fingerprint"),
        fingerprint_text("edited_anchors").alias("edited_fingerprint"), likeness("anchors", "edited_anchors").alias("near_edited"), likeness("anchors", "anchors_next").alias("near_next"),
    )
