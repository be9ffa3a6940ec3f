"""String and JSON rules."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that a query may not hold: fixed values.
FORBIDDEN = (
    "a", "an", "the", "my", "your", "this", "that", "with", "without", "inside", "outside", "near", "beside", "between", "behind", "under", "over", "above", "below", "left", "right",
    "foreground", "background", "grab", "grasp", "hold", "holding", "held", "lift", "move", "moving", "pick", "place", "put", "scan", "stack", "take", "transfer", "arm", "hand", "gripper",
    "item", "object", "stuff", "thing", "bigger", "biggest", "smaller", "smallest", "larger", "largest", "nearest", "farthest",
)


#: Colours of two words, which go first, and of one: fixed values.
COLOR_PHRASES = ("light brown", "dark brown", "light gray", "dark gray", "light green", "dark green", "light blue", "dark blue")
COLOR_WORDS = (
    "beige", "black", "blue", "brown", "cyan", "gray", "green", "grey", "lime", "magenta", "maroon", "olive", "orange", "pink", "purple", "red", "silver", "teal", "white", "yellow",
)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def color_of(queries: Column) -> Column:
    """The first colour of two words in any of the queries, else the first word that is a colour; null if there is none."""
    phrase = F.get(F.filter(F.array(*map(F.lit, COLOR_PHRASES)), lambda p: F.exists(queries, lambda q: F.contains(q, p))), 0)
    words = F.flatten(F.transform(queries, lambda q: F.split(q, " ")))
    return F.coalesce(phrase, F.get(F.filter(words, lambda w: w.isin(*COLOR_WORDS)), 0))


def run_id(at: Column, unique: Column) -> Column:
    """Name of a run: its time (UTC session) and eight digits of something unique."""
    return F.concat_ws("-", F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.substring(unique, 1, 8))


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def query_reason(query: Column, visual_object: bool = False) -> Column:
    """Why a query of one to four lower-case words is refused; null if it isn't.

    With ``visual_object`` the last of several words may be "object".
    """
    plain = collapse(F.coalesce(query, F.lit("")))
    words = F.split(F.replace(plain, F.lit("-"), F.lit(" ")), " ")
    barred = F.array_intersect(words, F.array(*map(F.lit, FORBIDDEN)))
    if visual_object:
        barred = F.when((F.size(words) > 1) & (F.element_at(words, -1) == "object"), F.array_remove(barred, "object")).otherwise(barred)
    return (
        F.when(plain == "", "empty").when(plain != F.lower(plain), "case").when(~plain.rlike(r"^[a-z]+(-[a-z]+)*( [a-z]+(-[a-z]+)*){0,3}$"), "grammar")
        .when(F.size(barred) > 0, F.concat(F.lit("forbidden: "), F.array_join(F.array_sort(barred), ", ")))
    )


def _slugs(length: int) -> Callable[[Column], Column]:
    """Compatibility forms taken apart, and of these what is ASCII, joined and cut to ``length``: Spark has no such function.

    A text is taken by itself, whole, so that a worker holds one text's forms, not those of all texts of a batch.
    """

    def one(text: str) -> str:
        plain = text if text.isascii() else unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")
        return re.sub("[^a-z0-9]+", "_", plain.lower()).strip("_")[:length].rstrip("_")

    @F.arrow_udf(T.StringType())
    def slugs(texts: pa.Array) -> pa.Array:
        return pa.array((one(x.as_py()) for x in texts), pa.string(), size=len(texts))

    return slugs


def slug(text: Column, length: int = 96, default: str = "task") -> Column:
    """Lower-case ASCII letters and digits joined by underscores, accents dropped."""
    return once(_slugs(length)(F.coalesce(text, F.lit(""))), lambda cut: F.when(cut == "", default).otherwise(cut))


def episode_name(number: Column) -> Column:
    return F.concat(F.lit("episode_"), F.lpad(number.cast("string"), 6, "0"))


def chunk_name(number: Column) -> Column:
    return F.concat(F.lit("chunk-"), F.lpad(F.floor(number / 1000).cast("string"), 3, "0"))


def duration(seconds: Column) -> Column:
    """Whole seconds, 0 at least, as MM:SS, from an hour on as H:MM:SS."""
    s = F.greatest(seconds.cast("long"), F.lit(0))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    rest = F.concat(two(F.floor(s % 3600 / 60)), F.lit(":"), two(s % 60))
    return F.when(s < 3600, rest).otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit(":"), rest))


def strict_json_reason(text: Column, keys: tuple[str, ...]) -> Column:
    """Why a JSON object is refused: fence, number, malformed, duplicate key, keys; null if it isn't."""
    found = F.json_object_keys(text)
    return (
        F.when(text.contains("```"), "fence").when(text.rlike(r"[:\[,]\s*-?(NaN|Infinity)"), "number").when(found.isNull(), "malformed")
        .when(F.size(found) != F.size(F.array_distinct(found)), "duplicate_key").when(F.array_sort(found) != F.array(*map(F.lit, sorted(keys))), "keys")
    )


def query_plan(bank: Column, aliases: Column, limit: int = 3) -> Column:
    """Queries in order, at most ``limit`` aliases behind the bank's, each once whatever its case."""
    return F.array_distinct(F.transform(F.concat(bank, F.slice(aliases, 1, limit)), F.lower))


def progress(line: Column) -> tuple[Column, Column, Column]:
    """episode, done, total of a progress line (JSON with progress "n/total"); nulls for other text."""
    part = lambda i: F.nullif(F.regexp_extract(F.get_json_object(line, "$.progress"), r"^(\d+)/(\d+)$", i), F.lit("")).cast("int")
    return F.get_json_object(line, "$.episode").try_cast("int"), part(1), part(2)


def unknown_placeholders(template: Column, known: tuple[str, ...]) -> Column:
    """Placeholders of a template that aren't known."""
    return F.array_except(F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), 1), F.array(*map(F.lit, known)))


def bank_reason(bank: Column, order: Column, required: str = "category") -> Column:
    """Why a bank of queries (map of name to query) with an order of names is refused; null if it isn't.

    The required name has a query, queries differ, the order names each query once, and the required one comes last.
    """
    named = F.map_keys(F.map_filter(bank, lambda k, v: v.isNotNull()))
    queries = F.filter(F.map_values(bank), lambda v: v.isNotNull())
    return (
        F.when(~F.array_contains(named, required), "required").when(F.size(F.array_distinct(F.transform(queries, F.lower))) < F.size(queries), "repeated")
        .when(F.array_sort(order) != F.array_sort(named), "order").when(F.element_at(order, -1) != required, "fallback_not_last")
    )


def repaired_order(order: Column, known: Column, last: str) -> Column:
    """An order of names with repetitions and unknown names dropped, missing ones added, and ``last`` at the end."""
    kept = F.filter(F.array_distinct(order), lambda x: F.array_contains(known, x))
    return F.array_append(F.array_remove(F.concat(kept, F.array_except(known, kept)), last), F.lit(last))


def whole_json(value: Column) -> Column:
    """A JSON text as a variant; null if it isn't exactly one value (Spark's parser alone takes no notice of what follows it)."""
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    return once(listed, lambda x: F.when(F.try_variant_get(x, "$[1]", "variant").isNull(), F.try_variant_get(x, "$[0]", "variant")))
