"""Answers of a model, as JSON text: why one is refused, and its fields if it isn't."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, once

DECISIONS = ("accept", "reject_all", "ambiguous")
STATES = ("ok", "ambiguous", "not_visible")
_NUMBER = r"^-?(0|[1-9]\d*)(\.\d+)?([eE][-+]?\d+)?$"


def unfenced(raw: Column) -> tuple[Column, Column]:
    """Text without a fence of three backticks around it, and whether a fence is broken or of another language."""
    text = F.trim(raw)
    fenced = text.startswith("```")
    inner = F.regexp_extract(text, r"(?s)^```(?:json)?\s*\n(.*)\n\s*```$", 1)
    return F.when(fenced, F.trim(inner)).otherwise(text), fenced & ~text.rlike(r"(?s)^```(json)?\s*\n.*\n\s*```$")


def _raw(fields: Column, key: str) -> Column:
    """A field's value as text, strings without their quotes; null for null and missing ones."""
    return F.try_element_at(fields, F.lit(key))


def _read(text: Column, **more: Column) -> Column:
    """Struct of text, ``more``, its fields (map of texts) and its keys: the text is read once, whatever is asked of it."""
    known = once(F.struct(text.alias("text"), *(v.alias(n) for n, v in more.items())), lambda t: F.struct(t.alias("t"), F.from_json(t["text"], "map<string,string>").alias("fields"), F.json_object_keys(t["text"]).alias("keys")))
    return once(known, lambda x: F.struct(*(x["t"][n].alias(n) for n in ("text", *more)), x["fields"].alias("fields"), x["keys"].alias("keys")))


def _odd_keys(found: Column, keys: tuple[str, ...]) -> Column:
    """Whether an object's keys aren't these, each once."""
    return F.array_sort(found) != F.array(*map(F.lit, sorted(keys)))


def _share(text: Column, fields: Column, key: str) -> Column:
    """A field as a number; null if it isn't one."""
    return F.when(_raw(fields, key).rlike(_NUMBER) & ~text.rlike(rf'"{key}"\s*:\s*"'), _raw(fields, key).try_cast("double"))


def _no_share(value: Column) -> Column:
    return ~F.coalesce((value >= 0) & (value <= 1), F.lit(False))


def _words(text: Column, fields: Column, key: str) -> Column:
    """A field as collapsed text; null if it isn't a string."""
    return F.when(text.rlike(rf'"{key}"\s*:\s*"'), collapse(_raw(fields, key)))


def candidate_choice(raw: Column, candidates: Column) -> Column:
    """A choice among candidates: struct of error, decision, selected, confidence, reason.

    error is the first of fence, empty, json, keys, decision, candidate, missing_selection, selection, confidence, reason
    that applies; the other fields are null then.
    """
    text, broken = unfenced(F.coalesce(raw, F.lit("")))

    def values(r: Column) -> Column:
        said = {"decision": _raw(r["fields"], "decision"), "picked": F.upper(F.trim(_raw(r["fields"], "selected_candidate"))), "confidence": _share(r["text"], r["fields"], "confidence"), "reason": _words(r["text"], r["fields"], "reason")}
        return F.struct(r.alias("r"), *(v.alias(n) for n, v in said.items()))

    def checked(x: Column) -> Column:
        r, decision, picked = x["r"], x["decision"], x["picked"]
        error = (
            F.when(r["broken"], "fence").when(r["text"] == "", "empty").when(r["keys"].isNull(), "json").when(_odd_keys(r["keys"], ("decision", "selected_candidate", "confidence", "reason")), "keys")
            .when(~F.coalesce(decision.isin(*DECISIONS), F.lit(False)), "decision").when(picked.isNotNull() & ~F.array_contains(candidates, picked), "candidate").when((decision == "accept") & picked.isNull(), "missing_selection")
            .when((decision != "accept") & picked.isNotNull(), "selection").when(_no_share(x["confidence"]), "confidence").when(F.coalesce(x["reason"], F.lit("")) == "", "reason")
        )
        return F.struct(error.alias("error"), x.alias("x"))

    def told(e: Column) -> Column:
        ok = lambda n: F.when(e["error"].isNull(), e["x"][n])
        return F.struct(e["error"].alias("error"), ok("decision").alias("decision"), ok("picked").alias("selected"), ok("confidence").alias("confidence"), ok("reason").alias("reason"))

    return once(once(once(_read(text, broken=broken), values), checked), told)


def box_answer(raw: Column) -> Column:
    """A box in shares of the frame: struct of error, status, box (array of x0, y0, x1, y1, null unless ok), confidence.

    error is the first of empty, fence, json, keys, status, confidence, reason, box that applies. Coordinates outside 0 to
    1 or out of order are refused, not mended.
    """

    def values(r: Column) -> Column:
        given = _raw(r["fields"], "bbox_xyxy")
        said = {"status": _raw(r["fields"], "status"), "confidence": _share(r["text"], r["fields"], "confidence"), "reason": _words(r["text"], r["fields"], "reason"), "given": given, "box": F.from_json(given, "array<double>")}
        return F.struct(r.alias("r"), *(v.alias(n) for n, v in said.items()))

    def checked(x: Column) -> Column:
        r, status, given = x["r"], x["status"], x["given"]
        at = lambda i: F.get(x["box"], i)
        fits = (F.size(x["box"]) == 4) & ~given.contains('"') & (at(0) >= 0) & (at(0) < at(2)) & (at(2) <= 1) & (at(1) >= 0) & (at(1) < at(3)) & (at(3) <= 1)
        error = (
            F.when(r["text"] == "", "empty").when(r["text"].startswith("```"), "fence").when(r["keys"].isNull() | r["text"].rlike(r"[:\[,]\s*-?(NaN|Infinity)"), "json").when(_odd_keys(r["keys"], ("status", "bbox_xyxy", "confidence", "reason")), "keys")
            .when(~F.coalesce(status.isin(*STATES), F.lit(False)), "status").when(_no_share(x["confidence"]), "confidence").when(F.coalesce(x["reason"], F.lit("")) == "", "reason")
            .when(F.when(status == "ok", ~F.coalesce(fits, F.lit(False))).otherwise(given.isNotNull()), "box")
        )
        return F.struct(error.alias("error"), x.alias("x"))

    def told(e: Column) -> Column:
        ok = lambda v: F.when(e["error"].isNull(), v)
        return F.struct(e["error"].alias("error"), ok(e["x"]["status"]).alias("status"), ok(F.when(e["x"]["status"] == "ok", e["x"]["box"])).alias("box"), ok(e["x"]["confidence"]).alias("confidence"))

    return once(once(once(_read(F.trim(F.coalesce(raw, F.lit("")))), values), checked), told)


def message(parts: Column) -> Column:
    """Kind of a message given as an array of texts, its first being the tag; null for any other.

    event and error have four parts, source_episode and urdf_episode three; a result of two parts is the source's, of three
    the worker's.
    """
    tag, n = F.get(parts, 0), F.size(parts)
    return (
        F.when(tag.isin("event", "error") & (n == 4), tag).when(tag.isin("source_episode", "urdf_episode") & (n == 3), tag)
        .when((tag == "result") & (n == 2), "source_result").when((tag == "result") & (n == 3), "urdf_result")
    )
