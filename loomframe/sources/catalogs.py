"""Catalogs of alias rules, in JSON or YAML, as ordered rows, and the rule that a query takes."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A catalog's format, with or without a project's name before it, and the roles of its rules: fixed values.
FORMAT = "open_set_query_aliases_v1"
ROLES = ("target", "receiver")
RULES = "rule_idx int, role string, tasks array<string>, query_words array<string>, aliases array<string>, reason string"


def parsed(text: str) -> object:
    """The value of a text in JSON, or in YAML where a YAML reader is installed."""
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as e:
            raise ValueError("the catalog isn't JSON, and no YAML reader is installed") from e
        return yaml.safe_load(text)


def _strings(value: object) -> list[str] | None:
    fine = isinstance(value, list) and all(isinstance(x, str) and x.strip() for x in value)
    return [x.strip() for x in value] if fine else None


def rules(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a catalog's rules in order: rule_idx, role, tasks, query_words, aliases, and what is wrong with a rule.

    reason: mapping, role, tasks, query_words, aliases (strings that aren't blank, one alias at least), condition (neither tasks
    nor words). A catalog of another format or without a list of rules raises. A catalog is one small file that people write,
    so that it is parsed where the job is planned.
    """
    raw = parsed(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(raw, dict) or not re.fullmatch(rf"(?:\w+_)?{FORMAT}", str(raw.get("format_version"))) or not isinstance(raw.get("rules"), list):
        raise ValueError(f"not a catalog of aliases: {path}")
    rows = []
    for i, entry in enumerate(raw["rules"]):
        if not isinstance(entry, dict):
            rows.append((i, None, None, None, None, "mapping"))
            continue
        found = {n: _strings(entry.get(n, [])) for n in ("tasks", "query_words", "aliases")}
        reason = "role" if entry.get("role") not in ROLES else next((n for n, v in found.items() if v is None), None)
        reason = reason or ("aliases" if not found["aliases"] else None) or (None if found["tasks"] or found["query_words"] else "condition")
        rows.append((i, entry.get("role") if isinstance(entry.get("role"), str) else None, *found.values(), reason))
    return spark.createDataFrame(rows, RULES)


def as_literal(found: DataFrame) -> Column:
    """Sound rules as one literal array, in order; raises if any is not sound. The catalog's size bounds it."""
    rows = found.orderBy("rule_idx").collect()
    if bad := [r["rule_idx"] for r in rows if r["reason"]]:
        raise ValueError(f"rules {bad} can't be used")
    text = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    return F.array(*(F.struct(F.lit(r["rule_idx"]).alias("rule_idx"), F.lit(r["role"]).alias("role"), text(r["tasks"]).alias("tasks"), text(r["query_words"]).alias("words"), text(r["aliases"]).alias("aliases")) for r in rows))


def matched(queries: DataFrame, known: Column, names: Sequence[str] = ("role", "task", "words")) -> DataFrame:
    """``queries`` with rule_idx and aliases of the first rule of their role that names their task or has one of their words; nulls without one."""
    role, task, words = (F.col(n) for n in names)
    fits = lambda r: (r["role"] == role) & (F.array_contains(r["tasks"], task) | F.arrays_overlap(r["words"], words))
    rule = F.get(F.filter(known, lambda r: F.coalesce(fits(r), F.lit(False))), 0)
    return queries.select("*", rule["rule_idx"].alias("rule_idx"), rule["aliases"].alias("aliases"))
