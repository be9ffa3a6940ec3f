"""URL verdicts by rules, and by naive Bayes over segmented names where no rule fits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, looked_up

#: Tokens of the classifier up to which their weights are broadcast; beyond it they are joined.
BROADCAST = 200_000
_ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *_ASCII), path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule (verdict, ``domain/path``) that fits; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def page_words(html: Column) -> Column:
    """Lower-cased words of a page's visible text."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<[^>]*>|&[a-z]+;", " ")
    return F.regexp_extract_all(F.lower(bare), F.lit(r"\p{L}+"), 0)


def unigrams(words: DataFrame) -> DataFrame:
    """word, log_p of every word in the column ``word``."""
    counts = cut(words.where(F.length("word") > 0).groupBy("word").agg(F.count("*").alias("n")))
    total = float(np.log(max(1, counts.agg(F.sum("n").alias("n")).first()["n"] or 0)))
    return counts.select("word", (F.log("n") - total).alias("log_p"), F.lit(total).alias("log_total"))


def best_split(name: str, found: dict[tuple[int, int], float], log_total: float) -> list[str]:
    """The most likely split of a name: Viterbi over words (start, length); unknown stretches cost tenfold a letter.

    An unknown stretch, of any length, costs once in all and by its letters, so that the best start is known as one goes.
    """
    n = len(name)
    starts: dict[int, list[tuple[int, float]]] = {}
    for (start, size), p in found.items():
        starts.setdefault(start + size, []).append((size, p))
    best, length = np.full(n + 1, -np.inf), [0] * (n + 1)
    best[0] = 0.0
    reach = (-np.inf, 0)  # best score before an unknown stretch, the cost of the letters before it added, and its start
    for end in range(1, n + 1):
        reach = max(reach, (best[end - 1] + 2.302585 * (end - 1), end - 1))
        best[end], length[end] = reach[0] - log_total - 2.302585 * end, end - reach[1]
        for size, p in sorted(starts.get(end, ())):
            if best[end - size] + p > best[end]:
                best[end], length[end] = best[end - size] + p, size
    out, end = [], n
    while end:
        out.append(name[end - length[end] : end])
        end -= length[end]
    return out[::-1]


def segmented(names: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """name, parts (array) for every distinct value of ``name``.

    The names' substrings, up to the length of the longest word, are joined with the vocabulary, so that neither has to
    fit anywhere as a whole. Each distinct substring is looked up once, and its word's name is joined back by shares.
    """
    distinct = names.select("name").distinct()
    longest, total = vocabulary.agg(F.max(F.length("word")), F.max("log_total")).first()
    longest, total = longest or 1, total or 0.0
    stretches = distinct.select("name", F.posexplode(F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.col("name").substr(i, F.lit(longest)))).alias("start", "tail"))
    pieces = stretches.select("name", "start", F.explode(F.transform(F.sequence(F.lit(1), F.length("tail")), lambda n: F.col("tail").substr(F.lit(1), n))).alias("word"))
    found = looked_up(pieces, vocabulary, ["word"], "name").groupBy("name").agg(F.collect_list(F.struct("start", F.length("word").alias("size"), "log_p")).alias("found"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            parts = [best_split(name, {(f["start"], f["size"]): f["log_p"] for f in found} if found is not None else {}, total) for name, found in frame.itertuples(index=False)]
            yield pd.DataFrame({"name": frame["name"], "parts": parts})

    return distinct.join(found, "name", "left").select("name", "found").mapInPandas(run, "name string, parts array<string>")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], smoothing: float = 1.0, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Host, path, rule, verdict and log_odds of every page's url.

    The longest fitting rule decides. Elsewhere a multinomial naive Bayes classifier does, learnt from the urls that a
    rule decides: its tokens are the parts of host and path, names of letters being split by a unigram model of the
    pages' own words, numbers counting as one token. log_odds above 0 is for blocking; without urls of both kinds to
    learn from, and at 0, the verdict is allow. Null urls and those without ``://`` have an empty host and path. Equal
    urls get equal verdicts and are judged once; null ids are kept; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    rule, kind = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(id_column, host.alias("host"), path.alias("path"))
    # every distinct pair of host and path once, with the number of pages that have it
    pairs = rows.groupBy("host", "path").agg(F.count("*").alias("pages")).select("*", rule.alias("rule"), kind.alias("kind"))
    parts = pairs.select("host", "path", "pages", "kind", F.explode(F.array(F.struct(F.lit("h:").alias("side"), F.col("host").alias("text")), F.struct(F.lit("p:").alias("side"), F.col("path").alias("text")))).alias("of"))
    named = parts.select("host", "path", "pages", "kind", "of.side", F.explode(F.regexp_extract_all(F.lower("of.text"), F.lit(r"\p{L}+|[0-9]+"), 0)).alias("name"))
    letters = F.col("name").rlike(r"^\p{L}")
    split = segmented(named.where(letters), unigrams(pages.select(F.explode(page_words(F.col(html))).alias("word"))))
    known = looked_up(named, split, ["name"], ("host", "path"), "left").select("host", "path", "pages", "kind", F.explode(F.coalesce("parts", F.array(F.lit("0")))).alias("part"), "side")
    tokens = cut(known.select("host", "path", "pages", "kind", F.concat("side", "part").alias("token")))

    by_token = tokens.where("kind is not null").groupBy("token").agg(*(F.sum(F.when(F.col("kind") == k, F.col("pages")).otherwise(0)).alias(k) for k in ("allow", "block")))
    sums = by_token.agg(F.sum("allow").alias("allow_all"), F.sum("block").alias("block_all"), F.count("*").alias("size"))
    prior = pairs.agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("pages"))), F.lit(0)).alias(f"{k}_pages") for k in ("allow", "block")))
    facts = {**sums.first().asDict(), **prior.first().asDict()}
    can = bool(facts["allow_pages"] and facts["block_pages"])
    scale = [np.log((facts[f"{k}_all"] or 0) + smoothing * facts["size"]) if can else 0.0 for k in ("block", "allow")]
    weights = by_token.select("token", (F.log(F.col("block") + smoothing) - F.log(F.col("allow") + smoothing) - F.lit(float(scale[0] - scale[1]))).alias("weight"))
    if facts["size"] <= BROADCAST:
        weights = F.broadcast(weights)
    odds = tokens.where("kind is null").join(weights, "token").groupBy("host", "path").agg(F.sum("weight").alias("odds"))
    start = float(np.log(facts["block_pages"] / facts["allow_pages"])) if can else 0.0
    judged = pairs.join(odds, ["host", "path"], "left").select(
        "host", "path", "rule", "kind", F.when(F.col("kind").isNull(), F.lit(start) + F.coalesce("odds", F.lit(0.0)) if can else F.lit(0.0)).alias("log_odds")
    )
    verdict = F.coalesce("kind", F.when(F.round("log_odds", 9) > 0, "block").otherwise("allow"))
    return looked_up(rows, judged.select("host", "path", "rule", verdict.alias("verdict"), "log_odds"), ["host", "path"], id_column).select(id_column, "host", "path", "rule", "verdict", "log_odds")
