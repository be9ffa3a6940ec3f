"""Operators that SQL can't state, against plain Python that tries everything; and rows that repeat, tie or have no id."""

import math
import random
import re
from difflib import SequenceMatcher
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.llm import chain_dedup, decontaminate, language_id, license_scan, pitman_yor, queries, suffix_dedup, syncmers, trie_join, url_filter

from .test_text_operators import SMALL, WORD, as_dict, prose


# op3


def splits(name):
    for n in range(len(name)):
        for cuts in combinations(range(1, len(name)), n):
            edges = [0, *cuts, len(name)]
            yield [name[a:b] for a, b in zip(edges, edges[1:])]


def test_splits_are_the_likeliest_of_all():
    rng = random.Random(4)
    for _ in range(60):
        name = "".join(rng.choice("ab") for _ in range(rng.randint(1, 10)))
        known = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))): -rng.uniform(1, 8) for _ in range(6)}
        found = {(i, len(w)): p for w, p in known.items() for i in range(len(name)) if name[i:].startswith(w)}
        cost = lambda parts: sum(known.get(w, -9.0 - 2.302585 * len(w)) for w in parts)  # noqa: B023, E731
        best = url_filter.best_split(name, found, 9.0)
        assert "".join(best) == name
        assert cost(best) == pytest.approx(max(map(cost, splits(name))))


def test_verdicts_are_those_of_naive_bayes(spark):
    urls = [f"http://{h}.{t}/{p}" for h in ("news", "shop") for t in ("org", "com", "net") for p in ("fr/1", "de/2", "es/3")] + ["http://news.net/fr/9", "http://" + "x" * 40 + ".net/de"]
    pages = spark.createDataFrame([(i, u, "<p>news shop fr de</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = as_dict(url_filter.judge_urls(pages, queries.URL_RULES), "page_id")
    tokens = lambda u: [s + (w if w.isalpha() else "0") for s, part in zip(("h:", "p:"), u.split("://")[1].split("/", 1)) for w in part.replace("/", " ").replace(".", " ").split()]
    kinds = {"allow": [], "block": []}
    pairs = {"allow": 0, "block": 0}
    split = lambda ts: [x for t in ts for x in ([t] if t[2:] in ("news", "shop", "fr", "de", "0") else parts(t))]

    def parts(token):
        side, name = token[:2], token[2:]
        words = {"news": math.log(1 / 4), "shop": math.log(1 / 4), "fr": math.log(1 / 4), "de": math.log(1 / 4)}
        # log_total is that of all words of all pages
        total = math.log(4 * len(urls))
        return [side + w for w in url_filter.best_split(name, {(i, len(w)): p for w, p in words.items() for i in range(len(name)) if name[i:].startswith(w)}, total)]

    for i, u in enumerate(urls):
        if found[i]["rule"]:
            kinds[found[i]["verdict"]] += split(tokens(u))
            pairs[found[i]["verdict"]] += 1
    vocabulary = set(kinds["allow"]) | set(kinds["block"])
    for i, u in enumerate(urls):
        if found[i]["rule"] is None:
            odds = math.log(pairs["block"] / pairs["allow"])
            for t in split(tokens(u)):
                if t in vocabulary:
                    odds += math.log((kinds["block"].count(t) + 1) / (len(kinds["block"]) + len(vocabulary))) - math.log((kinds["allow"].count(t) + 1) / (len(kinds["allow"]) + len(vocabulary)))
            assert found[i]["log_odds"] == pytest.approx(odds, abs=1e-6)
            assert found[i]["verdict"] == ("block" if odds > 1e-9 else "allow")


# op6


def test_mixtures_match_a_plain_fit(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train_languages(docs)
    texts = [r["text"] for r in docs.where("text is not null").orderBy("doc_id").limit(12).collect()]
    texts.append(" ".join(t[:400] for t in texts[:8]))
    rows = as_dict(language_id.identify_languages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model))
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, _ = language_id._units(data, np.array([0, len(data)]))
        features = language_id._features(data)
        p = np.array([model.table[features[a:b]].sum(axis=0, dtype=float) for a, b in zip(starts, [*starts[1:], len(data)])])
        p = np.maximum(np.exp(p - p.max(axis=1, keepdims=True)), 1e-30)

        def fit(allowed, p=p):
            w = np.array(allowed, float) / sum(allowed)
            for _ in range(12):
                z = p * w
                w = (z / z.sum(axis=1, keepdims=True)).mean(axis=0)
            return w, np.log((p * w).sum(axis=1)).sum()

        order = np.argsort(-fit([1] * len(model.languages))[0], kind="stable")
        best = max((fit([int(l in order[:n]) for l in range(len(order))]) + (n,) for n in range(1, len(order) + 1)), key=lambda x: x[1] - x[2] * np.log(len(p) + 1.0))
        assert rows[i]["lang_pred"] == model.languages[int(best[0].argmax())]
        assert rows[i]["score"] == pytest.approx(best[0].max(), abs=1e-3)


def test_ties_of_languages_go_to_the_first():
    model = language_id.LanguageModel(["de", "en"], np.full((language_id.TABLE, 2), -1.0, np.float32))
    best, _ = model.mixture(np.frombuffer(b"same words", np.uint8), np.array([0, 10]))
    assert best.tolist() == [0]


# op8


def plain(text):
    return [w for w in (license_scan._plain(x) for x in WORD.findall(text)) if w]


def test_whole_licenses_and_all_notices(spark):
    templates = [(n, w) for n, ws in license_scan.TEMPLATES.items() for w in ws]
    rng = random.Random(5)
    rows, planted = [], {}
    for i, (name, wording) in enumerate(templates):
        words = wording.split()
        n = len(words) // 12  # a stretch of words differs, but a cue is left
        tries = ([*words[:k], *(f"odd{j}" for j in range(n)), *words[k + n :]] for k in iter(lambda: rng.randrange(len(words) - n + 1), -1))
        words = next(t for t in tries if re.search(license_scan.CUE, " ".join(t)))
        rows.append((i, f"{prose(i, 60)} {' '.join(words)} {prose(100 + i, 60)}"))
        planted[i] = name
    rows.append((900, " ".join(w for _, w in templates)))
    rows += [(901, None), (902, ""), (903, prose(7, 3000) + " license " + prose(8, 3000)), (None, "Released under the MIT License."), (904, "Released under the MIT License."), (904, "Released under the MIT License.")]
    found = license_scan.find_notices(spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))).collect()
    texts = {}
    for key, text in rows:
        texts.setdefault(key, text)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
        wording = plain(texts[r["doc_id"]][r["start"] : r["end"]])
        differ = min(max(len(t), len(wording)) - sum(m.size for m in SequenceMatcher(None, t, wording, False).get_matching_blocks()) for n, w in templates if n == r["license"] for t in [plain(w)])
        assert differ <= r["differing_words"]
    assert {i: by[i][0]["license"] for i in planted} == planted
    assert sorted(r["license"] for r in by[900]) == sorted(n for n, _ in templates)
    assert {k: len(v) for k, v in by.items() if k in (None, 901, 902, 903, 904)} == {None: 1, 904: 2}


# op2


def closed_syncmers(words, k=syncmers.K, s=syncmers.S, order=hash):
    out = []
    for i in range(len(words) - k + 1):
        inner = [order(tuple(words[i + d : i + d + s])) for d in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_anchors_are_closed_syncmers(spark):
    text = prose(3, 400)
    words = text.split()
    pairs = [tuple(words[i : i + 2]) for i in range(len(words) - 1)]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    hashes = {pairs[r["i"]]: r["h"] for r in frame.select("i", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()}
    expected = closed_syncmers(words, order=hashes.__getitem__)
    row = syncmers.with_fingerprint(spark.createDataFrame([(text,)], "text string"), "text", "anchors").select("anchors").first()
    assert len(row["anchors"]) == len(expected)
    # context-free: a stretch has the same anchors wherever it stands
    other = syncmers.with_fingerprint(spark.createDataFrame([("x y z " + " ".join(words[100:200]),)], "text string"), "text", "anchors").first()["anchors"]
    inner = sum(100 <= i <= 195 for i in expected)
    assert len(set(other) & set(row["anchors"])) >= inner


# rows that share an id, null ids, equal texts


@pytest.fixture(scope="module")
def odd_rows(spark):
    a, b = prose(11, 150), prose(12, 150)
    frame = spark.createDataFrame([(1, a), (1, a), (2, a), (3, b), (None, a), (None, None), (4, None), (4, "")], "doc_id long, text string")
    return frame.select("*", *(F.lit("x").alias(n) for n in ("host", "path", "rule", "verdict", "start", "spans", "of", "kept", "doc", "n", "chain", "member", "__share")))


def test_repeated_rows_and_null_ids(spark, odd_rows):
    kept = suffix_dedup.remove_repeats(odd_rows, 400).collect()
    assert sorted((r["doc_id"], r["n_removed"] > 0) for r in kept) == [(1, True), (1, True), (2, True), (3, False), (4, False), (4, False)]
    groups = as_dict(trie_join.jaccard_components(odd_rows))
    assert {k: r["component_id"] for k, r in groups.items()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r["doc_id"] for r in chain_dedup.repeated_passages(odd_rows).collect()} == {2}
    scores = pitman_yor.score_texts(odd_rows, F.lit(True)).collect()
    assert sorted(r["doc_id"] for r in scores) == [1, 2, 3, 4]
    items = spark.createDataFrame([(7, prose(11, 150)[:200]), (7, prose(11, 150)[:200]), (None, prose(12, 150)[:200])], "item_id long, text string")
    assert sorted((str(r["doc_id"]), str(r["item_id"])) for r in decontaminate.find_items(odd_rows, items).collect()) == [("1", "7")] * 4 + [("2", "7")] * 2 + [("3", "None")] + [("None", "7")] * 2
    assert language_id.identify_languages(odd_rows, language_id.train_languages(odd_rows.withColumn("lang", F.lit("en")))).count() == 8
    assert syncmers.fingerprint_edits(odd_rows).count() == 8


def test_recall_of_contained_items(spark):
    rng = random.Random(9)
    docs, items, expected = [], [], set()
    for i in range(60):
        words = prose(200 + i, 40).split()
        items.append((i, " ".join(words)))
        for j, changes in enumerate((0, 1)):
            w = list(words)
            for k in rng.sample(range(0, 3), changes):
                w[k] = "odd"
            docs.append((10 * i + j, f"{prose(900 + i, rng.choice((0, 30, 3000)))} {' '.join(w)} {prose(1900 + i, 50)}"))
            grams = {tuple(words[k : k + 5]) for k in range(36)}
            if len(grams & {tuple(w[k : k + 5]) for k in range(36)}) >= 0.75 * len(grams):
                expected.add((10 * i + j, i))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found <= expected
    assert len(found) >= 0.9 * len(expected)
