"""The text operators against plain Python on small tables, with nulls, empty, long, equal and clashing rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.llm import (
    chain_dedup,
    common,
    decontaminate,
    language_id,
    license_scan,
    piece_codec,
    pitman_yor,
    queries,
    suffix_dedup,
    syncmers,
    trie_join,
    url_filter,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    a, b = prose(1, 300), prose(2, 120)
    near = a.split()
    near[40] = near[200] = "changed"
    return [
        (1, a), (2, a), (3, " ".join(near)), (4, b), (5, b + " " + prose(3, 200)), (6, None), (7, ""), (8, " \t\n"), (9, "One two"), (10, "one TWO"), (11, "ab " * 900),
        (12, "x" * 5000), (13, prose(4, 80) + "\n" + " ".join(a.split()[100:170]) + "\n" + prose(5, 60)), (14, "Été über naïve 漢字 " * 3), (15, prose(6, 20_000)), (16, "ab " * 900), (17, "!!! 123"),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.select("*", F.lit("x").alias("keys"), F.lit(1).alias("label"), F.lit("y").alias("lang_pred"), F.lit(0).alias("target")).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def as_dict(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


# op1


def repeats(texts, length):
    bodies = {k: (t or "").encode() for k, t in texts}
    seen = Counter(b[i : i + length] for b in bodies.values() for i in range(len(b) - length + 1))
    out = {}
    for k, b in bodies.items():
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[k] = (len(b), int(gone.sum()), runs, bytes(c for c, g in zip(b, gone, strict=False) if not g))
    return out


def test_repeats_match_brute_force(docs, rows):
    texts = [(k, t) for k, t in rows if k != 15]
    found = as_dict(suffix_dedup.remove_repeats(docs.where("doc_id <> 15"), 400))
    assert {k: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for k, r in found.items()} == repeats(texts, 400)


def test_repeats_of_an_empty_table(none):
    assert suffix_dedup.remove_repeats(none, 400).count() == 0


def test_suffix_ranks_sort_suffixes(spark):
    rng = np.random.default_rng(3)
    sequences = {d: rng.integers(1, 4, n).tolist() for d, n in enumerate([1, 2, 3, 40, 41, 42])}
    found = as_dict(suffix_dedup.suffix_ranks(spark.createDataFrame(list(sequences.items()), "doc long, names array<long>"), 100), "doc")
    ranked = sorted((found[d]["ranks"][i], s[i:]) for d, s in sequences.items() for i in range(len(s)))
    assert [s for _, s in ranked] == sorted(s for _, s in ranked)


# op2


def test_fingerprints(docs, rows):
    found = as_dict(syncmers.fingerprint_edits(docs))
    order = sorted(rows, reverse=True)
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert (found[key]["n_chars"], found[key]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= found[key]["near_edited"] <= 1
    assert found[1]["fingerprint"] == found[2]["fingerprint"]
    assert found[2]["near_next"] == 1.0
    assert found[3]["near_next"] > 0.8
    assert 0.6 < found[15]["near_edited"] < 0.72  # the next text is short, so that two thirds are left
    assert found[7]["fingerprint"] == ""


def test_fingerprints_of_an_empty_table(none):
    assert syncmers.fingerprint_edits(none).count() == 0


# op3


def test_url_verdicts(spark):
    urls = ["https://A.example.ORG/es/1", "http://example.org/en/12?x", "ftp://org", "http://x.com/fr/", "http://x.com/de/a#b", "no scheme", None, "http://ththe.net/fr/9", "http://a.b.com/de", "x://h?q://z/"]
    pages = spark.createDataFrame([(i, u, "<p>The then th e</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = as_dict(url_filter.judge_urls(pages, queries.URL_RULES), "page_id")
    assert [found[i]["host"] for i in range(10)] == ["a.example.org", "example.org", "org", "x.com", "x.com", "", "", "ththe.net", "a.b.com", "h"]
    assert [found[i]["path"] for i in range(10)] == ["/es/1", "/en/12", "", "/fr/", "/de/a", "", "", "/fr/9", "/de", ""]
    assert [found[i]["rule"] for i in range(10)] == ["example.org/es/", "example.org/en/1", None, "com/fr/", "com/de/", None, None, None, None, None]
    assert all(found[i]["verdict"] in ("allow", "block") for i in range(10))
    assert [found[i]["verdict"] for i in (0, 1, 3, 4)] == ["block", "block", "allow", "block"]
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_names_split_by_likelihood():
    p = {"spam": -3.0, "farm": -3.0, "spa": -9.0, "mfarm": -20.0}
    found = {(i, n): p["spamfarm"[i : i + n]] for i in range(8) for n in range(1, 9) if "spamfarm"[i : i + n] in p}
    assert url_filter.best_split("spamfarm", found, 10.0) == ["spam", "farm"]


# op4


def test_scores(docs, rows):
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    counts = Counter(t for k, x in rows if not held[k] for t in [*words(x), None])
    n, v = sum(counts.values()), len(counts)
    found = as_dict(pitman_yor.score_texts(docs, ~language_id.held_out("doc_id", 7, 2)))
    for key, text in rows:
        tokens = [*words(text), None]
        r = found[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
        assert r["score"] < 0


def test_scores_without_rows(docs, none):
    assert pitman_yor.score_texts(none, F.lit(True)).count() == 0
    assert pitman_yor.score_texts(docs.where("doc_id = 9"), F.lit(False)).first()["score"] == pytest.approx(0.0)


def test_seats_follow_the_process():
    keys = common.mix(np.arange(1, 4001, dtype=np.uint64))
    tables = pitman_yor.seat(np.full(4000, 200), lambda at, now: np.full(len(at), 0.5) + 0.3 * now, 0.3, keys, 0)
    mean, expected = tables.mean(), 1.0
    for seated in range(1, 200):  # the mean-field recursion is near the mean
        expected += (0.5 + 0.3 * expected) / (0.5 + seated)
    assert mean == pytest.approx(expected, rel=0.1)


def plain_scores(texts, train, samples=2, burn_in=1, strength=1.0):
    """The same sampler one dish at a time, with dictionaries."""
    tokens = {}
    for key, text in texts:
        data = (text or "").encode()
        w, k, _ = pitman_yor.tokens_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        tokens[key] = list(zip(w.tolist(), k.tolist(), strict=True))
    c = Counter(t for key, ts in tokens.items() if key in train for t in ts)
    words_of = sorted({w for w, _ in c})
    size, uniform = len(words_of), 1.0 / (len(words_of) + 1)
    kinds = Counter(w for w, _ in c)
    d = [float(np.clip(a / max(1, a + 2 * b), 0.05, 0.95)) for a, b in ((sum(n == 1 for n in x.values()), sum(n == 2 for n in x.values())) for x in (c, kinds))]
    tables, above = {t: 1 for t in c}, {w: 1 for w in words_of}
    key_of = {(w, k): common.mix(np.array([w], np.uint64)) + common.mix(np.array([k + 1], np.uint64)) for w, k in c}
    customers_of = Counter()
    for (_, k), n in c.items():
        customers_of[k] += n

    def seat_one(n, weight, discount, key, sweep):
        t, seated = 1, 1
        while n > seated:
            group = min(max(1, seated // 16), n - seated)
            new = weight(t)
            t += int(group * new / (new + seated + (group - 1) / 2 - discount * t) + pitman_yor.chance(key, sweep, seated)[0])
            seated += max(1, seated // 16)
        return t

    p = defaultdict(float)
    for sweep in range(burn_in + samples):
        of_context, guests = Counter(), Counter()
        for (w, k), t in tables.items():
            of_context[k] += t
            guests[w] += t
        total, all_above = sum(guests.values()), sum(above.values())
        after = {}
        for (w, k), n in c.items():
            own = tables[w, k]
            there = guests[w] - own
            base = max(there - d[1] * min(above[w], there), 0) + (strength + d[1] * all_above) * uniform
            after[w, k] = seat_one(n, lambda t, own=own, base=base, k=k: (strength + d[0] * (of_context[k] - own + t)) * (base + t) / (strength + total - own + t), d[0], key_of[w, k], sweep)
        new_guests = Counter()
        # parts of the vocabulary know the end's guests of the last sweep only
        for (w, _), t in after.items():
            new_guests[w] += t
        new_guests[int(pitman_yor.END)] = guests[int(pitman_yor.END)]
        above = {w: seat_one(new_guests[w], lambda t, w=w: (strength + d[1] * (all_above - above[w] + t)) * uniform, d[1], common.mix(np.array([w], np.uint64)), sweep) for w in words_of}
        tables = after
        if sweep >= burn_in:
            of_context, guests = Counter(), Counter()
            for (w, k), t in tables.items():
                of_context[k] += t
                guests[w] += t
            total, all_above = sum(guests.values()), sum(above.values())
            for t in {t for ts in tokens.values() for t in ts}:
                w, k = t
                parent = (guests[w] - d[1] * above.get(w, 0) + (strength + d[1] * all_above) * uniform) / (strength + total)
                p[t] += (c[t] - d[0] * tables.get(t, 0) + (strength + d[0] * of_context[k]) * parent) / (strength + customers_of[k]) / samples
    return {key: sum(math.log10(p[t]) for t in ts) for key, ts in tokens.items()}


def test_scores_match_a_plain_sampler(spark):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(rng.choice(list("abcdefgh"), rng.integers(0, 60), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05]))) for i in range(40)] + [(40, "a b new words"), (41, None)]
    expected = plain_scores(texts, set(range(30)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    for n in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found = as_dict(pitman_yor.score_texts(frame.repartition(n), F.col("doc_id") < 30))
        assert {k: r["score"] for k, r in found.items()} == pytest.approx(expected, rel=1e-9)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_every_word_is_a_context_of_its_own():
    data = np.frombuffer(" ".join(f"w{i}" for i in range(200_000)).encode(), np.uint8)
    w, k, _ = pitman_yor.tokens_of(data, np.array([0, len(data)]))
    assert len(np.unique(k)) == 200_001
    assert k[0] == pitman_yor.END and (k[1:] == w[:-1]).all()


def test_scores_of_many_contexts_match_a_plain_sampler(spark):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 80) % 900)) for i in range(40)]
    expected = plain_scores(texts, set(range(30)))
    found = as_dict(pitman_yor.score_texts(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), F.col("doc_id") < 30))
    assert {k: r["score"] for k, r in found.items()} == pytest.approx(expected, rel=1e-9)


def test_held_out_texts_are_likelier_than_under_single_words(spark):
    found = queries.op4_pitman_yor(spark, SMALL).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


# op5


def test_pieces_match_the_library(spark, docs, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    texts = dict(rows) | {100 + i: t for i, t in enumerate(["<s>a</s>", "a▁b  c", "\x00\ufffd🙂é", "  lead", "tail  ", "\r\n\t", "ﬁ①　x", "<0x41>"])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for key, r in as_dict(piece_codec.encode_pieces(frame, queries.piece_model())).items():
        ids = model.encode(texts[key] or "")
        assert r["ids"] == ids
        assert r["decoded"] == model.decode(ids)
    assert piece_codec.encode_pieces(docs.limit(0), queries.piece_model()).count() == 0


# op6


def test_languages(spark, docs, none):
    found = queries.op6_language_id(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id").where("held_out and n_chars > 40")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()
    model = language_id.train_languages(spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)], "text string, lang string"))
    assert model.languages == ["de", "en"]
    rows = as_dict(language_id.identify_languages(docs, model))
    assert [rows[k]["lang_pred"] for k in (6, 7, 8, 17)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    empty = language_id.train_languages(none.withColumn("lang", F.lit("en")))
    assert {r["lang_pred"] for r in language_id.identify_languages(docs, empty).collect()} == {"und"}


def test_mixtures_of_two_languages(spark):
    model = language_id.train_languages(spark.read.parquet(f"{SMALL}/documents.parquet"))
    texts = {l: " ".join(r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").where(F.col("lang") == l).limit(2).collect())[:3000] for l in ("en", "de")}
    mixed = spark.createDataFrame([(1, texts["en"] + " " + texts["de"][:1500])], "doc_id long, text string")
    row = language_id.identify_languages(mixed, model).first()
    assert row["lang_pred"] == "en"
    assert 0.5 < row["score"] < 0.85


# op7


def test_repeated_passages(docs, rows):
    found = [tuple(r)[:6] for r in chain_dedup.repeated_passages(docs).collect()]
    assert {(d, p) for d, _, _, p, _, _ in found} >= {(2, 1), (5, 4), (16, 11)}
    assert {d for d, *_ in found} >= {2, 3, 5, 13, 16}
    assert all(p < d or p == d and c < a for d, a, _, p, c, _ in found)
    assert (5, 0, 120, 4, 0, 120) in found
    assert any((d, a, b, c, e) == (13, 80, 150, 100, 170) for d, a, b, _, c, e in found)
    assert not {1, 4, 6, 7, 8, 9, 10, 12, 14, 15, 17} & {d for d, *_ in found}
    cut = as_dict(chain_dedup.cut_passages(docs, chain_dedup.repeated_passages(docs)))
    assert cut[1]["text"] == dict(rows)[1]
    assert cut[2]["text"] == ""
    assert cut[6]["text"] is None
    assert cut[5]["text"].split() == dict(rows)[5].split()[120:]


def test_passages_of_an_empty_table(none):
    assert chain_dedup.repeated_passages(none).count() == 0


def test_chains_weigh_gaps():
    segments = np.array([[0, 20, 0, 20], [22, 40, 23, 41], [500, 520, 300, 320], [10, 30, 400, 420]])
    assert [sorted(c) for c in chain_dedup.chains(segments)][0] == [0, 1]


def test_alignment():
    a = np.arange(60)
    b = np.r_[np.arange(20), 99, np.arange(23, 60)]
    assert chain_dedup.align(a, b) == (57, 0, 60, 0, 58)
    assert chain_dedup.align(a, a + 100) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize(("words_each", "between"), [(100, 34), (100, 100), (100, 190), (400, 600), (60, 40)])
def test_two_exact_passages_with_other_words_between(spark, words_each, between):
    head, tail = prose(31, words_each), prose(32, words_each)
    texts = [(k, " ".join([head, prose(40 + k, between), tail])) for k in (1, 2)]
    found = [tuple(r)[:6] for r in chain_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    covered = {i for d, a, b, *_ in found for i in range(a, b) if d == 2}
    assert covered >= {*range(words_each), *range(words_each + between, 2 * words_each + between)}
    assert all(d == 2 and p == 1 for d, _, _, p, _, _ in found)
    if words_each * 2 < 0.75 * (2 * words_each + between):
        assert len(found) == 2


def test_a_passage_whose_parts_occur_alone_before_it(spark):
    parts = [prose(60 + i, 26) for i in range(4)]
    texts = [(i, f"{prose(70 + i, 40)} {x} {prose(80 + i, 40)}") for i, x in enumerate(parts)] + [(10 + i, f"{prose(90 + i, 30)} {' '.join(parts)} {prose(95 + i, 30)}") for i in range(2)]
    found = [tuple(r)[:6] for r in chain_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    assert (11, 30, 134, 10, 30, 134) in found
    assert {(d, p) for d, _, _, p, _, _ in found} == {(11, 10)}


def test_passages_that_an_earlier_text_hides(spark):
    passage = prose(51, 50).split()
    texts = [(1, f"{prose(53, 40)} {' '.join(passage[2:48])} {prose(54, 40)}")] + [(k, f"{prose(53 + k, 30 + k)} {' '.join(passage)} {prose(63 + k, 40)}") for k in (2, 3)]
    # a text between two others, near to both, which aren't near to each other
    middle = prose(71, 60).split()
    for k, gone in ((11, range(0, 60, 6)), (12, ()), (13, range(3, 60, 6))):
        texts.append((k, f"{prose(72 + k, 30)} {' '.join(f'x{k}y{i}' if i in gone else w for i, w in enumerate(middle))} {prose(92 + k, 30)}"))
    texts += [(14, f"{prose(98, 30)} {' '.join(f'x14y{i}' if i % 6 == 3 and i < 45 else w for i, w in enumerate(middle))} {prose(99, 30)}")]
    found = {(r["doc_id"], r["partner_id"]) for r in chain_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found >= {(3, 2), (12, 11), (13, 12), (14, 12), (14, 13)}


def test_links_of_frequent_seeds(spark):
    line = prose(31, 16)
    texts = [(k, f"{prose(200 + k, 30)} {line} {prose(400 + k, 40)}") for k in range(100)]
    one = prose(32, 60).split()
    texts += [(200 + k, f"{prose(700 + k, 20)} {' '.join(w if (i + k) % 9 else f'x{k}y{i}' for i, w in enumerate(one))} {line} {prose(800 + k, 20)}") for k in range(6)]
    found = {(r["doc_id"], r["partner_id"]) for r in chain_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == {(200 + b, 200 + a) for b in range(6) for a in range(b)}


def test_recall_of_changed_passages(spark):
    rng, texts, planted = np.random.default_rng(8), [], {}
    for n, share in ((n, s) for n in (50, 100) for s in (4, 5, 6, 8, 0.78, 0.85, 0.9) for _ in range(12)):
        k, passage = 2 * len(planted), prose(1000 + len(planted), n).split()
        # every so many words, or so many at random, but for the first and the last
        gone = range(3, n - 1, share) if share >= 1 else rng.choice(np.arange(1, n - 1), round(n * (1 - share)), replace=False)
        changed = [f"changed{k}x{i}" if i in set(gone) else w for i, w in enumerate(passage)]
        planted[k + 1] = (share, n)
        texts += [(k, f"{prose(5000 + k, 60)} {' '.join(passage)} {prose(6000 + k, 60)}"), (k + 1, f"{prose(7000 + k, 90)} {' '.join(changed)} {prose(8000 + k, 60)}")]
    found = {r["doc_id"]: r for r in chain_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    recall = Counter(planted[d] for d in planted if d in found and found[d]["partner_id"] == d - 1)
    print({x: recall[x] / 12 for x in dict.fromkeys(planted.values())})
    assert set(found) <= set(planted)
    assert all(recall[x] >= 11 for x in set(planted.values()))


# op8


def test_notices(spark, docs):
    texts = ["Released under the MIT License.", "released under  the MIT license", "Licensed under CC BY-NC 4.0. And CC BY 4.0", "a license to kill", None, "", prose(1, 30) + " This work is licensed under the GNU General Public License, version 3. " + prose(2, 30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = defaultdict(list)
    for r in license_scan.find_notices(frame).collect():
        found[r["doc_id"]].append((r["license"], r["differing_words"]))
        assert texts[r["doc_id"]][r["start"] : r["end"]] == r["wording"]
    assert found[0] == [("MIT", 0)]
    assert found[1] == [("MIT", 0)]
    assert found[2][0] == ("CC-BY-NC-4.0", 0)
    assert found[6] == [("GPL-3.0", 0)]
    assert set(found) == {0, 1, 2, 6}
    assert license_scan.find_notices(docs.limit(0)).count() == 0


# op9


def grams(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(texts):
    sets, parent = {k: grams(t) for k, t in texts}, {k: k for k, _ in texts}

    def find(k):
        return k if parent[k] == k else find(parent[k])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def test_components_match_brute_force(spark, docs, rows):
    found = as_dict(trie_join.jaccard_components(docs))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in found.items()} == linked(rows)


def test_chains_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base, texts = prose(9, 150).split(), []
    for i in range(120):  # copies with up to nine edits: near some of the others only
        w = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 10)):
            w[at] = f"e{rng.integers(10**6)}"
        texts.append((1000 - i, " ".join(w)))
    found = as_dict(trie_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string")))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in found.items()} == linked(texts)


def test_components_of_an_empty_table(none):
    assert trie_join.jaccard_components(none).count() == 0


@pytest.mark.parametrize("size", [common.LINKS, 7])
def test_components_of_links(spark, size, monkeypatch):
    monkeypatch.setattr(common, "LINKS", size)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 95), (95, 95), (90, 100)]
    found = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {90: 90, 95: 90, 100: 90}
    assert common.components(spark.createDataFrame([(5, 5)], "a long, b long")).count() == 0


# op10


def test_contained_items(spark, docs, rows):
    items = [(1, " ".join(dict(rows)[1].split()[50:80])), (2, " ".join(dict(rows)[15].split()[9000:9006])), (3, prose(77, 30)), (4, None), (5, ""), (6, "one two"), (7, " ".join(dict(rows)[4].split()[:40] + ["odd"]))]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontaminate.find_items(docs, frame).collect()}
    expected = {}
    for d, t in rows:
        for i, x in items:
            g = grams(x)
            if g and len(g & grams(t)) >= 0.75 * len(g):
                expected[d, i] = len(g & grams(t)) / len(g)
    assert found == pytest.approx(expected)
    assert (15, 2) in found
    assert decontaminate.find_items(docs.limit(0), frame).count() == decontaminate.find_items(docs, frame.limit(0)).count() == 0


def test_every_query_is_registered():
    import __spark_entry__

    assert {int(m[1]) for n in __spark_entry__.queries() if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
