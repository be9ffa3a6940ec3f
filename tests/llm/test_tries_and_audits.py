"""The conversation trie, the Hamming join and the filter audit against plain Python, with rows that repeat, tie or lack values."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.llm import common, filter_audit, hamming_join, prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{i}" for i in range(500)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


# op11


def plain_trie(rows):
    """All nodes from whole prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else c + (-c) % 20
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members, nodes = {}, []
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    saved = {p: (len(m) - 1) * (len(WORD.findall(p[-1][1])) if p else 0) for p, m in members.items()}
    for p, m in members.items():
        under = [q for q in members if q[: len(p)] == p]
        children = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in under)]
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        nodes.append((min(m), len(p), parent, len(m), len(children), len(leaves), sum(saved[q] for q in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(nodes, key=str)


def trie_of(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as node", "0 as at", "1 as kind", "text as digest")
    found = prefix_trie.conversation_trie(frame)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_trie_equals_that_of_whole_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HEIGHT", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rng = random.Random(11)
    rows = []
    for c in [*range(-25, 45), 400, 401, 1000]:
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["a b", "c", "d e f"])) for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", f"same {t}") for c in (60, 61, 62, 63, 64) for t in range(30)]  # deeper than any band is high
    rows += [(7, None, None, None), (7, None, None, None), (8, 2, "user", "c"), (8, 2, "user", "c"), (8, 2, "bot", "z"), (None, 1, "user", "a"), (9, 3, None, "  \t"), (9, 3, "", None)]
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_little(spark):
    assert trie_of(spark, []) == []
    # a conversation of as many turns as it drops, without a base, has the root only
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert trie_of(spark, [(alone, 0, "user", "a b c")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    long = "word " * 20_000
    assert trie_of(spark, [(0, 0, "user", long), (20, 0, "user", long), (40, 0, "user", long)]) == plain_trie([(0, 0, "user", long), (20, 0, "user", long), (40, 0, "user", long)])


# op12


def plain_components(rows, k=4, percent=80):
    def grams(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    rows = [(i, t, grams(t)) for i, t in rows if i is not None]
    group = {i: i for i, _, _ in rows}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, (i, _, a) in enumerate(rows):
        for j, _, b in rows[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    return sorted((i, len(g), top(i), i == top(i)) for i, _, g in rows)


def near_of(spark, rows, **more):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "'k' as key", "0 as label", "'s' as sig")
    found = hamming_join.near_duplicates(frame, **more)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(tuple(r) for r in found.collect())


def changed(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def mixed_texts():
    rows = [(i, prose(i, 60 + i)) for i in range(20)]
    base = prose(100, 150)
    rows += [(100 + i, changed(base, i % 6, i)) for i in range(40)]  # around the threshold
    shared = prose(200, 80)
    rows += [(200 + i, shared + " " + prose(300 + i, 40)) for i in range(40)]  # one passage, no links
    rows += [(300 + i, base.upper()) for i in range(10)] + [(310, None), (311, ""), (312, " \t"), (313, "Two words"), (314, "two\tWORDS"), (315, "one two three four"), (None, base), (None, None)]
    rows += [(5, prose(5, 65)), (6, prose(7, 67))]  # ids that repeat, with the same text and with another
    rows += [(400, " ".join(f"v{i}" for i in range(20_000))), (401, " ".join(f"v{i}" for i in range(19_000)))]
    return rows


def plain_with_ids(rows):
    """Rows that share an id are one document."""
    rows = [r for r in rows if r[0] is not None]
    found = plain_components([(n, t) for n, (_, t) in enumerate(rows)])
    label = {n: c for n, _, c, _ in found}
    group = {}
    changing = True
    low = {n: rows[n][0] for n in label}
    while changing:
        changing = False
        for key in (lambda n: ("c", label[n]), lambda n: ("i", rows[n][0])):
            group = {}
            for n in low:
                group.setdefault(key(n), []).append(n)
            for ns in group.values():
                least = min(low[n] for n in ns)
                for n in ns:
                    changing |= low[n] != least
                    low[n] = least
    return sorted((rows[n][0], size, low[n], low[n] == rows[n][0]) for n, size, _, _ in found)


def test_components_equal_those_of_all_pairs(spark, mixed_texts):
    assert near_of(spark, mixed_texts) == plain_with_ids(mixed_texts)


def test_crowds_meet_by_rare_shingles(spark, mixed_texts, monkeypatch):
    monkeypatch.setattr(hamming_join, "GROUP", 4)
    monkeypatch.setattr(hamming_join, "CROWD", 2)
    monkeypatch.setattr(hamming_join, "BLOCK", 3)
    assert near_of(spark, mixed_texts) == plain_with_ids(mixed_texts)


def test_rare_shingles_miss_no_pair(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-(2**62), 2**62, 60)
    sets = []
    for i in range(90):
        keep = base[rng.random(60) > rng.choice([0.02, 0.1, 0.2])]
        own = np.concatenate([rng.integers(-(2**62), 2**62, rng.integers(0, 8)), 1000 * rng.integers(1, 4) + np.arange(rng.integers(0, 12))])
        sets.append(np.unique(np.concatenate([keep, own]).astype(np.uint64)))
    frame = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sets)], "node long, keys binary")
    found = {tuple(r) for r in hamming_join._rare(frame.select("node", F.col("node").alias("label")), frame, 80).collect()}
    near = {(i, j) for j in range(90) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert near and near <= found


def test_no_pair_within_the_radius_is_missed():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << hamming_join.BITS, (400, hamming_join.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for i in range(len(a)):
        if i % 2:  # two errors in all chunks but one: the worst case
            chunks = rng.permutation(hamming_join.CHUNKS)
            at = np.concatenate([hamming_join._EDGES[c] + rng.permutation(5)[: 2 if j else 1] for j, c in enumerate(chunks)])
        else:
            at = rng.permutation(hamming_join.SYMBOLS)[: hamming_join.RADIUS]
        b[i, at] ^= rng.integers(1, 1 << hamming_join.BITS, len(at), dtype=np.uint16)
    agree = hamming_join.lookups(a) == hamming_join.lookups(b)
    chunks = np.array([len(set(hamming_join._CHUNK[row])) for row in agree])
    assert (chunks >= 1).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    both, one, other = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    keys = np.concatenate([both, one, both, other])
    x, y = hamming_join.signatures(common.mix(keys), np.array([0, 900]))
    assert (x != y).mean() == pytest.approx(0.2, abs=0.12)


def test_near_duplicates_of_nothing(spark):
    assert near_of(spark, []) == []
    assert near_of(spark, [(1, None), (2, "")]) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError):
        near_of(spark, [], percent=75)


# op13


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    docs = []
    for d, text, lang in rows:
        text, words = text or "", WORD.findall(text or "")
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        fails["E"] = d is not None and any(e is not None and e < d and (t or "") == text for e, t, _ in rows)
        docs.append((lang or "", {k for k, v in fails.items() if v}, d is not None and d in good, d is not None and d in toxic))
    out = []
    for part in {p for p, *_ in docs}:
        mine = [x for x in docs if x[0] == part]
        removed = {}
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                removed[f] = removed.get(f, 0) + sum(f in x[1] and not x[1] & set(order[:s]) for x in mine)
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                here = [x for x in mine if f in x[1] and not x[1] & set(order[:s])]
                kept = sum(not x[1] & set(order[: s + 1]) for x in mine)
                redundant = sum(f in x[1] for x in mine) - len(here)
                out.append((part, "".join(order), s + 1, kept, len(here), redundant, sum(x[1] == {f} for x in mine), sum(x[2] for x in here), sum(x[3] for x in here), removed[f]))
    return sorted(out)


def audit_of(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as n", "2 as code", "'p' as part", "0 as good")
    found = filter_audit.audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 as doc"))
    return sorted(tuple(r) for r in found.collect())


def test_audit_equals_filters_one_after_the_other(spark):
    rng = random.Random(13)
    rows = []
    for i in range(150):
        text = prose(rng.randrange(60), rng.choice([20, 99, 100, 140]))
        text = text.upper() if rng.random() < 0.2 else text
        text += rng.choice(["", "", " #", "|"]) + (" w1" * 60 if rng.random() < 0.3 else "")
        rows.append((i, text, rng.choice(["en", "de", None, ""])))
    rows += [(200, None, "en"), (201, "", None), (202, "é" * 50 + "ABCDEF", "fr"), (3, rows[3][1], "en"), (3, rows[3][1], "en"), (None, rows[3][1], "de"), (None, None, None), (203, prose(1, 20_000), "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    assert audit_of(spark, rows, labels) == plain_audit(rows, labels)


def test_audit_of_nothing(spark):
    assert audit_of(spark, [], []) == []


def test_fields_do_not_overflow():
    wide = filter_audit.wide_counters("ABCDE")
    most = 2**63 - 1
    step = filter_audit._unpacked("ABCDE", "x", most * wide[0b10001]).to_pydict()
    assert set(step["removed"]) == {0, most} and max(step["kept"]) == most and max(step["redundant"]) == most
