"""ProbMinHash classes against brute force over all pairs, with groups of
copies, chains and shared passages."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from turnmill.llm import probminhash as P


def brute(docs):
    """Connected components of five-word Jaccard >= 0.8 over all pairs."""
    def sets(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    s = {i: sets(t) for i, t in docs.items() if t is not None}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(s)
    for x, i in enumerate(keys):
        for j in keys[x + 1 :]:
            if docs[i] == docs[j] or s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in docs}


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(60)]
    docs, n = {}, 0

    def add(words):
        nonlocal n
        docs[n] = " ".join(words)
        n += 1

    for size in (1, 1, 2, 3, 6, 12):
        base = [word() for _ in range(r.randint(40, 250))]
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 120))):
                w[r.randrange(len(w))] = word()
            add(w)
    for _ in range(12):  # a shared passage alone makes no duplicates
        add(passage + [word() for _ in range(r.randint(50, 90))])
    chain = [word() for _ in range(200)]
    for step in range(8):  # each near the next, the ends apart
        add(chain[step * 4 : 200 + step * 4 - 32] + [word() for _ in range(0)])
    for _ in range(9):
        add(passage)
    add(["one", "two"]), add(["one", "two"]), add(["one", "two", "three"]), add([])
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_match_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(sorted(docs.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in P.classes(df).collect()}
    assert got == brute(docs)
    left = sorted(r["doc_id"] for r in P.deduplicated(df).collect())
    assert left == sorted(set(brute(docs).values()))


def test_hot_groups(spark):
    """A third of the rows exact copies, a third near copies of one text."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(200)]
    rows = [(i, "same text of six words here") for i in range(300)]
    for i in range(300, 600):
        w = list(base)
        w[r.randrange(200)] = word()
        w[r.randrange(200)] = word()
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(word() for _ in range(30))) for i in range(600, 900)]
    got = {x["doc_id"]: x["class_id"] for x in P.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {got[i] for i in range(300)} == {0} and {got[i] for i in range(300, 600)} == {300}
    assert all(got[i] == i for i in range(600, 900))


def test_template_family_of_small_clusters(spark):
    """Small clusters at about 0.82 on one template, which makes all texts
    about 0.74 near to each other, in one bucket that all share."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    template = [word() for _ in range(200)]
    docs = {}
    for k in range(20):
        own = [word() for _ in range(35)]
        for _ in range(2 + (k % 5 == 0)):
            w = template + own
            for at in r.sample(range(200), 2):
                w[at] = word()
            docs[len(docs)] = " ".join(w)
    df = spark.createDataFrame(sorted(docs.items()), "id bigint, text string")
    texts = P.texts_of(df).withColumn("buckets", F.array(F.lit(1).cast("bigint")))
    id_of = {bytes(x["key"]): x["id"] for x in texts.collect()}
    _, of = P.linked(df, texts)
    got: dict[bytes, list[int]] = {}
    for x in of.collect():
        got.setdefault(bytes(x["class"]), []).append(id_of[bytes(x["key"])])
    want: dict[int, list[int]] = {}
    for i, c in brute(docs).items():
        want.setdefault(c, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1) and len(got) >= 15


def family(n, seed=11):
    """Texts of 18 of 30 common lines each, and every tenth text again with
    one word changed."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    lines = [" ".join(word() for _ in range(12)) for _ in range(30)]
    docs = []
    for i in range(n):
        docs.append("\n".join(lines[x] for x in sorted(r.sample(range(30), 18))))
        if i % 10 == 0:
            w = docs[-1].split(" ")
            w[r.randrange(len(w))] = word()
            docs.append(" ".join(w))
    return dict(enumerate(docs))


def test_families_of_common_parts_list_no_pairs(spark, monkeypatch):
    """Candidates that reach the texts grow in proportion; classes are those
    of brute force."""
    monkeypatch.setattr(P, "HOT", 16)
    seen = []
    whole = P.verified
    monkeypatch.setattr(P, "verified", lambda pairs, *a: seen.append(pairs.count()) or whole(pairs, *a))
    counts = []
    for n in (150, 600):
        docs = family(n)
        df = spark.createDataFrame(sorted(docs.items()), "doc_id bigint, text string")
        seen.clear()
        got = {r["doc_id"]: r["class_id"] for r in P.classes(df).collect()}
        assert got == brute(docs)
        counts.append(seen[-1])
    assert counts[1] <= 600 and counts[1] <= 6 * max(counts[0], 30)


def test_sharp_bands_find_pairs_at_the_threshold(spark):
    """Of texts at 0.8 to 0.82 all pairs come out, of those at 0.5 hardly any."""
    r = random.Random(12)
    words = lambda n: ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    rows = []
    for i in range(200):
        base, cut = words(300), 272 if i < 100 else 200
        for t in (base, base[:cut] + words(300 - cut)):
            text = " ".join(t)
            rows.append((str(len(rows)).zfill(4).encode(), str(i * 2 + len(rows) % 2).encode(), len(P.shingles(text)[0]), text))
        x, y = (set(P.shingles(z[3])[0].tolist()) for z in rows[-2:])
        assert (len(x & y) >= 0.8 * len(x | y)) == (i < 100)
    df = spark.createDataFrame(rows, "key binary, class binary, n int, text string")
    none = spark.createDataFrame([], "a binary, b binary")
    pairs = P.likely(none, df.drop("text"), df.select("key"), df.select("key", "text")).collect()
    assert {(int(bytes(x["a"])), int(bytes(x["b"]))) for x in pairs} == {(2 * i, 2 * i + 1) for i in range(100)}


def test_repeated_passages_share_a_bucket():
    """Pairs at 0.8 or more whose shared passage stands 100 times in one
    text and once in the other."""
    r = random.Random(8)
    words = lambda n: ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    missed = 0
    for _ in range(120):
        passage, rest, own = words(60), words(136), words(16)
        a, b = " ".join(passage * 100 + rest + own), " ".join(passage + rest + words(14))
        x, y = P.shingles(a)[0], P.shingles(b)[0]
        both = len(np.intersect1d(x, y))
        assert both >= 0.8 * (len(x) + len(y) - both)
        (got,) = P.sketched([pd.DataFrame({"id": [1, 2], "text": [a, b]})])
        missed += not set(got["buckets"][0]) & set(got["buckets"][1])
    assert missed == 0


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(3)
    ids = r.integers(0, 2**63, 400).astype(np.uint64)
    a = (ids[:300], r.integers(1, 4, 300))
    b = (ids[100:], np.concatenate([a[1][100:], r.integers(1, 4, 100)]))
    wa = dict(zip(a[0].tolist(), 1 + np.log(a[1])))
    wb = dict(zip(b[0].tolist(), 1 + np.log(b[1])))
    both = set(wa) & set(wb)
    exact = sum(1 / sum(max(wa.get(k, 0) / wa[d], wb.get(k, 0) / wb[d]) for k in set(wa) | set(wb)) for d in both)
    s = P.signatures([a, b], slots=8192)
    assert abs((s[0] == s[1]).mean() - exact) < 0.02
    assert (P.signatures([a])[0] == P.signatures([b, a, (ids[:0], ids[:0])])[1]).all()


def test_components_follow_long_paths(spark):
    n = 60
    key = lambda i: i.to_bytes(2, "big")
    rows = [(key(i), key(i + 1)) for i in range(n)] + [(key(200), key(201))]
    random.Random(1).shuffle(rows)
    got = {bytes(r["key"]): bytes(r["class"]) for r in P.components(spark.createDataFrame(rows, "a binary, b binary")).collect()}
    assert got == {key(i): key(0) for i in range(n + 1)} | {key(200): key(200), key(201): key(200)}
