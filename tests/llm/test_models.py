"""Language identification, language model and quality classifier:
brute-force versions of their parts, gradients, held-out accuracy."""

import math
import random
import zlib
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pytest

from turnmill.llm import gru_lm, language_id, quality


# ------------------------------------------------------ language identification

def brute_phrases(text, sample):
    """Longest-match parse of a code sequence against a sample, by search."""
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i : i + k] in sample:
            k += 1
        n += 1
        i += max(1, k - 1)
    return n


@pytest.mark.parametrize("seed", range(5))
def test_phrases_equal_a_search_for_longest_matches(seed):
    r = random.Random(seed)
    sample = [r.randint(2, 6) for _ in range(r.randint(1, 300))]
    alphabet = 9
    table = language_id.automaton(sample, alphabet)
    as_text = "".join(map(chr, sample))
    model = language_id.Languages.__new__(language_id.Languages)
    model.tables, model.codes = [table], [np.arange(alphabet, dtype=np.uint8)]
    texts = [[r.randint(2, 8) for _ in range(r.randint(1, language_id.WINDOW))] for _ in range(20)]
    lanes = np.zeros((language_id.WINDOW, len(texts)), np.uint32)
    for k, t in enumerate(texts):
        lanes[: len(t), k] = t
    got = model.phrases(lanes)[:, 0].tolist()
    assert got == [brute_phrases("".join(map(chr, t)), as_text) for t in texts]


def test_held_out_languages(spark):
    r = random.Random(1)
    parts = {"a": ["ba", "lo", "ti", "en"], "b": ["sch", "ung", "er", "ich"], "c": ["ção", "os", "la", "qu"]}
    rows = [(i, " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 60))), lang)
            for i, lang in enumerate(r.choice("abc") for _ in range(400))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = language_id.identify(df.where("doc_id % 2 = 0").drop("lang"), df.where("doc_id % 2 = 1"))
    truth = {i: lang for i, _, lang in rows}
    hits = [truth[x["doc_id"]] == x["lang_pred"] for x in got.collect()]
    assert len(hits) == 200 and sum(hits) / len(hits) >= 0.98


def test_languages_of_many_letters_are_told_apart():
    r = random.Random(11)
    scripts = {"aa": range(0x4E00, 0x5200), "bb": range(0x5200, 0x5600), "cc": range(0xAC00, 0xB000)}
    text = lambda k: "".join(chr(r.choice(scripts[k])) for _ in range(r.randint(1, 400)))
    model = language_id.Languages(tuple((k, tuple(text(k) for _ in range(language_id.PIECES))) for k in scripts))
    truth = [r.choice(list(scripts)) for _ in range(300)]
    assert model.judge([text(k) for k in truth])[0] == truth


def test_language_of_copies_is_learned_whole(spark):
    rows = [(f"text {i % 100} of a language of copies", "aa") for i in range(20_000)] + [("the only text", "bb")] * 3000
    got = dict(language_id.learn(spark.createDataFrame(rows, "text string, lang string")))
    assert len(got["aa"]) == language_id.PIECES == len(set(got["aa"])) and got["bb"] == ("the only text",)


# ---------------------------------------------------------------- language model

def small_vocabulary(r, n=600):
    words = [bytes(r.choice(b"abcdef") for _ in range(r.randint(1, 4))) for _ in range(4000)]
    c = Counter(words)
    top = sorted(((k, w) for w, k in c.items()), key=lambda x: (-x[0], x[1]))
    mass = [gru_lm.SMOOTH] * gru_lm.TAILS
    for k, w in top:
        mass[gru_lm.tail_of(w)] += k + gru_lm.SMOOTH
    kept = top[:n]
    for k, w in kept[: gru_lm.SHORTLIST]:
        mass[gru_lm.tail_of(w)] -= k + gru_lm.SMOOTH
    return gru_lm.Vocabulary([w for _, w in kept], [k for k, _ in kept], len(words) + 50, len(c) + 1, mass, 50), words


def test_gradient_matches_differences():
    r = random.Random(2)
    v, words = small_vocabulary(r)
    w = {k: x.astype(np.float64) for k, x in gru_lm.start_weights(v).items()}
    g = np.random.default_rng(0)
    w["cw"] += g.normal(0, 0.3, w["cw"].shape)
    w["uw"] += g.normal(0, 0.3, w["uw"].shape)
    steps, lanes = 5, 3
    tokens = np.array([[r.choice([*range(40), v.end, v.first_unknown + 3]) for _ in range(lanes)] for _ in range(steps + 1)])
    now, nxt = tokens[:-1], tokens[1:]
    mask = np.array([[r.random() < 0.9 for _ in range(lanes)] for _ in range(steps)])
    going = (now != v.end).astype(np.float64)
    h0 = g.normal(0, 0.3, (lanes, gru_lm.HIDDEN))

    def loss():
        h, total = h0, 0.0
        for t in range(steps):
            h, _ = gru_lm.cell(w, v.inp[now[t]], h * going[t][:, None])
            logs = gru_lm.token_logs(w, h, v.cls[nxt[t]], v.inner[nxt[t]]) * math.log(10)
            total -= (logs * mask[t]).sum()
        return total / mask.sum()

    found, _ = gru_lm.window_gradient(w, v.inp[now], v.cls[nxt], v.inner[nxt], mask, h0, going)
    for name in gru_lm.SHAPES:
        flat, grad = w[name].reshape(-1), found[name].reshape(-1)
        for at in np.argsort(-np.abs(grad))[:4]:
            old = flat[at]
            flat[at] = old + 1e-5
            up = loss()
            flat[at] = old - 1e-5
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4 * max(1, abs(grad[at])), name


def test_probabilities_sum_to_one():
    v, _ = small_vocabulary(random.Random(3), n=100_000)
    w = gru_lm.start_weights(v)
    state = np.random.default_rng(1).normal(0, 1, (1, gru_lm.HIDDEN)).astype(np.float32)
    ids = np.arange(v.end + 1)
    p = gru_lm.token_logs(w, np.repeat(state, len(ids), 0), v.cls[ids], v.inner[ids]) + v.within[ids]
    # An unknown word per tail class stands for all words never seen.
    unknown = np.arange(v.first_unknown, v.end)
    p[unknown] += math.log10(gru_lm.SMOOTH)
    assert abs((10**p).sum() - 1) < 1e-3


def test_scores_do_not_depend_on_company_or_windows(monkeypatch):
    r = random.Random(4)
    v, words = small_vocabulary(r)
    w = gru_lm.start_weights(v)
    texts = [np.append(v.encode([r.choice(words) for _ in range(n)]), np.int32(v.end)) for n in (0, 1, 15, 16, 17, 200, 3)]
    together = gru_lm.scores(w, v, texts)
    alone = [gru_lm.scores(w, v, [t])[0] for t in texts]
    monkeypatch.setattr(gru_lm, "STEPS", 7)
    cut = gru_lm.scores(w, v, texts)
    assert np.allclose(together, alone, rtol=1e-5) and np.allclose(together, cut, rtol=1e-5)


def test_words_are_split_as_bytes():
    texts = [" a\x0b B\x85c  ", "", "\x1c\x1d x", " ", "É" * 40 + " Q\x0cz\r\n", "x" * 64 + " " + "X" * 65 + "\t\x00 \x1f", "last"]
    words, n = gru_lm.split_texts(pa.array(texts))
    plain = [t.encode().lower().split() for t in texts]
    assert n.tolist() == [len(x) for x in plain]
    long = lambda w: w if len(w) <= gru_lm.LONG else b" " + blake2b(w, digest_size=16).digest()
    assert words.to_pylist() == [long(w) for x in plain for w in x]
    assert [len(x) for x in gru_lm.split_texts(pa.array([], pa.string()))] == [0, 0]


def test_classes_are_scored_for_many_windows_at_once(monkeypatch):
    v, words = small_vocabulary(random.Random(8))
    calls, logs = [], gru_lm.token_logs
    monkeypatch.setattr(gru_lm, "token_logs", lambda w, states, *a: calls.append(len(states)) or logs(w, states, *a))
    gru_lm.scores(gru_lm.start_weights(v), v, [np.append(v.encode(words[:2000]), np.int32(v.end))])
    assert calls == [2001]


def test_base_scores_counts_and_gain(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "VOCABULARY", 60)  # most words come by the join
    r = random.Random(5)
    kinds = [[f"{c}{i}" for i in range(40)] for c in "xyz"]
    rows = []
    for i in range(600):
        words = r.choice(kinds)
        rows.append((i, " ".join(r.choice(words) + ("Q" * r.randint(0, 70) if r.random() < 0.02 else "") for _ in range(r.randint(0, 60)))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    got = {x["id"]: x for x in gru_lm.score_texts(df, df.where("crc32(cast(doc_id as string)) % 5 != 1")).collect()}
    token = lambda t: [*"".join(c.lower() if c.isascii() else c for c in t).split(), None]
    c = Counter(w for i, t in rows if i not in held for w in token(t))
    total, distinct = sum(c.values()), len(c)
    for i, t in rows:
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in token(t))
        x = got[i]
        assert abs(x["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (len(token(t)), sum(w in c for w in token(t)), total)
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_copies_are_spread_over_workers(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "WORKER_TOKENS", 6400)
    texts = spark.createDataFrame([([1] * 20, 2000)] + [([i, 2], 1) for i in range(2000)], "ids array<int>, copies bigint")
    got = gru_lm.deal(texts, 7).collect()
    copies, load = Counter(), Counter()
    for x in got:
        copies[tuple(x["ids"])] += x["copies"]
        load[x["worker"]] += x["copies"] * len(x["ids"])
    assert copies == {tuple(x["ids"]): x["copies"] for x in texts.collect()}
    assert max(load.values()) < 1.5 * 6400


def test_all_texts_are_learned_with_production_settings(spark, monkeypatch):
    r = random.Random(9)
    kinds = [[f"{c}{i}" for i in range(30)] for c in "xyz"]
    draw = lambda: " ".join(r.choices(r.choice(kinds), k=30))
    rows = [(i, draw()) for i in range(600)] + [(i, "one hot text of some words") for i in range(600, 900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = {}
    deal = gru_lm.deal
    monkeypatch.setattr(gru_lm, "deal", lambda texts, n: seen.update(n=texts.agg({"copies": "sum"}).first()[0]) or deal(texts, n))
    held = spark.createDataFrame([(i, draw()) for i in range(100)], "doc_id bigint, text string")
    got = gru_lm.score_texts(held, df).collect()
    assert seen["n"] == 900
    assert sum(x["score"] for x in got) > sum(x["base_score"] for x in got) + 100


# ------------------------------------------------------------ quality classifier

def test_quality_decisions_and_sites(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("aeioubcdfglmnprst") for _ in range(r.randint(2, 9)))
    rows, labels = [], []
    for i in range(1200):
        kind = r.choice(["ok"] * 6 + ["bad", "toxic"])
        words = [word() for _ in range(r.randint(30, 120))]
        if kind == "bad":
            words = [w + r.choice(["%%%", "###"]) for w in words]
        if kind == "toxic":
            words[r.randrange(len(words))] = r.choice(["vermin", "filth"]).capitalize() + ","
        rows.append((i, " ".join(words), "en", f"s{i % 7}"))
        labels.append((i, int(kind != "bad"), int(kind == "toxic")))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id bigint, quality int, toxic int")
    kept = {x["doc_id"] for x in quality.accepted(docs, known).collect()}
    unseen = [x for x in labels if x[0] % 2 == 0]
    clean = [i for i, q, t in unseen if q and not t]
    assert len([i for i in clean if i in kept]) >= 0.99 * len(clean)
    poor = [i for i, q, t in unseen if not q or t]
    assert len([i for i in poor if i in kept]) <= 0.02 * len(poor)


def test_sparse_sites_lean_on_their_parent(spark):
    paths = spark.createDataFrame([("h1", "a", 1000, 900.0), ("h1", "b", 2, 0.0), ("h2", "a", 1000, 10.0), ("h3", "a", 1, 1.0)],
                                  "_h string, _p string, n bigint, low double")
    got = {(x["_h"], x["_p"]): x["low_rate"] for x in quality.site_rates(paths, 0.45, "low").collect()}
    assert got["h1", "a"] > 0.88 and got["h2", "a"] < 0.03
    assert 0.5 < got["h1", "b"] < 0.9  # near its host, not at zero
    assert 0.4 < got["h3", "a"] < 0.9  # one document moves it little


def test_empty_texts_are_judged_by_their_labels(spark):
    r = random.Random(10)
    blank = [None, "", "  "]
    rows = [(i, blank[i // 4 % 3] if i % 4 == 0 else " ".join(r.choices("abcdefghijkl", k=40)), "en", "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    known = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)], "doc_id bigint, quality int, toxic int")
    kept = {x["doc_id"] for x in quality.accepted(docs, known).collect()}
    assert kept == {i for i in range(400) if i % 4}
