"""Operators with an exact answer against brute force or their SQL twin."""

import math
import random
import re
import warnings
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import compare, duck
from turnmill.llm import decontaminate, line_windows, maxscore, mixing, registry, secret_scan, sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    ok, _, _, detail = compare(spark, duck(SF), SF, name, registry.QUERIES[name], registry.SQL[name])
    assert ok, detail


@pytest.mark.parametrize("seed", [1, 2])
def test_search_matches_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-3, -1, 0, 0, 2, 5]) * r.randint(0, 9) for _ in range(r.choice([6, 6, 6, 4]))]) for i in range(400)]
    rows += [(400 + i, [1, 2, 3, 4, 5, 6]) for i in range(150)]  # one common vector
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    queries = df.where("vec_id % 20 = 0")
    want = []
    for q, v in rows:
        if q % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:7]
            want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    got = maxscore.top_k(df, queries, k=7, shard_rows=90, block_queries=11)
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)
    huge = spark.createDataFrame([(0, [2**28]), (1, [2**28 + 1]), (2, [-(2**28)])], "vec_id bigint, v array<bigint>")
    best = [tuple(x)[2:] for x in maxscore.top_k(huge, huge.where("vec_id = 0")).orderBy("rank").collect()]
    assert best == [(1, 2**28 * (2**28 + 1)), (2, -(2**56))]


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "huge"])
def test_ranges_of_postings_lose_no_result(monkeypatch, kind):
    monkeypatch.setattr(maxscore, "FIRST", 16)
    g = np.random.default_rng(len(kind))
    for k in (1, 7, 40):
        c = {"dense": lambda: g.normal(0, 20, (700, 24)).round(), "sparse": lambda: g.integers(-9, 9, (700, 24)) * (g.random((700, 24)) < 0.1),
             "ties": lambda: g.integers(-1, 2, (700, 24)), "huge": lambda: g.integers(-(2**27), 2**27, (700, 24))}[kind]()
        c = c.astype(np.int64 if kind == "huge" else np.float64)
        c[:, 3], c[100:150] = 5, c[100]  # a term that tells nothing, copies
        ids = g.permutation(700)
        work = Counter()
        for q_id, found, scores in maxscore.search(ids[:40], c[:40], ids, c, k, work):
            all_scores = c @ c[list(ids).index(q_id)]
            want = sorted((-int(s), int(i)) for i, s in zip(ids, all_scores) if i != q_id)[:k]
            assert [(-int(s), int(i)) for i, s in zip(found, scores)] == want
        assert work["candidates"] == 40 * 700 and work["postings"] == 24 * 40 * 700
        if kind == "dense" and k < 40:  # bounds do the work
            assert work["full"] < 0.3 * work["candidates"] and work["read"] < 0.85 * work["postings"]


def test_margins_that_are_not_met_are_reported(spark, monkeypatch):
    rows = [(i, "x " * (i % 7) + ("@" if i % 3 else ""), f"s{i % 5}", f"l{i * i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="raking ended")
        mixing.mix_table(df)
    monkeypatch.setattr(mixing, "ROUNDS", 1)
    with pytest.warns(UserWarning, match="off by up to"):
        assert mixing.mix_table(df).count() == 300


def edits_anywhere(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_distance_matches_dynamic_programming():
    r = random.Random(3)
    for _ in range(200):
        item = "".join(r.choice("abc ") for _ in range(r.randint(1, 90)))
        text = "".join(r.choice("abc ") for _ in range(r.randint(0, 120)))
        assert decontaminate.Pattern(item).nearest(text)[0] == edits_anywhere(item, text)


def test_leaks_match_brute_force(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(r.randint(9, 40)))) for i in range(12)]
    docs = []
    for i in range(150):
        words = [word() for _ in range(r.randint(0, 60))]
        if r.random() < 0.6:
            text = list(r.choice(items)[1])
            for _ in range(r.choice([0, 1, 3, 5, 9, 14, 20])):
                k, at = r.random(), r.randrange(len(text))
                text[at : at + (k < 0.7)] = [] if k < 0.3 else [r.choice("abcdefgh")]
            text = "".join(text)
            words.insert(r.randint(0, len(words)), text.upper() if r.random() < 0.3 else text.replace(" ", r.choice([" ", ",\n", " - "])))
        docs.append((i, " ".join(words)))
    want = set()
    for i, t in docs:
        for j, x in items:
            n = decontaminate.normal(x)
            d = edits_anywhere(n, decontaminate.normal(t))
            if len(n) >= decontaminate.MIN_ITEM and d <= int(len(n) * decontaminate.ERROR_RATE):
                want.add((i, j, d))
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(x) for x in decontaminate.leak_table(df, bench).collect()}
    assert got == want and 20 < len(want) < 100
    blocks = decontaminate.flagged(df, bench, block_chars=200)
    assert {(x["doc_id"], y["item"], y["edits"]) for x in blocks.collect() for y in x["leaks"]} == want


def test_base_spans_match_a_plain_scan():
    r = random.Random(5)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "=", ":", "AKIA", "A1B2C3", "deadbeef", "0123456789abcdef",
            "xyz", "é", "\n", "/+.-_", "ſecret", "K"]
    pattern = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for _ in range(3000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 25)))
        want = [(m.start(), m.end(), "assign") for m in re.finditer(pattern, t) if len(m[2]) >= 12]
        want += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert sorted(secret_scan.base_spans(t)) == sorted(want)


def test_lexer_binds_literals_to_names():
    def found(t):
        return [(t[a:b], name) for a, b, _, name, _ in secret_scan.literal_spans(t)]

    assert found('k = "abCD1234efgh"\ndb_password = k') == [("abCD1234efgh", "db_password")]
    assert found("export API_KEY='Zx9-Qw8-Er7'") == [("Zx9-Qw8-Er7", "API_KEY")]
    assert found('{"clientSecret": "s3cr3tV4lue"}') == [("s3cr3tV4lue", "clientSecret")]
    assert found('auth_token = "ab12" + "CD34ef"') == [("ab12", "auth_token"), ("CD34ef", "auth_token")]
    assert found('settings["private_key"] := "Kj82hfL0pQ"') == [("Kj82hfL0pQ", "private_key")]
    assert found("password: changeme\npasswd = 'example-value'\ntoken = ${TOKEN}\ncolor = 'abCD1234efgh'") == []
    assert found("see http://host:8080/path and password == abCD1234efgh, std::token") == []


def test_shards_follow_the_law(spark):
    n = 1003
    df = spark.createDataFrame([(i, "t" * (i % 9)) for i in range(n)], "doc_id bigint, text string")
    got = sharding.shard_table(df, shards=40).collect()
    by = {}
    for x in got:
        by.setdefault(x["shard"], []).append(x["slot"])
    assert sorted(by) == list(range(40)) and {len(v) for v in by.values()} == {25, 26}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert [(x["size"], x["law"], x["grown_shard"]) for x in got if x["doc_id"] == 8] == [(24, "rows", None)]


def test_matrix_has_its_margins_and_law(spark):
    counts = spark.createDataFrame([(p, 10 + 7 * p) for p in range(8)], "part bigint, n bigint")
    cells = {}
    for seed in range(40):
        m = sorted((x["part"], x["takes"]) for x in sharding.communication_matrix(counts, 5, 8, seed).collect())
        assert [sum(t) for _, t in m] == [10 + 7 * p for p in range(8)]
        assert max(sum(c) for c in zip(*(t for _, t in m))) - min(sum(c) for c in zip(*(t for _, t in m))) <= 1
        cells.setdefault("x", []).append(m[7][1][0])
    mean = sum(cells["x"]) / 40
    n, good, draws = 276, 56, 59
    sd = math.sqrt(draws * good / n * (1 - good / n) * (n - draws) / (n - 1) / 40)
    assert abs(mean - draws * good / n) < 4.5 * sd


def test_hypergeometric_draws(spark):
    u = f"shiftrightunsigned(xxhash64(id), 11) * {2.0**-53!r}D"
    k = 20000
    got = {x["x"]: x["count"] for x in spark.range(k).select(F.expr(sharding.hypergeometric("50L", "20L", "15L", u)).alias("x")).groupBy("x").count().collect()}
    expected = {x: k * math.comb(20, x) * math.comb(30, 15 - x) / math.comb(50, 15) for x in range(16)}
    chi2 = sum((got.get(x, 0) - e) ** 2 / e for x, e in expected.items() if e > 5)
    assert chi2 < 35  # 11 degrees of freedom
    big = spark.range(300).select(F.expr(sharding.hypergeometric("10000000000L", "250000000L", "5000000000L", u)).alias("x"))
    mean, sd = big.agg(F.avg("x"), F.stddev("x")).first()
    want = math.sqrt(5e9 * 0.025 * 0.975 * 0.5)
    assert abs(mean - 1.25e8) < 5 * want / math.sqrt(300) and 0.8 < sd / want < 1.2


def test_mix_meets_its_targets(spark):
    r = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(r.randint(1, 40))) + r.choice(["", " a@b", " | "]), r.choice(["en"] * 5 + ["de", None]),
             r.choice(["big"] * 6 + ["s1", "s2", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    powers = {"source": 0.5, "lang": 0.7, "topic": 0.8}
    got = mixing.mix(df, powers=powers).select(F.col("row.source").alias("source"), F.col("row.lang").alias("lang"),
                                               F.col("_t").alias("topic"), "_tokens", "_p", "_kept").collect()
    total = sum(x["_tokens"] * x["_p"] for x in got)
    for margin, power in powers.items():
        seen, now = {}, {}
        for x in got:
            seen[x[margin]] = seen.get(x[margin], 0) + x["_tokens"]
            now[x[margin]] = now.get(x[margin], 0) + x["_tokens"] * x["_p"]
        raised = {k: v**power for k, v in seen.items()}
        for k in seen:
            assert abs(now[k] / total - raised[k] / sum(raised.values())) < 1e-6
    assert max(x["_p"] for x in got) == 1.0
    kept = sum(x["_tokens"] for x in got if x["_kept"])
    assert abs(kept / total - 1) < 0.1


def test_short_items_and_items_without_id_are_found(spark):
    items = spark.createDataFrame([(1, "What is the capital of France?"), (None, "an item that no one gave an id, but long enough"), (3, "cat"), (4, " ?! ")],
                                  "item_id bigint, text string")
    docs = spark.createDataFrame([
        (0, "so: what is the CAPITAL of france"), (1, "what is the capital of frances"), (2, "concatenate"), (3, "a cat, here"),
        (4, "An item that no one gave an id, but long enough!"), (5, "cats"), (6, None), (7, "")], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leak_table(docs, items).collect()}
    assert got == {(0, 1), (3, 3), (4, None)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [1, 2, 5, 6, 7]


def test_self_reference_costs_what_it_adds():
    import time

    t0 = time.time()
    found = secret_scan.literal_spans('token = "aB3$xK9pQ2mZ"\n' + "token = token + token\n" * 60)
    assert [x[:2] for x in found] == [(9, 21)]
    many = "".join(f'password = password + "q{i:07d}Z"\n' for i in range(8000))
    assert len(secret_scan.literal_spans('password = "aB3$xK9pQ2mZ"\n' + many)) == 8001
    chain = 'a0 = "aB3$xK9pQ2mZ"\n' + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(50)) + "secret = a50\n"
    assert [x[:2] for x in secret_scan.literal_spans(chain)] == [(6, 18)]
    assert time.time() - t0 < 10


def test_constants_reach_sensitive_names_as_in_a_plain_propagation():
    """Random assignments of fresh literals and earlier names, against sets
    that are carried along one by one."""
    r = random.Random(8)
    for _ in range(200):
        names, lines, holds, at, want = ["a", "b", "c", "token", "d"], [], {}, 0, set()
        for i in range(r.randrange(1, 12)):
            name, terms, got = r.choice(names), [], []
            for _ in range(r.randrange(1, 3)):
                if r.random() < 0.5 and holds:
                    ref = r.choice(sorted(holds))
                    terms.append(ref)
                    got += holds[ref]
                else:
                    terms.append(f'"{r.choice("xyzXYZ")}k{r.randrange(10**9):09d}Q"')
                    start = at + len(name) + 3 + sum(len(t) + 3 for t in terms[:-1]) + 1
                    got.append((start, start + len(terms[-1]) - 2))
            line = f"{name} = {' + '.join(terms)}\n"
            holds[name] = list(dict.fromkeys(got))
            if name == "token":
                want |= set(got)
            lines.append(line)
            at += len(line)
        found = {x[:2] for x in secret_scan.literal_spans("".join(lines))}
        assert found == want


def test_copies_of_a_row_give_each_place_once(spark):
    text = "one\ntwo\nthree\nfour"
    df = spark.createDataFrame([(1, text)] + [(2, text)] * 3000 + [(None, text)] * 3000, "doc_id bigint, text string")
    rows = df.select(F.col("doc_id").alias("id"), "text").withColumn("key", F.md5("text"))
    gone = {r.id: r.gone for r in line_windows.removed_lines(rows).collect()}
    assert gone == {2: [0, 1, 2, 3], None: [0, 1, 2, 3]}


def test_equal_rows_spread_over_shards(spark):
    """100,000 equal rows beside others: exact counts, gapless slots, every
    partition of the matrix used, with blocks of a few copies too."""
    hot = spark.range(100_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    rest = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    df = hot.unionByName(rest)
    apart = sharding.told_apart(df, ["doc_id", "text"], block_bits=7)
    assert apart.count() == apart.distinct().count() == 102_000
    assert apart.select(F.pmod(F.xxhash64("doc_id", "text", "nth"), F.lit(512)).alias("p")).distinct().count() == 512
    for got in (sharding.shard_table(df), sharding.shard_documents(df.withColumn("more", F.lit(1)), block_bits=7)):
        by = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("lo"), F.max("slot").alias("hi"))
        assert [(r["n"], r["d"], r["lo"], r["hi"]) for r in by.collect()] == [(2550, 2550, 0, 2549)] * 40
        assert got.where("doc_id is null").count() == 100_000 and got.where("doc_id is not null").select("doc_id").distinct().count() == 2000
        hot_in = [r["count"] for r in got.where("doc_id is null").groupBy("shard").count().collect()]
        assert len(hot_in) == 40 and max(hot_in) < 2550
