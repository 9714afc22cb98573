"""Phrases, packing and the conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from turnmill.llm import burst_trie, packing, transducers

PUBLIC = pytest.importorskip("public_tokenizers")
TOKENIZER = PUBLIC.path("byte_bpe_50k.json")


def plain(rows):
    return sorted(map(str, map(tuple, rows)))


def in_duck(sql, table, rows, schema, columns):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE {table} ({schema})")
    if rows:
        con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return plain(con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())


# ------------------------------------------------------------------ phrases

PHRASE = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
SMALL = {"shard_words": 200, "range_bytes": 2048, "cut_bits": 1}


def some_texts(n=120):
    r = random.Random(5)
    words = ["New", "york", "city", "the", "of", "é", "漢字", "a\x1cb", "x" * 50]
    marks = [" ", "  ", "\t", ", ", ".", "\n", "! ", "\r"]
    return ["".join(r.choice(words) + r.choice(marks) for _ in range(r.randrange(0, 60))) for _ in range(n)]


def test_phrases_equal_sql_at_any_cut(spark):
    rows = [(i, t, [None, "en", "fr"][i % 3]) for i, t in enumerate(some_texts(900))] + [(None, None, "en"), (7, "", None)]
    rows += [(1000, "in the city of new york we met", "en")] * 40
    want = in_duck(transducers.SQL, "documents", rows, "doc_id BIGINT, text VARCHAR, lang VARCHAR", PHRASE)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, phrase int")
    assert len(want) > 20
    for cut in ({}, SMALL):
        assert plain(transducers.phrases(df, **cut).select(*PHRASE).collect()) == want


def test_phrases_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert transducers.phrases(empty).collect() == []


def test_one_frequent_phrase_is_exact(spark):
    df = spark.createDataFrame([("a b " * 5000, "en")], "text string, lang string")
    got = {r.phrase: (r.a, r.l, r.r, r.n) for r in transducers.phrases(df).collect()}
    assert got == {"a b a b": (4999, 4999, 5000, 10000)} or all(v[3] == 10000 for v in got.values())
    want = in_duck(transducers.SQL, "documents", [("a b " * 5000, "en")], "text VARCHAR, lang VARCHAR", PHRASE)
    assert plain(transducers.phrases(df).select(*PHRASE).collect()) == want


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_transducer_keeps_sequences_and_weights(depth):
    rng = np.random.default_rng(depth)
    rows = rng.integers(1, 6, (400, depth))
    rows[:, -1] *= rng.integers(0, 2, 400)
    rows, weights = transducers.merged(rows, rng.integers(1, 9, 400) * (1 << 33))
    words = [b"w%d" % i for i in range(6)]
    t = transducers.Transducer.load(transducers.Transducer.build(words, rows, weights).dump())
    number = {w: i + 1 for i, w in enumerate(t.words)}
    asked = np.array([[number.get(words[i - 1], 99) if i else 0 for i in r] for r in rows.tolist()])
    assert t.weigh(asked).tolist() == weights.tolist()
    missing = np.full((1, depth), len(t.words) + 1)
    assert t.weigh(missing).tolist() == [0]
    back, w = t.expand()
    assert sorted(zip(map(tuple, back.tolist()), w.tolist())) == sorted(zip(map(tuple, asked.tolist()), weights.tolist()))
    assert sum(len(level[0]) for level in t.levels) <= rows.size


def test_equal_right_languages_share_states():
    rows = np.array([[a, b, c, 1] for a in range(1, 9) for b in range(1, 9) for c in range(1, 9)])
    t = transducers.Transducer.build([b"%d" % i for i in range(9)], rows, np.full(len(rows), 3))
    assert [len(level[0]) for level in t.levels] == [8, 8, 8, 1]


# ------------------------------------------------------------------ packing

def check_pieces(rows, texts, tokenizer=TOKENIZER):
    """Round trip of all ids and the shape of all sequences."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids, at = tok.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == packing.WINDOW or at < packing.WINDOW and at & (at - 1) == 0


def test_every_id_lies_in_one_piece(spark):
    texts = dict(enumerate(some_texts(80)))
    texts |= {100: None, 101: "", 102: "long words " * 9000, 103: " ", 104: "x<|endoftext|>y", 105: "\x00퟿ 漢字 🙂" * 30}
    texts |= {200 + i: "one and the same text of a large group" for i in range(500)}
    df = spark.createDataFrame([(k, v, "a", 1) for k, v in texts.items()], "doc_id long, text string, tail string, row int")
    check_pieces(packing.pack(df, TOKENIZER).collect(), texts)


def test_packing_of_rows_without_id_and_of_an_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "d")], "doc_id long, text string")
    got = packing.pack(df, TOKENIZER).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == {None: 2, 3: 1}
    assert packing.pack(df.limit(0), TOKENIZER).collect() == []


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    r, letters = random.Random(1), "ab '’s\n\t .,!é漢字 \x1c\xa0ʼ​àß🙂12ⅷ\x00"
    for _ in range(3000):
        t = "".join(r.choice(letters) for _ in range(r.randrange(60)))
        assert enc.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_neighbours_follow_bm25():
    """Scores by the formula; a window holds its seed, then the best unused."""
    rng = np.random.default_rng(3)
    tails = [rng.integers(0, 40, rng.integers(1, 30)).astype("<u2") for _ in range(25)]
    df = np.zeros(packing.VOCABULARY)
    for t in tails:
        df[np.unique(t)] += 1
    idf, mean = packing.idf_of(len(tails), df), float(np.mean([len(t) for t in tails]))

    def bm25(terms, t):
        n = Counter(t.tolist())
        return sum(idf[x] * n[x] * (packing.K1 + 1) / (n[x] + packing.K1 * (1 - packing.B + packing.B * len(t) / mean)) for x in terms)

    index, terms = packing.Block(tails, idf, mean), packing.query_terms(tails[0], idf)
    want = [bm25(terms.tolist(), t) for t in tails]
    assert np.allclose(index.scores(terms), want)
    p = packing.Packer(idf, mean, 0, window=64)
    p.block([(i, 0, t, len(t)) for i, t in enumerate(tails)])
    first = [r for r in p.taken().itertuples() if r.sequence_id == 0]
    order = [0, *[i for i in np.argsort(-np.array(want), kind="stable") if i]]
    assert [r.doc_id for r in first] == order[:len(first)] and sum(r.length for r in first) == 64


# --------------------------------------------------------------------- trie

def trie_by_hand(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members) - 1) * (len(k[-1][1].encode()) if k else 0)
    return plain(
        (m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k],
         hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(k)).encode()).hexdigest()) for k, m in nodes.items())


TURNS = "conv_id long, turn long, role string, text string"


def some_turns():
    r, rows = random.Random(11), []
    for c in range(60):
        for t in range(r.randrange(0, 14)):
            rows.append((c, None if r.random() < 0.05 else t, r.choice(["user", "assistant", None]), r.choice(["a", "é", None, "", "b c"])))
    rows += [(100 + 5 * i, t, "user", "hot") for i in range(40) for t in range(12)]  # a group of copies
    rows += [(400 + 5 * i, t, "user", "hot" if t < 30 else str(i)) for i in range(12) for t in range(40)]  # a long shared prefix
    rows += [(1000, t, "user", f"long {t % 7}") for t in range(700)]  # one long conversation
    rows += [(None, 1, "user", "x"), (7, 3, "user", "again"), (7, 3, "user", "again"), (7, 3, "user", "tie")]
    return rows


@pytest.mark.parametrize("limit", [1, 60, 10_000])
def test_trie_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(burst_trie, "CHUNK", 16)
    monkeypatch.setattr(burst_trie, "IDS_IN_STRING", 3)
    rows = some_turns()
    df = spark.createDataFrame([(*x, 1) for x in rows], TURNS + ", pos int")
    got = plain(burst_trie.trie_nodes(df, limit).select(*burst_trie.NODE).collect())
    assert got == trie_by_hand(rows)


def test_trie_sql_equals_brute_force():
    rows = some_turns()
    want = trie_by_hand(rows)
    assert in_duck(burst_trie.SQL, "conversations", rows, "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", burst_trie.NODE) == want


def test_trie_of_nothing(spark):
    assert burst_trie.trie_nodes(spark.createDataFrame([], TURNS)).collect() == []
    only = [(10, 1, "user", "x")]
    got = plain(burst_trie.trie_nodes(spark.createDataFrame(only, TURNS)).select(*burst_trie.NODE).collect())
    assert got == trie_by_hand(only)
