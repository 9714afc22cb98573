"""Phrases by weighted acyclic automata.

Three passes count one word, two, and three to four. Each reads the texts in
shards of a bounded number of words; a shard's n-grams are sorted and
counted, and a count transducer is built from them: states of equal right
language are registered once, from the last word to the first, and weights
sit on the last arcs. It is cut by prefix range: a range holds the n-grams
whose first words (three at most) hash into it, and an n-gram's range follows
from itself alone, so no word, pair or triple, however frequent, can fill a
range: each shard has counted it once. A shard is cut into 256 ranges at
most; where the input needs more, unions of 256 shards are cut again, level
by level, until a range holds a bounded part of the input.

The transducers of a range are united and their weights summed; the count of
three words is the sum over their prefix range. N-grams that are frequent
stay, as one transducer per range. A longer n-gram can only be frequent if
all its parts are, so the next pass leaves out what a bitmap of their hashes
rules out. Its size is fixed; a fuller one only lets more n-grams through,
and all counts are exact.

The parts of candidates are looked up by composing their list with the
transducers: a walk over the arcs, all parts of a range side by side.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from zstandard import ZstdCompressor, ZstdDecompressor
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, discard, stored, written

MIN_COUNT = 30
TOP = 2000
LONGEST = 4
SHARE = 80  # per cent of a phrase's count that make a longer one absorb it
# Words that a shard holds, and bytes of text that a range stands for.
SHARD_WORDS = 1_500_000
RANGE_BYTES = 16 << 20
# Bits of the map of frequent n-grams, in pages that are shipped where any is set.
MAP_BITS, PAGE_BITS = 27, 19
# Ranges that one cut makes at most, as a power of two; so many shards unite before the next.
CUT_BITS = 8

# Lower case for A-Z, one full stop for all that parts pieces, blank for tab.
_BYTES = bytes(ord(".") if c in b".,;:!?\n\x0b\x0c\r" else ord(" ") if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
STOP = b"."


class Words(dict):
    """Word -> number, in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({STOP: 0})

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def words_of(texts: list[str]) -> list[bytes]:
    """Words of all texts, with STOP after every piece."""
    return STOP.join(t.encode("utf-8", "surrogatepass") for t in [*texts, ""]).translate(_BYTES).replace(STOP, b" . ").split()


def _packed(rows: np.ndarray, bits: int) -> np.ndarray:
    key = rows[:, 0].astype(np.int64)
    for j in range(1, rows.shape[1]):
        key <<= bits
        key |= rows[:, j]
    return key


def merged(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, in order, with summed weights (1 each if none)."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    bits, k = int(rows.max()).bit_length() or 1, rows.shape[1]
    if bits * k <= 63:
        keys = [_packed(rows, bits)]
        order = np.argsort(keys[0], kind="stable")
    else:
        keys = [_packed(rows[:, :k // 2], bits), _packed(rows[:, k // 2:], bits)]
        order = np.lexsort(keys[::-1])
    first = np.zeros(len(rows), bool)
    first[0] = True
    for key in keys:
        key = key[order]
        first[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(first)
    sums = np.diff(np.append(at, len(rows))) if weights is None else np.add.reduceat(weights[order], at)
    return rows[order[at]], sums


def prefix_sums(rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``k`` words of the sorted rows that have as many, each with the
    weight of its prefix range."""
    has = rows[:, k - 1] > 0
    rows, weights = rows[has, :k], weights[has]
    if not len(rows):
        return rows, weights
    at = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[at], np.add.reduceat(weights, at)


def _mix(x: np.ndarray, y) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (np.asarray(y).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


class Transducer:
    """Minimal acyclic automaton of word sequences of up to ``depth`` words,
    with integer weights on its last arcs; 0 fills a shorter sequence up.

    Level j has its arcs in order of (state, label): ``label``, ``to`` (a
    state of the next level; on the last level the weight) and where each
    state's arcs start."""

    def __init__(self, words: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.words, self.levels = words, levels

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Transducer:
        """From sorted distinct rows. The words used are renumbered."""
        used = np.unique(rows)
        used = used[used > 0]
        number = np.zeros((int(used.max()) if len(used) else 0) + 1, np.int64)
        number[used] = np.arange(1, len(used) + 1)
        rows = number[rows]
        depth = rows.shape[1]
        levels: list = [None] * depth
        to = weights.astype(np.int64)
        for j in range(depth - 1, -1, -1):
            # rows: distinct prefixes of j + 1 words; their parents are the states to register.
            label = rows[:, j].astype(np.int64)
            first = np.append(True, (rows[1:, :j] != rows[:-1, :j]).any(axis=1)) if len(rows) else np.zeros(0, bool)
            start = np.flatnonzero(first)
            state, levels[j] = _register(label, to, start)
            rows, to = rows[start], state
        return cls([words[i - 1] for i in used.tolist()], levels)

    def expand(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences in order, as numbers of ``words`` (from 1), and their weights."""
        state = np.zeros(1 if len(self.levels[0][0]) else 0, np.int64)
        cols: list[np.ndarray] = []
        for label, to, start in self.levels:
            stop = np.append(start[1:], len(label))
            n = stop[state] - start[state]
            arc = np.repeat(start[state] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            cols = [np.repeat(c, n) for c in cols] + [label[arc]]
            state = to[arc]
        return np.stack(cols, axis=1), state

    def weigh(self, rows: np.ndarray) -> np.ndarray:
        """Weight of every row (numbers of ``words``): the composition of
        their list with this transducer. 0 where it has no such sequence."""
        state, alive = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.levels[0][0]) > 0)
        for j, (label, to, start) in enumerate(self.levels):
            owner = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(label))))
            span = len(self.words) + 2
            arcs, want = owner * span + label, state * span + rows[:, j]
            at = np.minimum(np.searchsorted(arcs, want), max(len(arcs) - 1, 0))
            alive &= arcs[at] == want if len(arcs) else False
            state = np.where(alive, to[at] if len(to) else 0, 0)
        return state

    def dump(self) -> bytes:
        parts = [b" ".join(self.words)]
        for label, to, start in self.levels:
            parts += [label.astype("<u4").tobytes(), to.astype("<i8" if len(to) and to.max() >> 31 else "<u4").tobytes(), start.astype("<u4").tobytes()]
        head = np.array([len(self.levels), *[len(p) for p in parts], *[len(x[0]) for x in self.levels]], "<i8").tobytes()
        return ZstdCompressor(level=1).compress(head + b"".join(parts))

    @classmethod
    def load(cls, raw: bytes) -> Transducer:
        raw = ZstdDecompressor().decompress(raw)
        depth = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes = np.frombuffer(raw, "<i8", 1 + 4 * depth, 8).tolist()
        at, parts = 8 * (2 + 4 * depth), []
        for n in sizes[:1 + 3 * depth]:
            parts.append(raw[at:at + n])
            at += n
        levels = []
        for j, arcs in enumerate(sizes[1 + 3 * depth:]):
            a, b, c = parts[1 + 3 * j:4 + 3 * j]
            levels.append((np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(b, "<i8" if len(b) == 8 * arcs and arcs else "<u4").astype(np.int64),
                           np.frombuffer(c, "<u4").astype(np.int64)))
        return cls(parts[0].split(b" ") if parts[0] else [], levels)


def _register(label, to, start):
    """States with equal arcs become one: (number of each state, level)."""
    if not len(start):
        return np.zeros(0, np.int64), (label, to, start)
    size = np.diff(np.append(start, len(label)))
    with np.errstate(over="ignore"):
        sign = np.add.reduceat(_mix(_mix(np.full(len(label), 7, np.uint64), label), to), start) + size.astype(np.uint64)
    _, rep, inv = np.unique(sign, return_index=True, return_inverse=True)
    rep = rep[inv]  # the first state of the same signature
    # A state whose arcs differ from that one's, though its signature doesn't, stays by itself.
    same = size == size[rep]
    arc = np.repeat(start[rep] - start, size) + np.arange(len(label))
    ok = same.copy()
    inside = np.repeat(same, size)
    differs = np.zeros(len(label), bool)
    differs[inside] = (label[inside] != label[arc[inside]]) | (to[inside] != to[arc[inside]])
    ok &= np.add.reduceat(differs.astype(np.int64), start) == 0
    rep = np.where(ok, rep, np.arange(len(start)))
    kept = np.unique(rep)
    keep_arc = np.repeat(np.isin(np.arange(len(start)), kept), size)
    number = np.searchsorted(kept, rep)
    new_start = np.append(0, np.cumsum(size[kept])[:-1])
    return number, (label[keep_arc], to[keep_arc], new_start)


def ranges_of(hashes: np.ndarray, rows: np.ndarray, bits: int) -> np.ndarray:
    """Prefix range of each n-gram: the leading bits of a hash of its first
    words, three at most."""
    out = np.full(len(rows), 3, np.uint64)
    for j in range(min(3, rows.shape[1])):
        out = _mix(out, hashes[rows[:, j]])
    return (out >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(rows), np.int64)


def hash_words(words: list[bytes]) -> np.ndarray:
    """Hash per word number; 0 for none."""
    return np.array([0] + [zlib.crc32(w) + 1 for w in words], np.uint64)


def cut(words: list[bytes], rows: np.ndarray, weights: np.ndarray, bits: int):
    """(range, transducer) of sorted rows."""
    r = ranges_of(hash_words(words), rows, bits)
    order = np.argsort(r, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(r[order])) + 1):
        if len(part):
            yield int(r[part[0]]), Transducer.build(words, rows[part], weights[part])


def union(blobs) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words in order, sorted distinct rows and summed weights of all."""
    got = [Transducer.load(b) for b in blobs]
    words = sorted({w for t in got for w in t.words})
    number = {w: i + 1 for i, w in enumerate(words)}
    rows, weights = [], []
    for t in got:
        r, w = t.expand()
        rows.append(np.array([0] + [number[x] for x in t.words], np.int64)[r])
        weights.append(w)
    return words, *merged(np.concatenate(rows), np.concatenate(weights))


class Shard:
    """Words of one language since the last flush."""

    def __init__(self, lang: str):
        self.lang, self.known, self.ids = lang, Words(), []

    def add(self, texts: list[str]) -> int:
        ws = words_of(texts)
        self.ids.append(np.fromiter(map(self.known.__getitem__, ws), np.int32, len(ws)))
        return len(ws)

    def table(self, depth: int, allowed: FrequentMap | None) -> tuple[int, list[bytes], np.ndarray, np.ndarray]:
        """(words counted, vocabulary in order, sorted rows, counts): words,
        pairs, or three words and a fourth (0: none), as far as the map
        allows them."""
        by_number = [None] * len(self.known)
        for w, i in self.known.items():
            by_number[i] = w
        order = sorted(range(1, len(by_number)), key=by_number.__getitem__)
        words = [by_number[i] for i in order]
        rank = np.zeros(len(by_number), np.int32)
        rank[order] = np.arange(1, len(order) + 1)
        ids = rank[np.concatenate(self.ids)]
        n = int(np.count_nonzero(ids))
        if depth == 1:
            return n, words, *merged(ids[ids > 0][:, None])
        hashes = hash_words(words)
        if depth == 2:
            ok = (ids > 0) & allowed.has(self.lang, hashes[ids][:, None])
            at = np.flatnonzero(ok[:-1] & ok[1:])
            return n, words, *merged(np.stack([ids[at], ids[at + 1]], axis=1))
        pair = np.zeros(len(ids) + 2, bool)  # does an allowed pair begin here
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        pair[at] = allowed.has(self.lang, np.stack([hashes[ids[at]], hashes[ids[at + 1]]], axis=1))
        at = np.flatnonzero(pair[:-1] & pair[1:])
        fourth = np.where(pair[at + 2], ids[np.minimum(at + 3, len(ids) - 1)], 0)
        return n, words, *merged(np.stack([ids[at], ids[at + 1], ids[at + 2], fourth], axis=1))


class FrequentMap:
    """Bitmap of hashes of frequent n-grams; says yes to every one of them."""

    def __init__(self, pages: dict[int, bytes]):
        self.bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
        size = 1 << (PAGE_BITS - 3)
        for page, raw in pages.items():
            self.bits[page * size:(page + 1) * size] = np.frombuffer(raw, np.uint8)

    @staticmethod
    def places(lang: str, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), zlib.crc32(lang.encode("utf-8", "surrogatepass")), np.uint64)
        for j in range(hashes.shape[1]):
            out = _mix(out, hashes[:, j])
        return (out >> np.uint64(64 - MAP_BITS)).astype(np.int64)

    def has(self, lang: str, hashes: np.ndarray) -> np.ndarray:
        at = self.places(lang, hashes)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _pages(batches):
    """Pages of the map that the transducers of a task set bits in."""
    bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for pdf in batches:
        for lang, raw in zip(pdf["lang"], pdf["blob"]):
            t = Transducer.load(raw)
            at = FrequentMap.places(lang, hash_words(t.words)[t.expand()[0]])
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    pages = bits.reshape(-1, 1 << (PAGE_BITS - 3))
    for p in np.flatnonzero(pages.any(axis=1)):
        yield pd.DataFrame([(int(p), pages[p].tobytes())], columns=["page", "bits"])


def _joined(key, pdf):
    out = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bits"]])
    return pd.DataFrame([(key[0], out.tobytes())], columns=["page", "bits"])


CUT = "lang string, depth int, part bigint, shard bigint, n bigint, blob binary"
CUT_COLUMNS = ["lang", "depth", "part", "shard", "n", "blob"]


def sharder(depth: int, bits: int, shard_words: int, pages):
    """Texts -> transducers of their shards, cut into ranges, and the number
    of words of each language (depth 0)."""

    def run(batches):
        shards, held, number = {}, 0, TaskContext.get().partitionId() << 24
        allowed = None if pages is None else FrequentMap(pages.value)

        def flush():
            for lang, s in shards.items():
                n, words, rows, weights = s.table(depth, allowed)
                out = [(lang, 0, 0, number, n, None)]
                out += [(lang, depth, part, number, 0, t.dump()) for part, t in cut(words, rows, weights, bits)]
                yield pd.DataFrame(out, columns=CUT_COLUMNS)

        for pdf in batches:
            for lang, texts in pdf.groupby("lang", sort=True)["text"]:
                some, size = [], 0
                for t in [*texts.tolist(), None]:  # one very long text is a shard by itself
                    if t is not None:
                        some.append(t)
                        size += len(t)
                    if some and (t is None or size >= 4 << 20):
                        held += shards.setdefault(lang, Shard(lang)).add(some)
                        some, size = [], 0
                    if held >= shard_words:
                        yield from flush()
                        shards, held, number = {}, 0, number + 1
        yield from flush()

    return run


def recut(bits: int):
    """Transducers of one range and group of shards -> their union, cut finer."""

    def run(key, pdf):
        lang, depth, _, group = key
        words, rows, weights = union(pdf["blob"])
        return pd.DataFrame([(lang, depth, part, group, 0, t.dump()) for part, t in cut(words, rows, weights, bits)], columns=CUT_COLUMNS)

    return run


def frequent(min_count: int):
    """Transducers of one range -> one of its n-grams from ``min_count`` on."""

    def run(key, pdf):
        lang, depth, part = key
        words, rows, weights = union(pdf["blob"])
        if depth > 2:
            three, n3 = prefix_sums(rows, weights, 3)
            four = rows[:, 3] > 0
            rows = np.concatenate([np.pad(three, ((0, 0), (0, 1))), rows[four]])
            rows, weights = merged(rows, np.concatenate([n3, weights[four]]))
        often = weights >= min_count
        t = Transducer.build(words, rows[often], weights[often])
        return pd.DataFrame([(lang, depth, part, 0, int(often.sum()), t.dump())], columns=CUT_COLUMNS)

    return run


def read_grams(batches):
    """n-grams and counts that the transducers hold."""
    for pdf in batches:
        for lang, raw in zip(pdf["lang"], pdf["blob"]):
            t = Transducer.load(raw)
            if not t.words:
                continue
            rows, weights = t.expand()
            words = [""] + [w.decode("utf-8", "replace") for w in t.words]
            yield pd.DataFrame({"lang": lang, "phrase": [" ".join(words[i] for i in r if i) for r in rows.tolist()],
                                "size": (rows > 0).sum(axis=1), "f": weights})


def place_parts(bits: int):
    """Adds the depth of table and the range where an n-gram is found."""

    def run(batches):
        for pdf in batches:
            split = [p.encode("utf-8").split(b" ") for p in pdf["words"]]
            hashes = np.zeros((len(split), 3), np.uint64)
            for i, ws in enumerate(split):
                hashes[i, :len(ws[:3])] = [zlib.crc32(w) + 1 for w in ws[:3]]
            depth = np.array([len(ws) if len(ws) < 3 else 4 for ws in split], np.int32)
            out = np.full(len(split), 3, np.uint64)
            for j in range(3):
                out = np.where(j >= depth, out, _mix(out, hashes[:, j]))
            part = (out >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(split), np.int64)
            yield pdf.assign(depth=depth, part=part)

    return run


def compose(parts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
    """Counts of the parts of one range."""
    f = np.zeros(len(parts), np.int64)
    if len(parts) and len(table):
        t = Transducer.load(table["blob"].iloc[0])
        number = {w: i + 1 for i, w in enumerate(t.words)}
        rows = np.zeros((len(parts), len(t.levels)), np.int64)
        for i, p in enumerate(parts["words"]):
            ws = [number.get(w, len(number) + 1) for w in p.encode("utf-8").split(b" ")]
            rows[i, :len(ws)] = ws
        f = t.weigh(rows)
    return pd.DataFrame({"lang": parts["lang"], "words": parts["words"], "f": f})


def counts(docs: DataFrame, depth: int, pages, total: int, min_count: int, shard_words: int, cut_bits: int) -> tuple[DataFrame, DataFrame | None]:
    """(frequent transducers by range of ``total`` bits, words per language).
    Transducers go straight into their shuffle; only the first pass, the
    smallest, is written, as the words are counted in it too."""
    bits, n = min(cut_bits, total), None
    t0 = t = docs.mapInPandas(sharder(depth, bits, shard_words, pages), CUT)
    if depth == 1:
        t0 = t = written(t, "transducers")
        n = stored(t.where("depth = 0").groupBy("lang").agg(F.sum("n").alias("n")))
    t = t.where("depth > 0")
    while bits < total:  # unions of shards, cut finer
        bits = min(bits + cut_bits, total)
        t = t.groupBy("lang", "depth", "part", F.shiftright("shard", cut_bits).alias("shard")).applyInPandas(recut(bits), CUT)
    found = written(t.groupBy("lang", "depth", "part").applyInPandas(frequent(min_count), CUT).where("n > 0"), "transducers")
    if depth == 1:
        discard(t0)
    return found, n


def frequent_map(found: DataFrame):
    """Broadcast pages of the map, of a fixed size in all."""
    pages = found.select("lang", "blob").mapInPandas(_pages, "page int, bits binary").groupBy("page").applyInPandas(_joined, "page int, bits binary")
    return found.sparkSession.sparkContext.broadcast({r["page"]: bytes(r["bits"]) for r in pages.toLocalIterator()})


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP,
            shard_words: int = SHARD_WORDS, range_bytes: int = RANGE_BYTES, cut_bits: int = CUT_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top``
    phrases of two to four words, of those that occur ``min_count`` times.

    A null language is ``und``, a null text empty; pieces without a word,
    and words of any length, count as they come. Equal rows count as often
    as they are there. Other columns are ignored, whatever their names. Ties
    go by count, then by the phrase's UTF-8 bytes. An empty table gives no
    row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, pages, n, tables = max(0, (size // range_bytes).bit_length()), None, None, []
    for depth in (1, 2, LONGEST):
        found, some = counts(rows, depth, pages, bits, min_count, shard_words, cut_bits)
        n = n if some is None else some
        tables.append(found)
        pages = frequent_map(found) if depth < LONGEST else None
    found = tables[0].unionByName(tables[1]).unionByName(tables[2])
    cand = stored(found.select("lang", "blob").mapInPandas(read_grams, "lang string, phrase string, size int, f bigint").where("size > 1"))

    # Every cut of a candidate into two parts, whose counts come from the composition.
    ws = cand.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = ws.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    parts = cuts.select("lang", F.explode(F.array("left", "right")).alias("words")).distinct()
    placed = parts.mapInPandas(place_parts(bits), "lang string, words string, depth int, part bigint")
    by = ["lang", "depth", "part"]
    looked = stored(placed.groupBy(*by).cogroup(found.select(*by, "blob").groupBy(*by)).applyInPandas(compose, "lang string, words string, f bigint"))
    left = looked.select("lang", F.col("words").alias("left"), F.col("f").alias("l"))
    right = looked.select("lang", F.col("words").alias("right"), F.col("f").alias("r"))
    # 2000000 * a may pass 64 bits.
    score = F.expr("(2000000BD * CAST(a AS DECIMAL(20, 0))) DIV CAST(l + r AS DECIMAL(20, 0))")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))

    # Parts of longer candidates that take most of their occurrences.
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    longer = ws.where(F.size("w") > 2).select("lang", F.col("a").alias("most"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < SHARE * F.col("a")))
    out = kept.join(n, "lang").select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
cuts AS (SELECT c.lang, c.phrase, c.a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:m], ' ') AS rp
         FROM cand c, (VALUES (1), (2), (3)) AS ks(k) WHERE k < m),
scored AS (SELECT cuts.*, a1.f AS l, a2.f AS r, (2000000::HUGEINT * a) // (a1.f + a2.f) AS score
           FROM cuts JOIN f a1 ON a1.lang = cuts.lang AND a1.phrase = lp JOIN f a2 ON a2.lang = cuts.lang AND a2.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (SELECT c.lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(a) AS most
        FROM cand c, (VALUES (2), (3)) AS ss(s), (VALUES (1), (2), (3)) AS st(i) WHERE s < m AND i + s - 1 <= m GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN sub USING (lang, phrase) WHERE sub.most IS NULL OR 100 * sub.most < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
