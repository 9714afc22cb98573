"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of
labelled text. A text is parsed against each automaton into phrases: the
longest match with any part of the language's sample, then the next
character starts a new phrase. Few phrases mean that the text is made of
long pieces of that language; phrases times log2 of the sample's length
(the cost of pointing at a piece) per character is the cross-parsing
entropy, and the least entropy wins, ties by name.

Texts of any length are parsed in windows of ``WINDOW`` characters, each a
parse of its own, so that all windows of a batch run side by side: an
automaton is a dense table, one step of all windows is one gather from
it, and a failed match holds the number of phrases it ends and the state
after the restart. Documents never leave their partition.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import unwrapped, wrapped

WINDOW = 256
# The sample: at most so many pieces of so many characters per language,
# from distinct texts, and at most so many languages (the most frequent).
PIECES = 64
PIECE_CHARS = 512
MAX_LANGS = 256
# Letters of a language's sample with a code of their own; the sample's
# other letters share ``SHARED`` codes, and all letters that it doesn't hold
# have one that matches nothing.
LETTERS = 80
SHARED = 8
# Characters worked on at once.
CHUNK = 2_000_000
UNKNOWN = "und"
PAD, GAP = 0, 1
UNSEEN = 2 + LETTERS + SHARED
# Past the last code point: the place of a window's padding.
BLANK = 0x110000
BREAKS = 30


@functools.lru_cache(maxsize=1)
def letter_flags() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_table(texts: list[str]) -> np.ndarray:
    """Code of every code point in one language: its sample's most frequent
    letters, the sample's other letters by remainder, letters that it doesn't
    hold, anything else a gap; last the padding."""
    seen = Counter(ch for t in texts for ch in t if ch.isalpha())
    codes = np.append(np.where(letter_flags(), UNSEEN, GAP), PAD).astype(np.uint8)
    for i, (ch, _) in enumerate(sorted(seen.items(), key=lambda kv: (-kv[1], kv[0]))):
        codes[ord(ch)] = 2 + i if i < LETTERS else 2 + LETTERS + ord(ch) % SHARED
    return codes


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def automaton(codes: list[int], alphabet: int) -> np.ndarray:
    """Suffix automaton of a code sequence as a flat table: entry
    ``state + code`` (states are multiples of ``alphabet``) is the next
    state, with the number of phrases that end there in the top bits."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    # Without a match the phrase ends; one that is unseen as a first
    # character too is a phrase by itself.
    restart = np.full(alphabet, 2 << BREAKS, np.uint32)
    for c, q in step[0].items():
        restart[c] = q * alphabet + (1 << BREAKS)
    table = np.tile(restart, (len(step), 1))
    table[0] = np.where(restart >> BREAKS == 2, np.uint32(1 << BREAKS), restart & np.uint32((1 << BREAKS) - 1))
    for s, moves in enumerate(step):
        for c, q in moves.items():
            table[s, c] = q * alphabet
    table[:, PAD] = np.arange(len(step), dtype=np.uint32) * alphabet
    return table.ravel()


class Languages:
    """Automata of all languages of a sample."""

    def __init__(self, sample: tuple[tuple[str, tuple[str, ...]], ...]):
        self.names = [name for name, _ in sample]
        self.codes, self.tables, self.cost = [], [], []
        for _, texts in sample:
            codes = code_table([t.lower() for t in texts])
            seq = [int(c) for t in texts for c in (*codes[points(t)], GAP)]
            self.codes.append(codes)
            self.tables.append(automaton(seq, UNSEEN + 1))
            self.cost.append(math.log2(len(seq) + 2))

    def phrases(self, lanes: np.ndarray) -> np.ndarray:
        """Phrases of each window (row) by language (column); ``lanes`` has
        one column of code points per window."""
        out = np.empty((lanes.shape[1], len(self.tables)), np.int64)
        mask = np.uint32((1 << BREAKS) - 1)
        for k, (codes, table) in enumerate(zip(self.codes, self.tables)):
            state = np.zeros(lanes.shape[1], np.uint32)
            count = np.zeros(lanes.shape[1], np.uint32)
            for row in lanes:
                state = table.take(state + codes.take(row))
                count += state >> np.uint32(BREAKS)
                state &= mask
            out[:, k] = count + (state != 0)  # the phrase that the window's end cuts
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text. The score sets the two least
        entropies against each other: 0.5 when equal, toward 1 the clearer."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at, found, room = [], [], CHUNK

        def flush():
            starts = np.cumsum([0] + [-(-len(p) // WINDOW) for p in found])
            lanes = np.full((starts[-1], WINDOW), BLANK, np.uint32)
            for p, s, e in zip(found, starts, starts[1:], strict=False):
                lanes[s:e].reshape(-1)[: len(p)] = p
            total = np.add.reduceat(self.phrases(np.ascontiguousarray(lanes.T)), starts[:-1], axis=0)
            bits = total * self.cost
            for i, row in zip(at, bits, strict=True):
                best = min(range(len(row)), key=lambda k: (row[k], self.names[k]))
                rest = [x for k, x in enumerate(row) if k != best]
                names[i] = self.names[best]
                scores[i] = float(min(rest) / (min(rest) + row[best])) if rest else 1.0

        if not self.names:
            return names, scores
        for i, t in enumerate(texts):
            if not t:
                continue
            p = points(t)
            if not letter_flags()[p].any():
                continue
            at.append(i)
            found.append(p)
            room -= len(p)
            if room <= 0:
                flush()
                at, found, room = [], [], CHUNK
        if at:
            flush()
        return names, scores


@functools.lru_cache(maxsize=2)
def languages(sample) -> Languages:
    """Built once per worker process and sample."""
    return Languages(sample)


def least_hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, h) -> the ``PIECES`` least distinct hashes of each language in
    this partition."""
    least: dict[str, np.ndarray] = {}
    for f in frames:
        for lang, h in f.groupby("lang")["h"]:
            least[lang] = np.union1d(least.get(lang, np.empty(0, np.int64)), h.to_numpy(np.int64))[:PIECES]
    for lang, h in least.items():
        yield pd.DataFrame({"lang": lang, "h": h})


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The bounded sample, by language name: pieces at hashed places of
    the distinct texts with the least hashes, however often they occur. Rows without text
    or language are left out."""
    d = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where(
        "lang is not null and text is not null and text != ''")
    counts = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not counts:
        return ()
    known = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], True)])
    h = F.xxhash64("text")
    start = F.lit(1) + F.pmod(F.xxhash64(F.lit("start"), h), F.greatest(F.lit(1), F.length("text") - PIECE_CHARS + 1)).cast("int")
    d = d.where(known[F.col("lang")]).withColumn("h", h)
    least = d.select("lang", "h").mapInPandas(least_hashes, "lang string, h bigint").distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    least = least.withColumn("nth", nth).where(F.col("nth") <= PIECES).select(F.col("lang").alias("l"), F.col("h").alias("lh"))
    # At most MAX_LANGS * PIECES narrow rows.
    some = d.join(F.broadcast(least), (F.col("lang") == F.col("l")) & (F.col("h") == F.col("lh"))).groupBy("lang", "h").agg(
        F.min(F.substring("text", start, F.lit(PIECE_CHARS))).alias("piece"))
    pieces: dict[str, list[str]] = {}
    for r in some.orderBy("lang", "h").collect():
        pieces.setdefault(r["lang"], []).append(r["piece"])
    return tuple((k, tuple(v)) for k, v in sorted(pieces.items()))


def predictor(sample):
    """Column function: language and score of a text. ``sample`` is a
    broadcast of ``learn``'s result, at most MAX_LANGS * PIECES pieces."""

    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = languages(sample.value)
        for s in texts:
            names, scores = model.judge([None if t is None or t is pd.NA else t for t in s])
            yield pd.DataFrame({"lang": names, "score": scores})

    return predict


def identify(docs: DataFrame, training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replacing columns of those
    names), learned from ``training``. A text that is null or has no letter
    is ``und`` with score 0, as is every text if nothing was learned.
    Repeated rows get equal answers."""
    sample = docs.sparkSession.sparkContext.broadcast(learn(training, lang_col, text_col))
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    rows = wrapped(kept, found=predictor(sample)(F.col(text_col)))
    return unwrapped(rows, F.col("found.lang").alias("lang_pred"), F.round("found.score", 6).alias("score"))
