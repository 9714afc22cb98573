"""Benchmark decontamination by pigeonhole edit matching.

A test item of length n may occur in a document with up to
k = floor(``ERROR_RATE`` * n) edits. Cut into k + 1 pieces, at least one
piece of it must then occur unchanged. All pieces of all items form one
Aho-Corasick automaton; every exact hit gives the place where the item
would lie, and the stretch around it is verified with Myers' bit-parallel
distance (free start and end within the stretch). Items and documents are
compared as lower-case words joined by single spaces.

Each document is scanned alone, by a scalar function over its text: no
shuffle, any document length. The benchmark is read in blocks of at most
``BLOCK_CHARS`` characters, one pass over the documents per block, so
what is shipped to executors is bounded whatever the benchmark's size.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import unwrapped, wrapped

ERROR_RATE = 1 / 16
# Items with fewer characters after normalisation have to stand there word by word, without an edit.
MIN_ITEM = 40
BLOCK_CHARS = 4_000_000

WORDS = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    return " ".join(WORDS.findall(text.lower())) if text else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 consecutive pieces, as (offset, piece), lengths within one."""
    n, parts = len(item), errors + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, item: str):
        self.size = len(item)
        self.masks: dict[str, int] = {}
        for i, ch in enumerate(item):
            self.masks[ch] = self.masks.get(ch, 0) | 1 << i
        self.all = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)

    def nearest(self, stretch: str) -> tuple[int, int]:
        """(least edits to any part of ``stretch``, end of the first such part)."""
        up, down, score = self.all, 0, self.size
        best, end = self.size, 0
        for j, ch in enumerate(stretch, 1):
            eq = self.masks.get(ch, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = down | ~(xh | up) & self.all
            mh = up & xh
            if ph & self.top:
                score += 1
            elif mh & self.top:
                score -= 1
            if score < best:
                best, end = score, j
            ph, mh = ph << 1 & self.all, mh << 1 & self.all
            up = mh | ~(xv | ph) & self.all
            down = ph & xv
        return best, end


class Matcher:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], rate: float):
        import ahocorasick

        self.items = items
        self.errors = [int(len(t) * rate) if len(t) >= MIN_ITEM else 0 for _, t in items]
        self.patterns: dict[int, Pattern] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.errors[at]):
                found.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int | None, int]]:
        """(item id, edits) of the items within their budget, by item id, one
        without an id last."""
        best: dict[int, int] = {}
        tried: dict[int, int] = {}
        for end, (size, uses) in self.automaton.iter(text):
            for at, offset in uses:
                k = self.errors[at]
                if best.get(at, k + 1) == 0:
                    continue
                start = end + 1 - size - offset
                # Hits of several pieces on one diagonal share a stretch.
                if tried.get(at) == start or at in best and abs(tried[at] - start) <= k:
                    continue
                tried[at] = start
                item = self.items[at][1]
                if len(item) < MIN_ITEM:
                    if f" {text[max(0, start - 1) : end + 2]} ".find(f" {item} ") >= 0:
                        best[at] = 0
                    continue
                lo, hi = max(0, start - k), max(0, start + len(item) + k)
                if start >= 0 and text.startswith(item, start):
                    best[at] = 0
                    continue
                if at not in self.patterns:
                    self.patterns[at] = Pattern(item)
                d, _ = self.patterns[at].nearest(text[lo:hi])
                if d <= k:
                    best[at] = min(d, best.get(at, d))
        return sorted(((self.items[at][0], d) for at, d in best.items()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


@functools.lru_cache(maxsize=2)
def matcher(items: tuple[tuple[int, str], ...], rate: float) -> Matcher:
    """Built once per worker process and block."""
    return Matcher(items, rate)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[tuple[int, str], ...]]:
    """Items as normalised text, in blocks of bounded size."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "text is not null").distinct().orderBy("id", "text")
    block: list[tuple[int, str]] = []
    room = block_chars
    for r in rows.toLocalIterator():
        t = normal(r["text"])
        if not t:
            continue
        if block and len(t) > room:
            yield tuple(block)
            block, room = [], block_chars
        block.append((r["id"], t))
        room -= len(t)
    if block:
        yield tuple(block)


def scanner(block, rate: float):
    """Column function: the items of a shipped block that a text holds."""

    @F.pandas_udf("array<struct<item:bigint,edits:int>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = matcher(block.value, rate)
        for s in texts:
            yield pd.Series([[{"item": i, "edits": d} for i, d in m.matches(normal(t))] for t in s], dtype=object)

    return scan


def flagged(docs: DataFrame, items: DataFrame, text_col: str = "text", out: str = "leaks", item_id: str = "item_id",
            item_text: str = "text", rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``out`` = array<struct<item long, edits int>> of the
    items found in each text, by item id.

    Null and empty texts hold no item. Items without a letter or digit are
    not looked for; those under ``MIN_ITEM`` characters count where they stand
    as whole words; those without an id are looked for like others, and
    listed with a null id. Repeated rows are
    scanned alike; repeated items count once per id. An empty benchmark
    leaves every array empty."""
    sc = docs.sparkSession.sparkContext
    found = F.array().cast("array<struct<item:bigint,edits:int>>")
    for block in item_blocks(items, item_id, item_text, block_chars):
        found = F.concat(found, scanner(sc.broadcast(block), rate)(F.col(text_col)))
    return docs.withColumn(out, F.array_sort(F.array_distinct(found)))


def leak_table(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits): every pair of a document and a test item
    that it holds within the item's budget; clean documents have no row."""
    rows = flagged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), items)
    return rows.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.item").alias("item_id"), F.col("leak.edits").alias("edits"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with the same columns."""
    return unwrapped(flagged(wrapped(docs, text=text_col), items).where(F.size("leaks") == 0))
