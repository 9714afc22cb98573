"""Packing of documents into fixed windows by lexical retrieval.

A document becomes the ids of its text and one end id. As many whole
windows as its ids fill are sequences by themselves; what is left, its
tail, is packed with other tails. Tails are ordered by their two heaviest
terms (ids weighted by frequency and by their number) and dealt to tasks
by ranges of that order, so that lexically close tails meet, copies
included, and no key can fill a task: the last part of the order is a
number of the row. Each task reads its tails in blocks of bounded size and
keeps a BM25 inverted index of one block, a shard of the whole index. The
next unused tail seeds a window; the index returns its unused neighbours,
best first, which fill the window greedily. The one that doesn't fit is
cut, and its rest seeds the next window. A window that a block leaves open
goes on in the next block. The last open window of a task is cut into
sequences whose lengths are powers of two, which need no padding.

The text is tokenized once. Full windows leave only their checksums, tails
two bytes an id, stored in the shared folder; tails are shuffled once.
Document frequencies are counted over all documents: at most one number
per id of the vocabulary reaches the driver.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, written

WINDOW = 2048
END = 1
K1, B = 1.2, 0.75
# Terms of a seed that are looked up.
QUERY_TERMS = 16
# A block of the index holds no more than this.
BLOCK_DOCS, BLOCK_IDS = 1024, 1 << 20
# Ids are kept in two bytes.
VOCABULARY = 1 << 16

LOG = np.log1p(np.arange(VOCABULARY))

CODED = "doc_id bigint, row bigint, doc_tokens bigint, crcs array<bigint>, tail binary, ka int, kb int, df binary"
CODED_COLUMNS = ["doc_id", "row", "doc_tokens", "crcs", "tail", "ka", "kb", "df"]
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"

# Fixed value: the split of a byte-level tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def parts_of(text: str) -> list[str]:
    if "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " " or RARE_SPACE.search(text):
        return GAP.split(text)
    return text.split(" ")


def byte_ranks(path: str) -> tuple[dict[bytes, int], list[str], str]:
    """(bytes -> id, special tokens, split pattern) of a byte-level tokenizer
    file. Its vocabulary writes a byte as a printable character: itself, or
    for the others, in order, those from 256 on."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"], spec["model"]
    if spec["normalizer"] or spec["post_processor"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model["type"] != "BPE":
        raise ValueError("not a plain byte-level tokenizer")
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = [t["content"] for t in spec["added_tokens"]]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    if max(ranks.values()) >= VOCABULARY:
        raise ValueError("ids of this vocabulary don't fit two bytes")
    return ranks, special, SPLIT


class Encoder:
    """Ids of texts by a tokenizer file. Texts are merged by the ranks of that
    file's vocabulary, which gives the tokenizer's ids in a fifth of its time;
    a text that holds a special token's string goes to the tokenizer itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks, self.special, pattern = byte_ranks(path)
        self.whole = Tokenizer.from_file(path)
        self.bpe = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Two bytes per id, little-endian, without the end."""
        if any(s in text for s in self.special):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u2")
        return self.bpe.encode_to_numpy(text, disallowed_special=()).astype("<u2")


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per worker, for all its tasks."""
    return Encoder(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def heaviest(ids: np.ndarray) -> tuple[int, int]:
    """The two heaviest terms of a tail: its frequent ids of a high number, as
    ids are numbered by falling frequency when a vocabulary is made."""
    if not len(ids):
        return -1, -1
    terms, n = np.unique(ids, return_counts=True)
    w = n * LOG[terms]
    a = int(np.argmax(w))
    w[a] = -1
    return int(terms[a]), int(terms[np.argmax(w)])


def coder(path: str, window: int):
    """Documents -> full windows' checksums and tails; at the end of a task
    one row with its document frequencies."""

    def run(batches):
        enc, df = encoder(path), np.zeros(VOCABULARY, np.int64)
        row = TaskContext.get().partitionId() << 40
        seen, some, held = np.zeros(VOCABULARY, bool), np.zeros(VOCABULARY, np.uint8), 0
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["id"], pdf["text"]):
                ids = np.append(enc.encode(text), np.asarray([END], "<u2"))
                seen[:] = False
                seen[ids] = True
                some += seen  # summed up in bytes, as long as they hold
                held += 1
                if held == 255:
                    df += some
                    some[:], held = 0, 0
                full = len(ids) // window
                crcs = [crc(ids[i * window:(i + 1) * window]) for i in range(full)]
                tail = ids[full * window:]
                out.append((doc, row, len(ids), crcs, tail.tobytes(), *heaviest(tail), None))
                row += 1
            yield pd.DataFrame(out, columns=CODED_COLUMNS).astype({"doc_id": "Int64"})
        df += some
        yield pd.DataFrame([(pd.NA, -1, 0, [], None, -1, -1, df.tobytes())], columns=CODED_COLUMNS).astype({"doc_id": "Int64"})

    return run


def _sum_df(batches):
    df = np.zeros(VOCABULARY, np.int64)
    for pdf in batches:
        for raw in pdf["df"]:
            df += np.frombuffer(raw, np.int64)
    at = np.flatnonzero(df)
    yield pd.DataFrame({"id": at, "n": df[at]})


def idf_of(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)


class Block:
    """BM25 index of one block of tails."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean_len: float):
        self.n = len(tails)
        lens = np.array([len(t) for t in tails], np.int64)
        doc = np.repeat(np.arange(self.n, dtype=np.uint32), lens)  # a block's ids times its documents fit 32 bits
        ids = np.concatenate(tails).astype(np.uint32) if self.n else np.zeros(0, np.uint32)
        pair, tf = np.unique(ids * np.uint32(self.n) + doc, return_counts=True)  # by term, then document
        pair = pair.astype(np.int64)
        term, self.doc = pair // max(self.n, 1), pair % max(self.n, 1)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lens[self.doc] / mean_len))
        self.terms, self.start = np.unique(term, return_index=True)
        self.stop = np.append(self.start[1:], len(term))

    def scores(self, terms: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        at = np.searchsorted(self.terms, terms)
        for i, t in zip(at, terms):
            if i < len(self.terms) and self.terms[i] == t:
                s = slice(self.start[i], self.stop[i])
                out[self.doc[s]] += self.weight[s]
        return out


def query_terms(ids: np.ndarray, idf: np.ndarray, k: int = QUERY_TERMS) -> np.ndarray:
    """The heaviest terms of a seed by frequency and idf, ties to smaller ids."""
    terms, n = np.unique(ids, return_counts=True)
    return terms[np.argsort(-n * idf[terms], kind="stable")[:k]].astype(np.int64)


class Packer:
    """Windows of one task. ``rows`` gathers the pieces, each (doc_id, start,
    length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, idf, mean_len: float, first: int, window: int = WINDOW):
        self.idf, self.mean, self.window = idf, mean_len, window
        self.seq, self.open, self.fill, self.terms, self.rows = first, [], 0, None, []

    def _emit(self, pieces, sequence: int) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), crc(ids), n, sequence, offset))
            offset += len(ids)

    def _put(self, doc, start, ids, n) -> int:
        """Adds as much as fits; returns how much that was."""
        take = min(len(ids), self.window - self.fill)
        self.open.append((doc, start, ids[:take], n))
        self.fill += take
        if self.fill == self.window:
            self._emit(self.open, self.seq)
            self.seq, self.open, self.fill, self.terms = self.seq + 1, [], 0, None
        return take

    def whole(self, doc, crcs, n) -> None:
        """Full windows of one document."""
        for i, c in enumerate(crcs):
            self.rows.append((doc, i * self.window, self.window, int(c), n, self.seq, 0))
            self.seq += 1

    def block(self, tails) -> None:
        """``tails``: (doc_id, start, ids, doc_tokens), none empty."""
        index = Block([t[2] for t in tails], self.idf, self.mean)
        unused = np.ones(len(tails), bool)
        at = 0
        while True:
            if not self.open:  # a new window: its seed is the next unused tail
                while at < len(tails) and not unused[at]:
                    at += 1
                if at == len(tails):
                    return
                seed, unused[at] = tails[at], False
                self.terms = query_terms(seed[2], self.idf)
                self._put(*seed)
            while self.open:
                s = np.where(unused, index.scores(self.terms), -1.0)
                if not unused.any():
                    return
                for i in np.argsort(-s, kind="stable"):
                    if not unused[i]:
                        return
                    doc, start, ids, n = tails[i]
                    unused[i] = False
                    took = self._put(doc, start, ids, n)
                    if not self.open:
                        if took < len(ids):  # the rest of the cut one seeds the next window
                            self.terms = query_terms(ids, self.idf)
                            self._put(doc, start + took, ids[took:], n)
                        break

    def close(self) -> None:
        """Cuts the open window into powers of two."""
        todo, left = self.open, self.fill
        self.open, self.fill = [], 0
        while left:
            size, part = 1 << (left.bit_length() - 1), []
            left -= size
            while size:
                doc, start, ids, n = todo[0]
                take = min(size, len(ids))
                part.append((doc, start, ids[:take], n))
                todo = todo[1:] if take == len(ids) else [(doc, start + take, ids[take:], n), *todo[1:]]
                size -= take
            self._emit(part, self.seq)
            self.seq += 1

    def taken(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"doc_id": "Int64"})


def packer(idf: np.ndarray, mean_len: float, window: int):
    def run(batches):
        p = Packer(idf, mean_len, TaskContext.get().partitionId() << 40, window)
        tails, size = [], 0
        for pdf in batches:
            for doc, n, crcs, raw in zip(pdf["doc_id"], pdf["doc_tokens"], pdf["crcs"], pdf["tail"]):
                p.whole(doc, crcs, n)
                if len(raw):
                    tails.append((doc, len(crcs) * window, np.frombuffer(raw, "<u2"), n))
                    size += len(tails[-1][2])
                if len(tails) == BLOCK_DOCS or size >= BLOCK_IDS:
                    p.block(tails)
                    tails, size = [], 0
            yield p.taken()
        p.block(tails)
        p.close()
        yield p.taken()

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset) of all documents, packed into sequences of ``window`` ids, or of
    a smaller power of two.

    A null text counts as empty: one end id. A text of any length is cut
    wherever a window ends. Rows with the same id or the same text are packed
    each by itself; a null id stays null. Equal scores go by the order of
    tails. Other columns are ignored, whatever their names. An empty table
    gives no piece. ``tokenizer`` is a file that every executor finds at that
    path; the strings of its special tokens count as these tokens."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    coded = written(rows.mapInPandas(coder(tokenizer, window), CODED), "packing")
    n_docs, mean = coded.where("df is null").agg(F.count(F.lit(1)), F.avg(F.length("tail") / 2)).first()
    counts = coded.where("df is not null").select("df").mapInPandas(_sum_df, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    df = np.zeros(VOCABULARY)
    for r in counts.toLocalIterator():  # at most one row per id of the vocabulary
        df[r["id"]] = r["n"]
    idf = idf_of(n_docs, df)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.where("df is null").repartitionByRange(n, "ka", "kb", "row").sortWithinPartitions("ka", "kb", "row")
    return dealt.select("doc_id", "doc_tokens", "crcs", "tail").mapInPandas(packer(idf, max(mean or 0.0, 1.0), window), PIECES)
