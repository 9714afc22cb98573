"""Exact top-k search by inner product with MaxScore.

Vectors have integer components; a query is a sum of terms, one per
component. Candidates are dealt into shards by hash, and every shard meets
every block of queries once. Within a shard the postings of a term are its
column, read in ranges of candidates, long vectors first, each range twice
the one before. The extremes of a range's postings say how much a term can
add to any score there, at least and at most. For a query and a range:

1. The terms whose spreads (most minus least), weakest first, sum up to
   less than what the least possible score lacks to the query's present
   k-th best score are non-essential: a candidate that only they lift
   can't get there. Without k scores yet, all terms are essential.
2. Essential postings are read for all candidates of the range.
3. Non-essential terms are probed, strongest first, only for candidates
   whose score so far plus the bounds of the terms not yet probed reaches
   the k-th best score.
4. The survivors are scored in full; they raise the k-th best score, by
   which the next range's terms are split anew.

A shard returns its k best per query, and the shards' answers are merged.

Shards and query blocks have fixed sizes, so a task's memory doesn't grow
with the input; the number of (shard, block) pairs grows with rows times
queries, as any exact search over all rows must. A vector moves once per
shard or block that it meets: rows times queries / 5,461 moves in all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import stored

TOP = 20
SHARD_ROWS = 8_192
BLOCK_QUERIES = 16_384
# Candidates of the first range of postings.
FIRST = 512
# Non-essential terms probed at a time.
PROBE = 8
# Queries whose essential postings are read together.
GROUP = 64
# Beyond this a product of components could leave a double's integers.
EXACT = 2**20


def ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


class Range:
    """Postings of a range of candidates: a row per term."""

    def __init__(self, ids: np.ndarray, c: np.ndarray):
        self.ids, self.postings = ids, np.ascontiguousarray(c.T)
        self.top, self.bottom = c.max(axis=0), c.min(axis=0)

    def competitive(self, q_ids: np.ndarray, q: np.ndarray, floors: list, work: Counter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of all candidates that reach a query's floor (None:
        all). The essential postings of a group of queries are read at once."""
        ends = q * self.top, q * self.bottom
        most, least = np.maximum(*ends), np.minimum(*ends)
        order = np.argsort(most - least, axis=1, kind="stable")
        spread = np.cumsum(np.take_along_axis(most - least, order, 1), axis=1)
        low = least.sum(axis=1)
        cuts = [0 if f is None else int(np.searchsorted(s, f - b)) for f, s, b in zip(floors, spread, low)]
        essential = np.empty(q.shape, bool)
        np.put_along_axis(essential, order, np.arange(q.shape[1]) >= np.array(cuts)[:, None], 1)
        # rest[i, j]: the most that query i's j weakest terms can add.
        rest = np.zeros((len(q), q.shape[1] + 1), q.dtype)
        rest[:, 1:] = np.cumsum(np.take_along_axis(most, order, 1), axis=1)
        used = np.flatnonzero(essential.any(axis=0))
        totals = (q * essential)[:, used] @ self.postings[used]
        work["candidates"] += len(self.ids) * len(q)
        work["postings"] += len(self.ids) * q.size
        work["read"] += len(self.ids) * int(essential.sum())
        for i, (cut, floor) in enumerate(zip(cuts, floors)):
            if cut == q.shape[1]:  # not even all terms together get there
                yield self.ids[:0], q[0, :0]
                continue
            total = totals[i]
            alive = np.flatnonzero(self.ids != q_ids[i] if floor is None else total >= floor - rest[i, cut])
            alive = alive[self.ids[alive] != q_ids[i]]
            total = total[alive]
            while cut and len(alive):
                probe = order[i, max(0, cut - PROBE) : cut]
                cut -= len(probe)
                work["read"] += len(alive) * len(probe)
                total = total + q[i, probe] @ self.postings[probe].take(alive, axis=1)
                keep = np.flatnonzero(total >= floor - rest[i, cut])
                alive, total = alive[keep], total[keep]
            work["full"] += len(alive)
            yield self.ids[alive], total


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int,
           work: Counter | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, scores) of every query's k best in a shard.
    ``work`` counts candidates and postings, those scored in full and read."""
    work = Counter() if work is None else work
    order = np.argsort(-np.square(c, dtype=np.float64).sum(axis=1), kind="stable")
    edges = [0, FIRST]
    while edges[-1] < len(c):
        edges.append(2 * edges[-1])
    ranges = [Range(c_ids[order[a:b]], c[order[a:b]]) for a, b in zip(edges, edges[1:])]
    for g in range(0, len(q), GROUP):
        names, terms = q_ids[g : g + GROUP], q[g : g + GROUP]
        best = [(c_ids[:0], q[0, :0])] * len(names)
        for r in ranges:
            floors = [scores[-1] if len(scores) == k else None for _, scores in best]
            for i, (ids, scores) in enumerate(r.competitive(names, terms, floors, work)):
                if len(ids):
                    ids, scores = np.concatenate([best[i][0], ids]), np.concatenate([best[i][1], scores])
                    found = ranked(scores, ids, k)
                    best[i] = ids[found], scores[found]
        yield from ((name, *b) for name, b in zip(names, best))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows as one matrix, short ones filled with zeros; doubles hold the
    products exactly unless components are huge."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), max(1, width)), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(candidates: DataFrame, queries: DataFrame, k: int = TOP, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of
    each query with candidates of another id, ties to the smaller vec_id.

    Both sides have (vec_id BIGINT, v ARRAY<BIGINT>), ids distinct and
    without nulls. Vectors of unequal length are compared on their common
    components. No candidates or no queries give no rows."""
    n, m = candidates.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_queries))
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64(F.lit("q"), "vec_id"), F.lit(blocks)).cast("int"))
    left = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def meet(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        cm, qm = matrix(c["v"]), matrix(q["v"])
        width = min(cm.shape[1], qm.shape[1])
        cm, qm = cm[:, :width], qm[:, :width]
        if max(np.abs(cm).max(initial=0), np.abs(qm).max(initial=0)) < EXACT:
            cm, qm = cm.astype(np.float64), qm.astype(np.float64)
        got = list(search(q["vec_id"].to_numpy(), qm, c["vec_id"].to_numpy(), cm, k))
        return pd.DataFrame({
            "query_id": np.repeat([g[0] for g in got], [len(g[1]) for g in got]).astype("int64"),
            "vec_id": np.concatenate([g[1] for g in got]).astype("int64"),
            "score": np.concatenate([g[2] for g in got]).astype("int64"),
        })

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        meet, "query_id bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): floor(64 * x) of every component. Rows with a null id, a
    null vector or a null, infinite or NaN component take no part; of rows
    that share an id, the least vector does."""
    d = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    fit = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("x", lambda x: F.floor(x * 64).cast("bigint")).alias("v")
    return d.where("vec_id is not null and x is not null").where(fit).select("vec_id", whole).groupBy("vec_id").agg(F.min("v").alias("v"))


def neighbours(embeddings: DataFrame) -> DataFrame:
    """The 20 best of every vector whose id is divisible by 20."""
    v = stored(integer_vectors(embeddings))
    return top_k(v, v.where("vec_id % 20 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
