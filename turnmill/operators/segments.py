"""Segmentation at compression markers and length statistics.

Plan: one shuffle by (conversation, chunk of turns); windows run per
chunk, conversation-wide facts come from one summary row per chunk, and
the system turn is copied to each segment with ``explode(sequence(...))``
instead of a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import length64
from .prefix import CHUNK_ROWS


def split_segments(turns: DataFrame, marker: str = fixed.SEGMENT_MARKER, key: str = "conv_id",
                   order: str = "turn", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Cut each conversation before every turn holding ``marker``.

    Only the first turn can be the system turn; it is repeated at the head
    of every segment. A marker in the first non-system turn opens no empty
    segment. Conversations without a marker (or with a system turn only)
    come back as segment 0. Output: ``key, segment, turn, role, text``.

    Rows are windowed per ``(key, order // chunk_rows)`` chunk, and
    everything that spans a conversation (marker offsets of earlier chunks,
    the head turn, the first body turn, the segment count) comes from one
    summary row per chunk, so a conversation holding a third of all rows is
    spread over many tasks.
    """
    t = turns.withColumn("_chunk", F.floor(F.col(order) / chunk_rows).cast("bigint")).withColumn(
        "_hit", F.coalesce(F.col("text").contains(marker), F.lit(False)).cast("int"))
    w = Window.partitionBy(key, "_chunk").orderBy(order)
    t = t.withColumn("_lrn", F.row_number().over(w)).withColumn(
        "_lcum", F.sum("_hit").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def row_struct():
        return F.struct(F.col(order).alias("o"), F.col("role").alias("r"), F.col("_hit").alias("h"))

    # One summary row per chunk (same partitioning as the window: no exchange).
    cs = t.groupBy(key, "_chunk").agg(
        F.sum("_hit").alias("_h"),
        F.min(F.when(F.col("_lrn") == 1, row_struct())).alias("_f1"),
        F.min(F.when(F.col("_lrn") == 2, row_struct())).alias("_f2"),
    )
    wk = Window.partitionBy(key).orderBy("_chunk")
    whole = wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cs = cs.withColumn("_off", F.coalesce(F.sum("_h").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cs = cs.withColumn("_c1", F.first("_f1").over(whole)).withColumn(
        "_c2", F.coalesce(F.first("_f2").over(whole), F.nth_value("_f1", 2).over(whole))).withColumn(
        "_total", F.sum("_h").over(whole))
    head = F.col("_c1.r") == fixed.ROLE_SYSTEM
    head_hit = F.when(head, F.col("_c1.h")).otherwise(0)
    first_body = F.when(head, F.col("_c2")).otherwise(F.col("_c1"))
    base = F.coalesce(first_body.getField("h"), F.lit(0))
    nseg = F.when(first_body.isNull(), F.lit(1)).otherwise(F.col("_total") - head_hit - base + 1)
    facts = cs.select(key, "_chunk", "_off", head.alias("_has_head"), F.col("_c1.o").alias("_head_o"),
                      head_hit.alias("_head_hit"), base.alias("_base"), nseg.cast("bigint").alias("_nseg"))
    j = t.join(facts, [key, "_chunk"], "inner")
    is_head = F.col("_has_head") & (F.col(order) == F.col("_head_o"))
    seg = (F.col("_off") + F.col("_lcum") - F.col("_head_hit") - F.col("_base")).cast("bigint")
    segs = F.when(is_head, F.sequence(F.lit(0).cast("bigint"), F.col("_nseg") - 1)).otherwise(F.array(seg))
    return j.select(key, F.explode(segs).alias("segment"), order, "role", "text")


def segment_lengths(segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """Characters and turns per segment (segments stay partitioned by key,
    so this aggregate adds no exchange)."""
    return segments.groupBy(key, "segment").agg(
        F.sum(length64("text")).alias("n_chars"),
        F.count(F.lit(1)).alias("n_turns"),
    )


def segment_ledger(turns: DataFrame, segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """Conversations in, segments out, segments added by the splits."""
    # Segments of a conversation are numbered 0, 1, ... without gaps.
    per_conv = segments.groupBy(key).agg((F.max("segment") + 1).alias("n_seg"))
    return per_conv.agg(
        F.count(F.lit(1)).alias("conversations_in"),
        F.sum("n_seg").cast("bigint").alias("segments_out"),
        F.sum(F.col("n_seg") - 1).cast("bigint").alias("added_by_splits"),
        F.count_if(F.col("n_seg") > 1).alias("conversations_split"),
    )


def rank_statistics(values: DataFrame, value: str) -> DataFrame:
    """Exact nearest-rank statistics of ``value``: min, P10, P25, median,
    P75, P90, P95, max at 0-based sorted positions n//10, n//4, n//2,
    3n//4, 9n//10, floor(0.95 n), n-1.

    No global sort and no window over all distinct values: rows are counted
    per range of values (``RANGES`` of them by size, so a bounded table),
    which says the range that holds each rank and how many values come
    before it; only the distinct values of those few ranges are then
    counted and ordered, each range by itself.
    """
    ranks = {"min": "0", "p10": "floor(n / 10)", "p25": "floor(n / 4)", "median": "floor(n / 2)", "p75": "floor(n * 3 / 4)",
             "p90": "floor(n * 9 / 10)", "p95": "floor(n * 0.95)", "max": "n - 1"}
    v = values.select(F.col(value).alias("_v"), value_range(F.col(value)).alias("_r")).where("_v is not null")
    coarse = v.groupBy("_r").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most RANGES rows.
    coarse = coarse.withColumn("_before", F.sum("_c").over(run) - F.col("_c")).withColumn(
        "n", F.sum("_c").over(Window.partitionBy(F.lit(1))))
    stack = ", ".join(f"'{s}', {i}, cast({ranks[s]} as bigint)" for i, s in enumerate(fixed.RANK_STATS))
    asked = coarse.selectExpr("_r", "_c", "_before", "n", f"stack({len(ranks)}, {stack}) as (stat, stat_order, _rank)").where(
        "_rank >= _before and _rank < _before + _c")
    fine = v.join(F.broadcast(asked.select("_r").distinct()), "_r", "left_semi").groupBy("_r", "_v").agg(F.count(F.lit(1)).alias("_k"))
    inside = Window.partitionBy("_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = fine.withColumn("_upto", F.sum("_k").over(inside))
    hit = fine.join(F.broadcast(asked), "_r").where("_rank >= _before + _upto - _k and _rank < _before + _upto")
    return hit.select(
        "stat",
        F.col("stat_order").cast("bigint").alias("stat_order"),
        F.col("n").cast("bigint").alias("n"),
        F.col("_v").cast("bigint").alias("chars"),
        (F.col("_v").cast("bigint") / fixed.CHARS_PER_TOKEN).cast("bigint").alias("tokens"),
    )


def value_range(v: Column) -> Column:
    """Range of a non-negative number: its power of two, cut in 1,024 (so
    at most 64 * 1,024 ranges, each a thousandth of the value wide)."""
    power = F.floor(F.log2(F.greatest(v, F.lit(1)).cast("double"))).cast("bigint")
    low = F.pow(F.lit(2.0), power)
    part = F.least(F.lit(1023), F.greatest(F.lit(0), F.floor((v - low) / low * 1024))).cast("bigint")
    return power * 1024 + part


def fit_under_limits(lengths: DataFrame, value: str = "n_chars", limits=None) -> DataFrame:
    """For each token limit: rows whose characters are <= 4 * limit."""
    limits = limits or fixed.TOKEN_LIMITS
    aggs = [F.count(F.lit(1)).alias("n")]
    for lim in limits:
        aggs.append(F.count_if(F.col(value) <= lim * fixed.CHARS_PER_TOKEN).alias(f"f{lim}"))
    wide = lengths.agg(*aggs)
    stack = ", ".join(f"{lim}L, f{lim}" for lim in limits)
    long = wide.selectExpr("n", f"stack({len(limits)}, {stack}) as (limit_tokens, n_fit)")
    return long.select(
        F.col("limit_tokens").cast("bigint").alias("limit_tokens"),
        (F.col("limit_tokens") * fixed.CHARS_PER_TOKEN).cast("bigint").alias("limit_chars"),
        F.col("n_fit").cast("bigint").alias("n_fit"),
        F.col("n").cast("bigint").alias("n_total"),
        F.when(F.col("n") > 0, F.col("n_fit").cast("double") * 100.0 / F.col("n").cast("double")).alias("pct"),
    )
