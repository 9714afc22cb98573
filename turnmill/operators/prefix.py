"""Running counts that do not put a whole key into one task.

A window over every row of one key sorts that key in one task. Here rows
are windowed per (key, chunk) — chunks are ranges of the ordering — and
each chunk is shifted by the totals of the earlier chunks of its key,
taken from one summary row per chunk (a partial aggregate, then a window
over the small summary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that a single window holds at most.
CHUNK_ROWS = 65536


def chunk_offsets(summary: DataFrame, key: str, chunk: str, count: str) -> DataFrame:
    """Per chunk: total of ``count`` over the earlier chunks of its key."""
    wk = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(key, chunk, F.coalesce(F.sum(count).over(wk), F.lit(0)).alias("_off"))


def chunked_row_number(df: DataFrame, key: str, chunk, order: list, out: str) -> DataFrame:
    """``row_number() over (partition by key order by order)`` computed per
    (key, chunk); ``chunk`` must be non-decreasing in ``order``."""
    d = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(key, "_chunk").orderBy(*order)
    d = d.withColumn("_lrn", F.row_number().over(w))
    cs = d.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    d = d.join(chunk_offsets(cs, key, "_chunk", "_n"), [key, "_chunk"], "inner")
    return d.withColumn(out, (F.col("_off") + F.col("_lrn")).cast("bigint")).drop("_chunk", "_lrn", "_off")


def chunked_running_sum(df: DataFrame, keys: list[str], chunk, order: list, value: str, out: str) -> DataFrame:
    """``sum(value) over (partition by keys order by order)`` up to and with
    each row, computed per (keys, chunk) and shifted by earlier chunks;
    ``chunk`` must be non-decreasing in ``order``."""
    d = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_lsum", F.sum(value).over(w))
    cs = d.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    cs = cs.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    d = d.join(cs, [*keys, "_chunk"], "inner")
    return d.withColumn(out, (F.col("_off") + F.col("_lsum")).cast("bigint")).drop("_chunk", "_lsum", "_off")
