"""Dataset reports: statistics, label distribution, examples, previews.

Reports are small aggregates over big tables: each one is a partial
aggregation (or a per-group top-k that Spark turns into a map-side
``WindowGroupLimit``), never a collect of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import count_literal, length64
from .segments import rank_statistics


def dataset_stats(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Conversations, turns, average / min / max / median (upper nearest
    rank, sorted[n // 2]) turns per conversation, characters, and tool-call
    and think tags counted on non-system turns.

    Totals are one aggregate over the per-conversation counts; the median
    is an exact rank (``rank_statistics``)."""
    non_sys = F.col("role") != fixed.ROLE_SYSTEM
    per = turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sum(length64("text")).alias("n_chars"),
        F.sum(F.when(non_sys, count_literal("text", fixed.CALL_OPEN)).otherwise(0)).alias("n_calls"),
        F.sum(F.when(non_sys, count_literal("text", fixed.THINK_OPEN)).otherwise(0)).alias("n_think"),
    )
    totals = per.agg(
        F.count(F.lit(1)).alias("conversations"),
        F.sum("n_turns").cast("bigint").alias("total_turns"),
        (F.sum("n_turns").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_turns"),
        F.sum("n_chars").cast("bigint").alias("total_chars"),
        F.sum("n_calls").cast("bigint").alias("tool_call_tags"),
        F.sum("n_think").cast("bigint").alias("think_tags"),
        F.min("n_turns").cast("bigint").alias("min_turns"),
        F.max("n_turns").cast("bigint").alias("max_turns"),
    )
    median = rank_statistics(per, "n_turns").where("stat = 'median'").select(F.col("chars").alias("median_turns"), "n")
    # One row each, met on the number of conversations.
    return totals.join(median, totals["conversations"] == median["n"], "left").drop("n")


def tool_coverage(tools: DataFrame, catalog: DataFrame, key: str = "conv_id") -> DataFrame:
    """Catalog tools that appear in any conversation's tool list, with the
    number of conversations that list them."""
    t = tools.select(key, F.explode("tools").alias("name"))
    t = t.join(F.broadcast(catalog.select("name")), "name", "left_semi")  # catalog: fixed 11 rows
    # A conversation lists a tool once.
    return t.groupBy("name").agg(F.count(F.lit(1)).alias("n_conversations"))


def label_distribution(labeled: DataFrame, categories: DataFrame) -> DataFrame:
    """Count and share per label, with its description ('' if unknown)."""
    c = labeled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("pct", F.col("n").cast("double") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))).cast("double"))
    c = c.join(F.broadcast(categories), "label", "left")  # categories: fixed 10 rows
    # Most common first (ties by name); the result has at most 10 rows.
    return c.select("label", "n", "pct", F.coalesce("description", F.lit("")).alias("description")).orderBy(
        F.desc("n"), "label")


def smallest_class(distribution: DataFrame) -> DataFrame:
    return distribution.agg(F.min("n").alias("min_count"), F.count(F.lit(1)).alias("n_labels"))


def first_human_preview(turns: DataFrame, key: str = "conv_id", width: int = fixed.LABEL_PREVIEW_CHARS) -> DataFrame:
    """First human turn, cut to ``width`` characters, newlines as spaces."""
    # Cut before the aggregate: only the preview crosses the network.
    cut = F.replace(F.substring("text", 1, width), F.lit("\n"), F.lit(" "))
    first = turns.groupBy(key).agg(F.min_by(cut, F.when(F.col("role") == fixed.ROLE_HUMAN, F.col("turn"))).alias("preview"))
    return first.where(F.col("preview").isNotNull())


def label_examples(labeled: DataFrame, turns: DataFrame, key: str = "conv_id",
                   n: int = fixed.LABEL_EXAMPLES) -> DataFrame:
    """First ``n`` (by key) reasons and previews per label, paired by key;
    previews are made for the picked conversations only.

    ``row_number() <= literal`` lets Spark insert a per-partition group
    limit before the shuffle, so even a label holding a third of all rows
    ships at most ``n`` rows per map task."""
    w = Window.partitionBy("label").orderBy(key)
    top = labeled.select("label", key, "reason").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    # At most labels x n keys.
    previews = first_human_preview(turns.join(F.broadcast(top.select(key)), key, "left_semi"), key)
    return top.join(previews, key, "left").select("label", F.col("rn").cast("bigint").alias("rn"), key, "reason", "preview")


def preview(turns: DataFrame, n: int, key: str = "conv_id", order: str = "turn",
            width: int = fixed.PREVIEW_CHARS) -> DataFrame:
    """First ``n`` conversations by key; texts over ``width`` characters are
    cut and get a ``... [N chars total]`` line. The id list is a top-n of
    distinct keys (bounded by ``n``) joined back by broadcast."""
    ids = turns.select(key).distinct().orderBy(key).limit(n)
    t = turns.join(F.broadcast(ids), key, "left_semi")
    ln = F.length("text")
    cut = F.when(ln > width, F.concat(F.substring("text", 1, width), F.lit("\n... ["), ln.cast("string"), F.lit(" chars total]"))).otherwise(F.col("text"))
    return t.select(key, order, "role", cut.alias("text"))


def categories_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in fixed.CATEGORY_TEXT.items()], "label STRING, description STRING")


def output_accounting(turns: DataFrame, labeled: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows and bytes per per-label output, before writing: each
    conversation as the JSON line the sink writes,
    ``{"conversations":[{"from":..,"value":..},...]}`` plus a newline.

    The line is never built: its length is 18 (opening) + the JSON bytes of
    each turn + one comma between turns + 3 (closing and newline), a
    per-turn partial sum, so even a huge conversation is no single row."""
    turn_json = F.to_json(F.struct(F.col("role").alias("from"), F.col("text").alias("value")))
    conv = turns.groupBy(key).agg((F.sum(F.octet_length(turn_json)) + F.count(F.lit(1)) + 20).cast("bigint").alias("bytes"))
    sized = conv.join(labeled.select(key, "label"), key, "inner")
    return sized.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").cast("bigint").alias("bytes"))
