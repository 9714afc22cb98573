"""Router examples: input selection, label thresholds, balance, label ids,
exact stratified split, expert manifest.

Label-level tables carry no broadcast hint: any ``label`` column may come,
and AQE broadcasts a table that turns out small by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import hash_unit, py_strip


def router_inputs(turns: DataFrame, key: str = "conv_id", min_chars: int = fixed.ROUTER_MIN_CHARS,
                  max_chars: int = fixed.ROUTER_MAX_CHARS) -> DataFrame:
    """First human turn that is not a tool result and has at least
    ``min_chars`` characters after stripping, cut to ``max_chars``.
    Conversations without one get ``input = NULL`` (counted as skipped)."""
    s = py_strip("text")
    ok = (F.col("role") == fixed.ROLE_HUMAN) & ~s.startswith(fixed.RESULT_OPEN) & (F.length(s) >= min_chars)
    # Cut before the aggregate: at most ``max_chars`` cross the network.
    return turns.groupBy(key).agg(F.min_by(F.substring(s, 1, max_chars), F.when(ok, F.col("turn"))).alias("input"))


def router_examples(labeled: DataFrame, inputs: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key, input, label`` for conversations with an eligible input."""
    return labeled.select(key, "label").join(inputs.where(F.col("input").isNotNull()), key, "inner").select(key, "input", "label")


def skipped_inputs(inputs: DataFrame) -> DataFrame:
    return inputs.agg(F.count(F.lit(1)).alias("conversations"), F.count_if(F.col("input").isNull()).alias("skipped"))


def label_counts(examples: DataFrame) -> DataFrame:
    return examples.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def apply_min_count(examples: DataFrame, min_count: int = fixed.ROUTER_MIN_COUNT):
    """(kept examples, removed labels). Labels with fewer than ``min_count``
    examples are removed; a non-positive threshold keeps everything."""
    counts = label_counts(examples)
    if min_count <= 0:
        return examples, counts.where(F.lit(False)).select("label", "n")
    keep = counts.where(F.col("n") >= min_count).select("label")
    kept = examples.join(keep, "label", "left_semi")
    removed = counts.join(keep, "label", "left_anti")
    return kept, removed


BUCKETS = 4096


def ranked_in_label(examples: DataFrame, key: str, seed: int, buckets: int) -> DataFrame:
    """``examples`` with ``_rank``, the place of each among the examples of
    its label in the order of ``md5(seed:key)`` (ties by key), and ``_n``,
    their number.

    A sort per label would put a hot label into one task. Instead the hash
    is cut into ``buckets`` ranges (a power of two): a partial aggregation
    counts rows per (label, bucket), a running sum over that histogram gives
    each bucket's offset, and rows are ranked inside their (label, bucket)."""
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    u = hash_unit(key, seed)
    d = examples.withColumn("_u", u).withColumn("_b", F.shiftright(u, 32 - (buckets.bit_length() - 1)))
    hist = d.groupBy("label", "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("label").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.select("label", "_b", (F.sum("_c").over(w) - F.col("_c")).alias("_off"),
                       F.sum("_c").over(Window.partitionBy("label")).alias("_n"))
    d = d.join(hist, ["label", "_b"], "inner")
    rank = F.row_number().over(Window.partitionBy("label", "_b").orderBy("_u", key)) + F.col("_off")
    return d.withColumn("_rank", rank).drop("_u", "_b", "_off")


def balance(examples: DataFrame, key: str = "conv_id", seed: int = fixed.SPLIT_SEED, buckets: int = BUCKETS) -> DataFrame:
    """As many examples of every label as the rarest label has: those that
    come first in the order of ``md5(seed:key)``."""
    m = label_counts(examples).agg(F.min("n")).first()[0]
    if m is None:
        return examples
    return ranked_in_label(examples, key, seed, buckets).where(F.col("_rank") <= int(m)).drop("_rank", "_n")


def label_map(examples: DataFrame) -> DataFrame:
    """Labels sorted by name -> ids 0..n-1. One row per label (the cascade
    has 10), ranked in one task."""
    labels = examples.select("label").distinct()
    return labels.select("label", (F.row_number().over(Window.orderBy("label")) - 1).cast("bigint").alias("label_id"))


def encode(examples: DataFrame, mapping: DataFrame) -> DataFrame:
    return examples.join(mapping, "label", "inner")


def stratified_split(examples: DataFrame, key: str = "conv_id", test_fraction: float = fixed.ROUTER_TEST_FRACTION,
                     seed: int = fixed.SPLIT_SEED, buckets: int = BUCKETS) -> DataFrame:
    """Exact stratified split: in each label the ``ceil(f * n)`` examples
    with the smallest ``md5(seed:key)`` prefix (ties by key) are ``test``."""
    d = ranked_in_label(examples, key, seed, buckets)
    test = F.col("_rank") <= F.ceil(F.lit(float(test_fraction)) * F.col("_n"))
    return d.withColumn("split", F.when(test, "test").otherwise("train")).drop("_rank", "_n")


def expert_manifest(labeled: DataFrame, min_examples: int = fixed.MIN_EXPERT_EXAMPLES,
                    previous: DataFrame | None = None) -> DataFrame:
    """Per label: rows and whether its expert dataset is big enough
    (``train``) or ``skip``; with a previous manifest, labels already
    trained there are ``done``."""
    m = labeled.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    status = F.when(F.col("rows") >= min_examples, "train").otherwise("skip")
    if previous is not None:
        done = previous.where(F.col("status") == "done").select("label", F.lit(True).alias("_done"))
        m = m.join(done, "label", "left")
        status = F.when(F.col("_done") & (F.col("rows") >= min_examples), "done").otherwise(status)
    return m.select("label", "rows", status.alias("status"))


PAD = "<pad>"


def tokenize(examples: DataFrame, max_length: int = 512, text: str = "input", pad: bool = True) -> DataFrame:
    """Batched tokenization stand-in: lower-cased word tokens (letters,
    digits, underscore), cut to ``max_length`` and, with ``pad``, filled
    to ``max_length`` with a pad token. Adds ``tokens``, ``n_tokens``
    (before the cut) and ``truncated``."""
    toks = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}_]+"), lambda t: t != "")
    cut = F.slice(toks, 1, max_length)
    if pad:
        cut = F.concat(cut, F.array_repeat(F.lit(PAD), F.greatest(F.lit(max_length) - F.size(cut), F.lit(0))))
    return examples.withColumn("n_tokens", F.size(toks).cast("bigint")).withColumn(
        "truncated", F.col("n_tokens") > max_length).withColumn("tokens", cut)
