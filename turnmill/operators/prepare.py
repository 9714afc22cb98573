"""Training-text preparation: chat rendering, validity, length budget,
train/eval split, step estimate, sequence packing.

Whether a conversation is valid and fits is known from the lengths of its
pieces: one narrow partial aggregate over the turns. The text is put
together only for the conversations that are kept. The split is a
per-row hash test, stable under any repartitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import hash_unit, length64, ordered_join
from .prefix import chunked_running_sum

# Ranges of the 32-bit hash that are summed apart: 2 ** (32 - HASH_SHIFT).
HASH_SHIFT = 20


def _chat_role(roles=None) -> Column:
    roles = roles or fixed.CHAT_ROLES
    r = F.col("role")
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in roles.items() for x in kv]), r), r)


def _is_valid() -> Column:
    return (F.col("_has_user") == 1) & (F.col("n_messages") >= 2)


def chat_lengths(turns: DataFrame, key: str = "conv_id", open_: str = fixed.CHAT_OPEN, close: str = fixed.CHAT_CLOSE,
                 roles=None) -> DataFrame:
    """``key, n_messages, n_chars``: characters of each conversation's chat
    text without building it (0 when it is not valid)."""
    role = _chat_role(roles)
    size = F.length(role) + F.coalesce(length64("text"), F.lit(0)) + (len(open_) + 1 + len(close))
    agg = turns.groupBy(key).agg(
        F.sum(size).cast("bigint").alias("_chars"),
        F.max((role == "user").cast("int")).alias("_has_user"),
        F.count(F.lit(1)).alias("n_messages"),
    )
    return agg.select(key, "n_messages", F.when(_is_valid(), F.col("_chars")).otherwise(F.lit(0)).cast("bigint").alias("n_chars"))


def chat_text(turns: DataFrame, key: str = "conv_id", order: str = "turn", open_: str = fixed.CHAT_OPEN,
              close: str = fixed.CHAT_CLOSE, roles=None, only: DataFrame | None = None) -> DataFrame:
    """Render each conversation as one chat string. Roles are mapped
    (human -> user, gpt -> assistant, others unchanged); a conversation
    without a user turn or with fewer than two messages renders as ''.
    With ``only``, just the conversations whose key it holds."""
    t = turns if only is None else turns.join(only.select(key), key, "left_semi")
    mapped = _chat_role(roles)
    piece = F.concat(F.lit(open_), mapped, F.lit("\n"), F.coalesce(F.col("text"), F.lit("")), F.lit(close))
    t = t.select(key, order, mapped.alias("_role"), piece.alias("_piece"))
    agg = t.groupBy(key).agg(
        ordered_join("_piece", order, "").alias("_text"),
        F.max((F.col("_role") == "user").cast("int")).alias("_has_user"),
        F.count(F.lit(1)).alias("n_messages"),
    )
    return agg.select(key, "n_messages", F.when(_is_valid(), F.col("_text")).otherwise(F.lit("")).alias("text"))


def with_length(chat: DataFrame) -> DataFrame:
    return chat.withColumn("n_chars", length64("text"))


def validity_ledger(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("n_chars") > 0).alias("n_valid")).withColumn(
        "n_dropped", F.col("n_in") - F.col("n_valid"))


def within_budget(lengths: DataFrame, seq_length: int, chars_per_token: int = fixed.CHARS_PER_TOKEN) -> DataFrame:
    """Conversations with a text of at most ``seq_length * 4`` characters."""
    n = F.col("n_chars")
    return lengths.where((n > 0) & (n <= seq_length * chars_per_token))


def train_eval_split(df: DataFrame, key: str = "conv_id", fraction: float = fixed.EVAL_FRACTION,
                     seed: int = fixed.SPLIT_SEED) -> DataFrame:
    """``split`` = eval when the 32-bit hash of ``seed:key`` falls below
    ``fraction * 2^32``; no split column value other than train when the
    fraction is 0."""
    if fraction <= 0:
        return df.withColumn("split", F.lit("train"))
    return df.withColumn("split", F.when(hash_unit(key, seed) < F.lit(int(fraction * (1 << 32))), "eval").otherwise("train"))


def step_estimate(train: DataFrame, epochs: int = 1, batch_size: int = 1, grad_accum: int = 8) -> DataFrame:
    """Optimizer steps: rows * epochs // (batch * accumulation)."""
    return train.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.floor(F.col("rows") * epochs / (batch_size * grad_accum)).cast("bigint").alias("steps"))


def pack_sequences(lengths: DataFrame, seq_length: int, key: str = "conv_id", seed: int = fixed.SPLIT_SEED,
                   chars_per_token: int = fixed.CHARS_PER_TOKEN) -> DataFrame:
    """Concatenate-and-chunk packing: examples in hash order form one token
    stream (estimate: characters // 4, at least 1); an example goes to the
    ``seq_length``-token chunk where it starts. The running sum is taken
    per range of the hash and shifted by the ranges before it, so the
    result doesn't depend on the number of tasks."""
    u = hash_unit(key, seed)
    d = lengths.where(F.col("n_chars") > 0).select(
        key, u.alias("_u"), F.greatest(F.floor(F.col("n_chars") / chars_per_token), F.lit(1)).cast("bigint").alias("tokens"),
        F.lit(0).alias("_all"))
    d = chunked_running_sum(d, ["_all"], F.shiftright("_u", HASH_SHIFT), ["_u", key], "tokens", "_cum")
    return d.select(key, "tokens", F.floor((F.col("_cum") - F.col("tokens")) / seq_length).cast("bigint").alias("bin"))
