"""Driver tables and conversation datasets (long form).

The engine keeps conversations in a long table ``(conv_id, turn, role,
text)`` — one row per turn — so every per-conversation step is a
shuffle by ``conv_id`` plus windows and grouped aggregates, never a
Python loop over nested lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import table_path
from . import traces

TURN_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def normalize_roles(df: DataFrame, role: str = "role") -> DataFrame:
    """Accept both dialects: user/assistant become human/gpt, the rest stays."""
    r = F.col(role)
    return df.withColumn(
        role,
        F.when(r == "user", F.lit(fixed.ROLE_HUMAN))
        .when(r == "assistant", F.lit(fixed.ROLE_GPT))
        .otherwise(r),
    )


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` table as ShareGPT-dialect turns."""
    df = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return normalize_roles(df)


def read_sharegpt(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """JSONL dataset of ``{"conversations": [...]}`` lines, either dialect
    (``from``/``value`` or ``role``/``content``), to long form. ``conv_id``
    names the line: its file and the byte where it begins, so it is the same
    in every read. A blank or broken line fails the read when ``strict``,
    else it is left out."""
    schema = (
        "conversations ARRAY<STRUCT<`from`: STRING, value: STRING, role: STRING, content: STRING>>"
    )
    raw = traces.read_dataset(spark, path, schema, strict).withColumn("conv_id", F.concat_ws("#", "path", "address"))
    t = raw.select("conv_id", F.posexplode("conversations").alias("turn", "m"))
    t = t.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("m.from"), F.col("m.role")).alias("role"),
        F.coalesce(F.col("m.value"), F.col("m.content")).alias("text"),
    )
    return normalize_roles(t)


def to_sharegpt(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Long form back to one nested row per conversation (the edge format)."""
    s = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("role").alias("r"), F.col("text").alias("t"))))
    return turns.groupBy(key).agg(
        F.transform(s, lambda x: F.struct(x["r"].alias("from"), x["t"].alias("value"))).alias("conversations")
    )


# ---- deterministic perturbations used to exercise the turn operators ----

def perturb_roles_and_blanks(turns: DataFrame) -> DataFrame:
    """Equal neighbours and blank texts: every third turn (``turn % 3 = 2``)
    becomes a gpt turn, and texts at ``(conv_id + turn) % 11 = 0`` become
    whitespace. Rows are changed, never removed."""
    return turns.select(
        "conv_id",
        "turn",
        F.when((F.col("role") != fixed.ROLE_SYSTEM) & (F.col("turn") % 3 == 2), F.lit(fixed.ROLE_GPT))
        .otherwise(F.col("role"))
        .alias("role"),
        F.when((F.col("conv_id") + F.col("turn")) % 11 == 0, F.lit(" \n\t "))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def with_copies(turns: DataFrame) -> DataFrame:
    """Every conversation again under ``-conv_id - 1``, an id that no
    original has (exact duplicates)."""
    return turns.unionByName(turns.withColumn("conv_id", -F.col("conv_id") - 1))


def with_home_prefix(turns: DataFrame, home: str = "/home/dev/") -> DataFrame:
    """Texts that mention a home directory, for the sanitizer."""
    return turns.withColumn("text", F.concat(F.lit(home), F.col("text")))
