"""Tool-call signals per conversation.

All regex and JSON work happens per turn, map-side, before any shuffle;
the conversation aggregate is a plain sum with partial aggregation, so
only one narrow row per conversation and map task crosses the network
(turn text never does).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import (
    any_regex, contains_any, ends_with_any_regex, length64, literal_alternation, py_strip,
)
from ..sources.traces import JSON

CALL_RX, THINK_RX = fixed.CALL_PATTERN, fixed.THINK_PATTERN


def file_kind_regexes(frontend=None, config_suffixes=None, config_names=None, test_patterns=None):
    fe = ends_with_any_regex(frontend or fixed.FRONTEND_SUFFIXES)
    cfg = ends_with_any_regex(config_suffixes or fixed.CONFIG_SUFFIXES) + "|" + literal_alternation(
        config_names or fixed.CONFIG_NAMES)
    test = any_regex(test_patterns or fixed.TEST_PATH_PATTERNS)
    return fe, cfg, test


def _calls(text: Column, role: Column) -> Column:
    """JSON texts of the tool calls of a gpt turn (invalid JSON skipped)."""
    raw = F.when(role == fixed.ROLE_GPT, F.regexp_extract_all(text, F.lit(CALL_RX), 1)).otherwise(F.array().cast("array<string>"))
    return F.filter(raw, lambda c: F.from_json(c, "name STRING, input STRING, _corrupt_record STRING", JSON)["_corrupt_record"].isNull())


def _name(v: Column) -> Column:
    return F.coalesce(F.from_json(v, "name STRING", JSON)["name"], F.lit(""))


def _input_field(v: Column, field: str) -> Column:
    # A non-object input yields NULL, i.e. "no path / no command".
    return F.from_json(v, "input STRUCT<file_path: STRING, command: STRING>", JSON)["input"][field]


def tool_calls(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per well-formed tool call: ``key, turn, pos, name, file_path, command``."""
    t = turns.select(key, "turn", F.posexplode(_calls(F.col("text"), F.col("role"))).alias("pos", "v"))
    return t.select(
        key, "turn", F.col("pos").cast("bigint").alias("pos"),
        _name(F.col("v")).alias("name"),
        _input_field(F.col("v"), "file_path").alias("file_path"),
        _input_field(F.col("v"), "command").alias("command"),
    )


def turn_signals(turns: DataFrame, key: str = "conv_id", fe_rx=None, cfg_rx=None, test_rx=None,
                 test_cmds=None, build_cmds=None, error_words=None) -> DataFrame:
    """Per-call rows with per-turn counters on the first row of each turn
    (narrow), ready to be summed per conversation.

    The calls of a turn are extracted and parsed once; ``posexplode_outer``
    turns them into rows so every counter is a plain column expression
    (whole-stage codegen) instead of repeated array lambdas."""
    d_fe, d_cfg, d_test = file_kind_regexes()
    fe_rx, cfg_rx, test_rx = fe_rx or d_fe, cfg_rx or d_cfg, test_rx or d_test
    tcmd_rx = literal_alternation(test_cmds or fixed.TEST_COMMANDS)
    bcmd_rx = literal_alternation(build_cmds or fixed.BUILD_COMMANDS)

    role, text = F.col("role"), F.col("text")
    gpt = role == fixed.ROLE_GPT
    think = F.aggregate(
        F.transform(F.regexp_extract_all(text, F.lit(THINK_RX), 1), lambda m: F.length(m).cast("bigint")),
        F.lit(0).cast("bigint"), lambda a, b: a + b,
    )
    error_turn = (role == fixed.ROLE_HUMAN) & text.contains(fixed.RESULT_OPEN) & contains_any(
        F.lower(text), error_words or fixed.ERROR_WORDS)
    t = turns.select(
        key,
        F.when(gpt, length64(text)).otherwise(0).alias("_gpt_chars"),
        F.when(gpt, think).otherwise(0).alias("_think_chars"),
        F.coalesce(error_turn, F.lit(False)).cast("bigint").alias("_error_turn"),
        F.posexplode_outer(_calls(text, role)).alias("_pos", "_v"),
    )
    first = (F.col("_pos").isNull() | (F.col("_pos") == 0)).cast("bigint")
    c = t.select(
        key,
        F.when(first == 1, 1).otherwise(0).cast("bigint").alias("_turn"),
        (F.col("_gpt_chars") * first).alias("gpt_chars"),
        (F.col("_think_chars") * first).alias("think_chars"),
        (F.col("_error_turn") * first).alias("error_turns"),
        F.col("_v").isNotNull().alias("_call"),
        _name(F.col("_v")).alias("_name"),
        _input_field(F.col("_v"), "file_path").alias("_fp"),
        _input_field(F.col("_v"), "command").alias("_cmd"),
    )
    name, fp, cmd = F.col("_name"), F.col("_fp"), F.col("_cmd")
    is_file = F.col("_call") & name.isin("Edit", "Write", "Read") & fp.isNotNull() & (fp != "")
    is_cmd = F.col("_call") & (name == "Bash") & cmd.isNotNull() & (cmd != "")
    lfp, lcmd = F.lower(fp), F.lower(cmd)

    def n(cond):
        return F.coalesce(cond, F.lit(False)).cast("bigint")

    return c.select(
        key, "_turn", "gpt_chars", "think_chars",
        n(F.col("_call")).alias("n_calls"),
        *[n(F.col("_call") & (name == tool)).alias(f"n_{tool.lower()}") for tool in ("Edit", "Write", "Read", "Bash", "Grep", "Glob")],
        "error_turns",
        n(is_file).alias("n_files"),
        n(is_file & lfp.rlike(fe_rx)).alias("frontend_files"),
        n(is_file & lfp.rlike(cfg_rx)).alias("config_files"),
        n(is_file & lfp.rlike(test_rx)).alias("test_files"),
        n(is_cmd).alias("n_cmds"),
        n(is_cmd & lcmd.rlike(tcmd_rx)).alias("test_cmds"),
        n(is_cmd & py_strip(cmd).startswith(fixed.GIT_PREFIX)).alias("git_cmds"),
        n(is_cmd & lcmd.rlike(bcmd_rx)).alias("build_cmds"),
    )


SIGNAL_COLUMNS = ["gpt_chars", "think_chars", "n_calls", "n_edit", "n_write", "n_read", "n_bash", "n_grep",
                  "n_glob", "error_turns", "n_files", "frontend_files", "config_files", "test_files", "n_cmds",
                  "test_cmds", "git_cmds", "build_cmds"]


def conversation_signals(turns: DataFrame, key: str = "conv_id", **kw) -> DataFrame:
    """One row per conversation: turn count (system included), counters,
    ``total`` (= tool calls + error turns) and the thinking share."""
    ts = turn_signals(turns, key, **kw)
    s = ts.groupBy(key).agg(
        F.sum("_turn").cast("bigint").alias("n_turns"),
        *[F.sum(c).cast("bigint").alias(c) for c in SIGNAL_COLUMNS],
    )
    return s.withColumn("total", F.col("n_calls") + F.col("error_turns")).withColumn(
        "think_share", F.col("think_chars").cast("double") / F.greatest(F.col("gpt_chars"), F.lit(1)).cast("double")
    )
