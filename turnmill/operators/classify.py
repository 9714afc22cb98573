"""Rule cascade: conversation signals -> category, rule number, reason.

One ``CASE`` chain evaluated per signal row (first match wins), no
shuffle. The reason strings follow the fixed formats listed in
``functions.fixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _s(c) -> Column:
    return F.col(c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _share(part: str, whole: str) -> Column:
    return F.col(part).cast("double") / F.greatest(F.col(whole), F.lit(1)).cast("double")


def rules():
    """(rule, label, condition, reason) in cascade order."""
    c = F.col
    edits, writes, total, turns = c("n_edit"), c("n_write"), c("total"), c("n_turns")
    search = c("n_grep") + c("n_glob") + c("n_read")
    pct = F.bround(c("think_share") * 100.0, 0).cast("bigint").cast("string")
    return [
        (1, "compact", turns < 3, F.lit("too short")),
        (2, "compact", (turns <= 5) & (total <= 2), _cat(_s("n_turns"), " turns, ", _s("total"), " tool calls")),
        (3, "planning", (c("think_share") > 0.5) & (total <= 3), _cat(pct, "% thinking, ", _s("total"), " tools")),
        (4, "testing", (c("test_files") >= 2) | ((c("test_files") >= 1) & (c("test_cmds") >= 1)),
         _cat(_s("test_files"), " test files, ", _s("test_cmds"), " test commands")),
        (5, "testing", c("test_cmds") >= 2, _cat(_s("test_cmds"), " test commands")),
        (6, "frontend", (c("frontend_files") >= 2) | ((c("frontend_files") >= 1) & (_share("frontend_files", "n_files") > 0.4)),
         _cat(_s("frontend_files"), "/", _s("n_files"), " frontend files")),
        (7, "config", (c("config_files") >= 2) | ((c("config_files") >= 1) & (_share("config_files", "n_files") > 0.5)),
         _cat(_s("config_files"), "/", _s("n_files"), " config files")),
        (8, "debugging", (c("error_turns") >= 2) & (edits >= 1), _cat(_s("error_turns"), " errors + ", _s("n_edit"), " edits")),
        (9, "commands", (c("n_bash") >= 3) & (edits <= 1), _cat(_s("n_bash"), " bash calls, ", _s("n_edit"), " edits")),
        (10, "exploration", (search >= 4) & (edits + writes <= 1),
         _cat(search.cast("string"), " search/read, ", _s("n_edit"), " edits")),
        (11, "refactor", (edits >= 4) & (writes <= 1), _cat(_s("n_edit"), " edits, ", _s("n_write"), " writes")),
        (12, "code_edit", edits + writes >= 2, _cat(_s("n_edit"), " edits + ", _s("n_write"), " writes")),
        (13, "exploration", total >= 2, _cat("fallback (", _s("total"), " tool calls)")),
        (14, "compact", F.lit(True), _cat("fallback (", _s("n_turns"), " turns, ", _s("total"), " tools)")),
    ]


def classify(signals: DataFrame, key: str = "conv_id") -> DataFrame:
    """Signals -> ``key, label, rule, reason`` (plus the signal columns)."""
    rs = rules()
    label = rule = reason = None
    for num, lab, cond, why in rs:
        if label is None:
            label, rule, reason = F.when(cond, lab), F.when(cond, num), F.when(cond, why)
        else:
            label, rule, reason = label.when(cond, lab), rule.when(cond, num), reason.when(cond, why)
    return signals.withColumn("label", label).withColumn("rule", rule.cast("bigint")).withColumn("reason", reason)
