"""Turn building: run collapse, alternation repair, dispositions, dedup.

Equivalence used (see the survey's note on the two-pass builder): the
original builder is the same as "strip each message text, drop blank
ones, merge neighbours of equal role with a blank line, drop the runs
before the first human run, drop a final human run". That form is a
gaps-and-islands problem, solved without any window over a whole
conversation (a conversation may hold a third of all rows):

* narrow rows (no text) are windowed per (conversation, chunk of
  ``CHUNK_ROWS`` turns): local ``lag`` and running sums of role changes;
* one summary row per chunk (first role, last role, internal changes)
  gives each chunk's run offset through a small window over chunks;
* head/tail trim works on the same narrow rows, as a partial aggregate
  joined back; kept runs are contiguous, so renumbering is arithmetic;
* the text of the runs that are kept meets them in one exchange by
  (conversation, chunk) and is put together there (``gather``).

Deduplication groups by the content hash with partial aggregation
(``min(conv_id)`` per hash), so a hash shared by a third of all rows
costs one row per map task, not one giant sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import fold_replace, is_blank, length64, ordered_join, py_strip
from ..session import cut_lineage, store, store_bucketed
from .gather import gather
from .prefix import CHUNK_ROWS

SYS, HUMAN, GPT = fixed.ROLE_SYSTEM, fixed.ROLE_HUMAN, fixed.ROLE_GPT


def run_ids(turns: DataFrame, key: str = "conv_id", order: str = "turn", chunk_rows: int | None = None) -> DataFrame:
    """Narrow rows ``key, chunk, at, role, run, spans`` of the message
    turns (human/gpt, not blank; ``at`` is the turn's number): run ids 1, 2, ... of equal neighbours, and
    whether the run reaches into several chunks. Turns of one number and
    role are one row; no text is carried."""
    chunk_rows = chunk_rows or CHUNK_ROWS
    m = turns.where(F.col("role").isin(HUMAN, GPT) & ~is_blank("text"))
    m = m.select(key, F.floor(F.col(order) / chunk_rows).cast("bigint").alias("chunk"), F.col(order).alias("at"), "role").distinct()
    w = Window.partitionBy(key, "chunk").orderBy("at", "role")
    m = m.withColumn("_lrn", F.row_number().over(w)).withColumn("_prev", F.lag("role").over(w))
    m = m.withColumn("_chg", F.when((F.col("_lrn") > 1) & (F.col("_prev") != F.col("role")), 1).otherwise(0))
    m = m.withColumn("_lchg", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # One row per chunk: how it starts, how it ends, changes inside it.
    cs = m.groupBy(key, "chunk").agg(
        F.min(F.when(F.col("_lrn") == 1, F.col("role"))).alias("_first_role"),
        F.max_by("role", "_lrn").alias("_last_role"),
        F.sum("_chg").alias("_inner"),
    )
    wk = Window.partitionBy(key).orderBy("chunk")
    prev_last, next_first = F.lag("_last_role").over(wk), F.lead("_first_role").over(wk)
    cs = cs.withColumn("_goes_on", F.coalesce(prev_last == F.col("_first_role"), F.lit(False))).withColumn(
        "_open_end", F.coalesce(next_first == F.col("_last_role"), F.lit(False)))
    cs = cs.withColumn("_first_chg", F.when(F.col("_goes_on"), 0).otherwise(1))
    cs = cs.withColumn("_off", F.coalesce(
        F.sum(F.col("_first_chg") + F.col("_inner")).over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    m = m.join(cs.select(key, "chunk", "_off", "_first_chg", "_inner", "_goes_on", "_open_end"), [key, "chunk"], "inner")
    # The first run of a chunk may come from the one before, the last go on in the next.
    spans = (F.col("_goes_on") & (F.col("_lchg") == 0)) | (F.col("_open_end") & (F.col("_lchg") == F.col("_inner")))
    return m.select(key, "chunk", "at", "role", (F.col("_off") + F.col("_first_chg") + F.col("_lchg")).cast("bigint").alias("run"), spans.alias("spans"))


def run_text(turns: DataFrame, runs: DataFrame, key: str = "conv_id", order: str = "turn",
             sep: str = fixed.PART_SEP, chunk_rows: int | None = None) -> DataFrame:
    """The runs of ``run_ids`` (some or all, with further columns that are
    equal within a run) with their text: one row per run with ``text,
    first_turn, n_parts`` and ``chunk``, the first one's."""
    chunk_rows = chunk_rows or CHUNK_ROWS
    text = turns.where(F.col("role").isin(HUMAN, GPT)).select(
        key, F.floor(F.col(order) / chunk_rows).cast("bigint").alias("chunk"), F.col(order).alias("at"), "role", py_strip("text").alias("text"))
    more = [c for c in runs.columns if c not in (key, "chunk", "at", "role", "spans")]
    first = F.min("chunk").alias("first_chunk")
    return gather(
        text.where(~is_blank("text")), runs, [key, "chunk"], ["at", "role"], [key, "role", *more],
        {"text": ordered_join("text", "at", sep), "first_turn": F.min("at"), "n_parts": F.count(F.lit(1)), "first_chunk": first},
        {"text": ordered_join("text", "first_turn", sep), "first_turn": F.min("first_turn"), "n_parts": F.sum("n_parts"),
         "first_chunk": F.min("first_chunk")})


def collapse_runs(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                  sep: str = fixed.PART_SEP, chunk_rows: int | None = None) -> DataFrame:
    """Message turns (human/gpt) -> runs of equal role.

    Output: ``key, run, role, text, first_turn, n_parts``. Run ids are
    1, 2, ... in conversation order.
    """
    runs = run_ids(turns, key, order, chunk_rows)
    return run_text(turns, runs, key, order, sep, chunk_rows).select(key, "run", "role", "text", "first_turn", "n_parts")


def repair_alternation(runs: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows with ``run`` and ``role``, with or without their text: drop runs before the first human run and a final human run; number
    the kept runs 1..n as ``turn``. Runs already alternate, so the result
    is human, gpt, human, ..., gpt; the kept run ids are contiguous, so
    ``turn = run - first_human_run + 1``."""
    b = runs.groupBy(key).agg(
        F.min(F.when(F.col("role") == HUMAN, F.col("run"))).alias("_first_h"), F.max("run").alias("_last"))
    r = runs.join(b, key, "inner")
    kept = r.where((F.col("run") >= F.col("_first_h")) & ~((F.col("run") == F.col("_last")) & (F.col("role") == HUMAN)))
    return kept.withColumn("turn", (F.col("run") - F.col("_first_h") + 1).cast("bigint")).drop("_first_h", "_last")


def conversation_base(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Per conversation: messages, position of the first turn, and its
    characters if it is a system turn (the only position where a system
    turn counts as one). A narrow partial aggregate."""
    b = turns.groupBy(key).agg(
        F.count_if(F.col("role") != SYS).alias("n_messages"),
        F.min(order).alias("first_turn"),
        F.min_by(F.struct("role", length64("text").alias("n")), order).alias("_f"),
    )
    return b.select(key, "n_messages", "first_turn", F.when(F.col("_f.role") == SYS, F.coalesce("_f.n", F.lit(0))).alias("system_chars"))


def conversation_summary(base: DataFrame, kept: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per input conversation with everything the filters need:
    message count, kept runs, characters (with / without the system turn)
    and the first-pair content hash. ``kept`` has ``turn, role, n_chars,
    digest``."""
    k = kept.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sum("n_chars").alias("body_chars"),
        F.min_by("digest", F.when(F.col("role") == HUMAN, F.col("turn"))).alias("_h"),
        F.min_by("digest", F.when(F.col("role") == GPT, F.col("turn"))).alias("_g"),
    )
    s = base.join(k, key, "left")
    return s.select(
        key,
        "n_messages",
        F.coalesce("n_turns", F.lit(0)).cast("bigint").alias("n_turns"),
        F.coalesce("body_chars", F.lit(0)).cast("bigint").alias("body_chars"),
        (F.coalesce("body_chars", F.lit(0)) + F.coalesce("system_chars", F.lit(0))).cast("bigint").alias("total_chars"),
        pair_hash(F.col("_h"), F.col("_g")).alias("pair_hash"),
    )


def pair_hash(first_human_md5, first_gpt_md5):
    """Content key of a conversation: the digests of its first human and
    first gpt turn (system excluded), each of fixed length, so different
    pairs can't meet in one key."""
    return F.concat(first_human_md5, first_gpt_md5)


def dispositions(summary: DataFrame, key: str = "conv_id", min_messages: int = fixed.MIN_MESSAGES,
                 max_length: int = fixed.MAX_LENGTH, empty_below: int = fixed.EMPTY_BELOW) -> DataFrame:
    """Disposition per conversation, in the original order of the checks:
    too_short (too few messages, or not human+gpt after repair), too_long
    (all characters incl. system), empty (non-system characters), then
    duplicate (same first pair as a smaller key), else ok."""
    pre = F.when(F.col("n_messages") < min_messages, "too_short") \
        .when(F.col("n_turns") < 2, "too_short") \
        .when(F.col("total_chars") > max_length, "too_long") \
        .when(F.col("body_chars") < empty_below, "empty")
    s = summary.withColumn("_pre", pre)
    out = [key, "n_messages", "n_turns", "total_chars", "body_chars", "pair_hash"]
    # Only conversations that pass so far have a pair to compare; the rest
    # (with a NULL key, many of them) stay out of the join.
    judged = s.where(F.col("_pre").isNotNull()).select(*out, F.col("_pre").alias("disposition"))
    fit = s.where(F.col("_pre").isNull())
    # Partial aggregation per hash: the first key of each content class.
    firsts = fit.groupBy("pair_hash").agg(F.min(key).alias("_first"))
    # One row per distinct hash: grows with the data, so a shuffle join.
    disp = F.when(F.col(key) == F.col("_first"), "ok").otherwise("duplicate")
    return judged.unionByName(fit.join(firsts, "pair_hash", "left").select(*out, disp.alias("disposition")))


def disposition_ledger(disp: DataFrame) -> DataFrame:
    return disp.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


def build_conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                        min_messages: int = fixed.MIN_MESSAGES, max_length: int = fixed.MAX_LENGTH,
                        empty_below: int = fixed.EMPTY_BELOW, sep: str = fixed.PART_SEP, rules=None,
                        prompts: DataFrame | None = None, chunk_rows: int | None = None):
    """Turns -> (clean conversations, per-conversation dispositions).

    Clean conversations: the system turn (turn 0) plus the repaired runs,
    for conversations whose disposition is ``ok``. The system turn is the
    first turn if that is one, or the conversation's row of ``prompts``
    (``key, prompt``), which then lists the conversations. ``rules`` are
    literal path replacements applied to the repaired non-system turns
    (before lengths and the content hash are taken, as in the original).
    Run ids come from narrow rows; the kept runs' text meets them once and is
    stored with its length and digest, in buckets of (key, chunk). The
    dispositions read the narrow columns of that table, and the clean
    conversations read it by the buckets, without an exchange.
    """
    # Read twice by the repair; the turns' text is looked at once for it.
    kept = repair_alternation(store(run_ids(turns, key, order, chunk_rows), "run-ids"), key)
    runs = run_text(turns, kept, key, order, sep, chunk_rows)
    text = fold_replace("text", rules) if rules else F.col("text")
    runs = runs.select(key, F.col("first_chunk").alias("chunk"), "turn", "role", text.alias("text"))
    runs = store_bucketed(runs.withColumns({"n_chars": length64("text"), "digest": F.md5("text")}), "runs", key, "chunk")

    base = conversation_base(turns, key, order)
    if prompts is not None:
        base = prompts.select(key, length64("prompt").alias("system_chars")).join(
            base.select(key, "n_messages", "first_turn"), key, "left").withColumn("n_messages", F.coalesce("n_messages", F.lit(0)))
    disp = cut_lineage(dispositions(conversation_summary(base, runs, key), key, min_messages, max_length, empty_below))
    ok = disp.where(F.col("disposition") == "ok").select(key)
    if prompts is not None:
        head = prompts.join(ok, key, "left_semi").select(
            key, F.lit(0).cast("bigint").alias("turn"), F.lit(SYS).alias("role"), F.col("prompt").alias("text"))
    else:
        first = base.where("system_chars is not null").join(ok, key, "left_semi").select(key, F.col("first_turn").alias(order))
        head = turns.where(F.col("role") == SYS).join(first, [key, order], "left_semi").select(
            key, F.lit(0).cast("bigint").alias("turn"), "role", "text")
    at = runs.select(key, "chunk").distinct().join(ok, key, "left_semi")
    return head.unionByName(runs.join(at, [key, "chunk"], "left_semi").select(key, "turn", "role", "text")), disp
