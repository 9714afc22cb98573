"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs a library operator over the whole driver tables (or data
Spark derives from them). Parameters that the data needs are stated
here once, e.g. the segment marker: the driver's conversations never
contain the real continuation sentence, so segmentation runs with the
marker ``thti``, a letter group that occurs in their text.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold_replace
from ..operators import classify as classify_op
from ..operators import evaluate as ev
from ..operators import events as ev_op
from ..operators import prepare as prep
from ..operators import render
from ..operators import reports as rep
from ..operators import router as rt
from ..operators import segments as seg
from ..operators import signals as sig
from ..operators import turns as turns_op
from ..session import cut_lineage, ensure_checkpoint_dir, read_version, write_version
from ..sources import fixture, tables, traces
from . import jobs

DATA_MARKER = "thti"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- segments

def _segments(spark, sf_dir):
    return seg.split_segments(tables.conversation_turns(spark, sf_dir), marker=DATA_MARKER)


@query("segment_turns")
def q_segment_turns(spark, sf_dir):
    return _segments(spark, sf_dir)


@query("segment_lengths")
def q_segment_lengths(spark, sf_dir):
    return seg.segment_lengths(_segments(spark, sf_dir))


@query("segment_ledger")
def q_segment_ledger(spark, sf_dir):
    turns = tables.conversation_turns(spark, sf_dir)
    return seg.segment_ledger(turns, seg.split_segments(turns, marker=DATA_MARKER))


@query("length_percentiles")
def q_length_percentiles(spark, sf_dir):
    return seg.rank_statistics(seg.segment_lengths(_segments(spark, sf_dir)), "n_chars")


@query("fit_under_limit")
def q_fit_under_limit(spark, sf_dir):
    return seg.fit_under_limits(seg.segment_lengths(_segments(spark, sf_dir)))


# ------------------------------------------------------------------- turns
# The driver's conversations alternate cleanly and have no blank text, so
# the turn operators run on a deterministic perturbation of all of them
# (see sources.tables): equal neighbours, blank texts, exact copies.

LEDGER_MIN_MESSAGES = 4
LEDGER_MAX_LENGTH = 4000


def _perturbed(spark, sf_dir):
    return tables.perturb_roles_and_blanks(tables.conversation_turns(spark, sf_dir))


def _runs(spark, sf_dir):
    return turns_op.collapse_runs(_perturbed(spark, sf_dir))


@query("turn_collapse")
def q_turn_collapse(spark, sf_dir):
    return _runs(spark, sf_dir).select("conv_id", "run", "role", "text", "first_turn", "n_parts")


@query("alternation_repair")
def q_alternation_repair(spark, sf_dir):
    return turns_op.repair_alternation(_runs(spark, sf_dir)).select("conv_id", "turn", "role", "text", "n_parts")


def _dispositions(spark, sf_dir):
    t = tables.with_copies(_perturbed(spark, sf_dir))
    _, disp = turns_op.build_conversations(t, min_messages=LEDGER_MIN_MESSAGES, max_length=LEDGER_MAX_LENGTH)
    return disp


@query("disposition_ledger")
def q_disposition_ledger(spark, sf_dir):
    return turns_op.disposition_ledger(_dispositions(spark, sf_dir))


@query("length_band")
def q_length_band(spark, sf_dir):
    return _dispositions(spark, sf_dir).select("conv_id", "n_messages", "n_turns", "total_chars", "body_chars", "disposition")


@query("dedup_first_pair")
def q_dedup_first_pair(spark, sf_dir):
    d = _dispositions(spark, sf_dir).where("disposition IN ('ok', 'duplicate')")
    return d.groupBy("pair_hash").agg(
        F.min("conv_id").alias("kept_conv_id"), F.count(F.lit(1)).alias("n_copies")
    ).drop("pair_hash")


@query("clean_conversations")
def q_clean_conversations(spark, sf_dir):
    t = tables.with_copies(_perturbed(spark, sf_dir))
    conv, _ = turns_op.build_conversations(t, min_messages=LEDGER_MIN_MESSAGES, max_length=LEDGER_MAX_LENGTH)
    return conv


# ---------------------------------------------------- signals and labels
# On the session traces derived from ``events`` (sources.fixture).

def _signals(spark, sf_dir):
    return sig.conversation_signals(fixture.trace_turns(spark, sf_dir))


def _labeled(spark, sf_dir):
    return classify_op.classify(_signals(spark, sf_dir))


@query("tool_calls")
def q_tool_calls(spark, sf_dir):
    return sig.tool_calls(fixture.trace_turns(spark, sf_dir))


@query("conversation_signals")
def q_conversation_signals(spark, sf_dir):
    return _signals(spark, sf_dir).select("conv_id", "n_turns", *sig.SIGNAL_COLUMNS, "total", "think_share")


@query("tool_error_turns")
def q_tool_error_turns(spark, sf_dir):
    return _signals(spark, sf_dir).select("conv_id", "error_turns", "n_calls", "total")


@query("thinking_share")
def q_thinking_share(spark, sf_dir):
    return _signals(spark, sf_dir).select("conv_id", "think_chars", "gpt_chars", "think_share")


@query("file_kind_counts")
def q_file_kind_counts(spark, sf_dir):
    return _signals(spark, sf_dir).select("conv_id", "n_files", "frontend_files", "config_files", "test_files")


@query("command_kind_counts")
def q_command_kind_counts(spark, sf_dir):
    return _signals(spark, sf_dir).select("conv_id", "n_cmds", "test_cmds", "git_cmds", "build_cmds")


@query("classify")
def q_classify(spark, sf_dir):
    return _labeled(spark, sf_dir).select("conv_id", "label", "rule")


@query("classify_reason")
def q_classify_reason(spark, sf_dir):
    return _labeled(spark, sf_dir).select("conv_id", "label", "reason")


@query("rule_counts")
def q_rule_counts(spark, sf_dir):
    return _labeled(spark, sf_dir).groupBy("rule", "label").agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- reports

@query("dataset_stats")
def q_dataset_stats(spark, sf_dir):
    return rep.dataset_stats(fixture.trace_turns(spark, sf_dir))


@query("label_distribution")
def q_label_distribution(spark, sf_dir):
    return rep.label_distribution(_labeled(spark, sf_dir), rep.categories_table(spark))


@query("smallest_class")
def q_smallest_class(spark, sf_dir):
    return rep.smallest_class(rep.label_distribution(_labeled(spark, sf_dir), rep.categories_table(spark)))


@query("first_human_preview")
def q_first_human_preview(spark, sf_dir):
    return rep.first_human_preview(fixture.trace_turns(spark, sf_dir))


@query("label_examples")
def q_label_examples(spark, sf_dir):
    return rep.label_examples(_labeled(spark, sf_dir), fixture.trace_turns(spark, sf_dir))


PREVIEW_CONVERSATIONS = 5


@query("preview")
def q_preview(spark, sf_dir):
    return rep.preview(tables.conversation_turns(spark, sf_dir), PREVIEW_CONVERSATIONS)


# ------------------------------------------------------------------ router

def _examples(spark, sf_dir):
    turns = fixture.trace_turns(spark, sf_dir)
    return cut_lineage(rt.router_examples(_labeled(spark, sf_dir), rt.router_inputs(turns)))


@query("router_inputs")
def q_router_inputs(spark, sf_dir):
    return rt.router_inputs(fixture.trace_turns(spark, sf_dir))


@query("router_skipped")
def q_router_skipped(spark, sf_dir):
    return rt.skipped_inputs(rt.router_inputs(fixture.trace_turns(spark, sf_dir)))


@query("router_examples")
def q_router_examples(spark, sf_dir):
    return _examples(spark, sf_dir)


@query("min_count_filter")
def q_min_count_filter(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    return rt.label_counts(kept)


@query("removed_labels")
def q_removed_labels(spark, sf_dir):
    _, removed = rt.apply_min_count(_examples(spark, sf_dir))
    return removed


@query("balanced_examples")
def q_balanced_examples(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    return rt.balance(kept).select("conv_id", "label")


@query("label_map")
def q_label_map(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    return rt.label_map(kept)


@query("encoded_examples")
def q_encoded_examples(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    return rt.encode(kept, rt.label_map(kept)).select("conv_id", "label", "label_id")


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    return rt.stratified_split(kept).select("conv_id", "label", "split")


@query("expert_manifest")
def q_expert_manifest(spark, sf_dir):
    return rt.expert_manifest(_labeled(spark, sf_dir))


# -------------------------------------------------------------- evaluation

def _pairs(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    mapping = rt.label_map(kept)
    preds = fixture.shifted_predictions(kept, mapping)
    return ev.eval_pairs(kept, preds, mapping)


@query("eval_accuracy")
def q_eval_accuracy(spark, sf_dir):
    return ev.accuracy(_pairs(spark, sf_dir))


@query("eval_per_class")
def q_eval_per_class(spark, sf_dir):
    return ev.per_class(_pairs(spark, sf_dir))


@query("eval_confusions")
def q_eval_confusions(spark, sf_dir):
    return ev.confusions(_pairs(spark, sf_dir))


@query("router_model_predictions")
def q_router_model_predictions(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    split = rt.stratified_split(kept)
    train = split.where("split = 'train'")
    test = split.where("split = 'test'")
    return ev.model_predictions(train, test).select("conv_id", "label", "predicted")


@query("router_bayes_predictions")
def q_router_bayes_predictions(spark, sf_dir):
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    t = cut_lineage(rt.tokenize(rt.stratified_split(kept), pad=False).select("conv_id", "label", "split", "tokens"))
    return ev.bayes_predictions(t.where("split = 'train'"), t.where("split = 'test'"))


@query("router_split_terms")
def q_router_split_terms(spark, sf_dir):
    """What the router model is fitted on and tried on: rows and terms by
    split and label."""
    kept, _ = rt.apply_min_count(_examples(spark, sf_dir))
    t = rt.tokenize(rt.stratified_split(kept), pad=False)
    return t.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_tokens").alias("n_terms"))


# ------------------------------------------------------- training text

SEQ_LENGTH = 1024  # tokens; the driver's conversations fall on both sides


def _budget(spark, sf_dir):
    return prep.within_budget(prep.chat_lengths(tables.conversation_turns(spark, sf_dir)), SEQ_LENGTH)


@query("chat_text")
def q_chat_text(spark, sf_dir):
    return prep.with_length(prep.chat_text(tables.conversation_turns(spark, sf_dir)))


@query("chat_validity")
def q_chat_validity(spark, sf_dir):
    return prep.validity_ledger(prep.chat_lengths(tables.conversation_turns(spark, sf_dir)))


@query("seq_budget")
def q_seq_budget(spark, sf_dir):
    return _budget(spark, sf_dir).select("conv_id", "n_chars")


@query("train_eval_split")
def q_train_eval_split(spark, sf_dir):
    return prep.train_eval_split(_budget(spark, sf_dir)).select("conv_id", "split")


@query("step_estimate")
def q_step_estimate(spark, sf_dir):
    return prep.step_estimate(prep.train_eval_split(_budget(spark, sf_dir)).where("split = 'train'"))


@query("pack_sequences")
def q_pack_sequences(spark, sf_dir):
    return prep.pack_sequences(_budget(spark, sf_dir), SEQ_LENGTH)


SANITIZE_RULES = [("/home/dev", "/home/user")]


@query("sanitize_text")
def q_sanitize_text(spark, sf_dir):
    t = tables.with_home_prefix(tables.conversation_turns(spark, sf_dir))
    return t.select("conv_id", "turn", fold_replace("text", SANITIZE_RULES).alias("text"))


# ------------------------------------------------------- raw session logs
# The fixture sessions encoded as raw log lines (sources.fixture) go
# through the full ingest: parse, chunk merge, metadata, rendering,
# prompt, turn building, sanitization, dedup.

TRACE_RULES = [("/home/dev", "/home/user")]


def _events(spark, sf_dir):
    return traces.parse_events(fixture.trace_lines(spark, sf_dir)).withColumnRenamed("path", "conv_id")


@query("trace_line_ledger")
def q_trace_line_ledger(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("bad").alias("n_bad"),
        F.count_if(~F.col("bad") & F.col("type").isin("user", "assistant")).alias("n_message_lines"))


@query("chunk_merge")
def q_chunk_merge(spark, sf_dir):
    m = ev_op.merge_chunks(_events(spark, sf_dir))
    m = m.where(F.col("type").isin("user", "assistant") & F.col("has_message"))
    return m.select("conv_id", "seq", "type", "msg_role", "n_chunks", "text")


@query("usage_carry")
def q_usage_carry(spark, sf_dir):
    m = ev_op.merge_chunks(_events(spark, sf_dir))
    return m.where(F.col("type") == "assistant").select("conv_id", "seq", "usage", "uuid")


@query("line_report")
def q_line_report(spark, sf_dir):
    return jobs.line_report(ev_op.stored_events(_events(spark, sf_dir)))


@query("conv_metadata")
def q_conv_metadata(spark, sf_dir):
    return ev_op.conversation_metadata(_events(spark, sf_dir)).drop("tools")


@query("tools_per_conversation")
def q_tools_per_conversation(spark, sf_dir):
    t = ev_op.conversation_metadata(_events(spark, sf_dir))
    return t.select("conv_id", F.array_join("tools", ",").alias("tools"))


@query("tool_coverage")
def q_tool_coverage(spark, sf_dir):
    return rep.tool_coverage(ev_op.conversation_metadata(_events(spark, sf_dir)), render.catalog_table(spark))


@query("prompt_tool_section")
def q_prompt_tool_section(spark, sf_dir):
    return render.tool_section(ev_op.conversation_metadata(_events(spark, sf_dir)))


@query("system_prompt")
def q_system_prompt(spark, sf_dir):
    return jobs.system_prompts(_events(spark, sf_dir), spark, rules=TRACE_RULES)


@query("trace_conversations")
def q_trace_conversations(spark, sf_dir):
    conv, _, _ = jobs.convert_traces(_events(spark, sf_dir), spark, rules=TRACE_RULES)
    return conv


@query("trace_ledger")
def q_trace_ledger(spark, sf_dir):
    _, disp, _ = jobs.convert_traces(_events(spark, sf_dir), spark, rules=TRACE_RULES)
    return turns_op.disposition_ledger(disp)


@query("thinking_off")
def q_thinking_off(spark, sf_dir):
    """The conversion with thinking blocks left out."""
    conv, _, _ = jobs.convert_traces(_events(spark, sf_dir), spark, include_thinking=False, rules=TRACE_RULES)
    return conv


@query("output_accounting")
def q_output_accounting(spark, sf_dir):
    return rep.output_accounting(fixture.trace_turns(spark, sf_dir), _labeled(spark, sf_dir))


ROUTER_MAX_TOKENS = 8  # short enough that the driver's inputs get cut and padded


@query("router_tokens")
def q_router_tokens(spark, sf_dir):
    t = rt.tokenize(_examples(spark, sf_dir), ROUTER_MAX_TOKENS)
    return t.select("conv_id", "n_tokens", "truncated", F.array_join("tokens", " ").alias("tokens"))


TRACE_SEGMENT_MARKER = "task 1"  # occurs in the sessions' human turns


@query("trace_segments")
def q_trace_segments(spark, sf_dir):
    """The dataset job's two steps on the derived logs: convert, then split
    at a marker; one row per segment with its size."""
    conv, _, _ = jobs.convert_traces(_events(spark, sf_dir), spark, rules=TRACE_RULES)
    return seg.segment_lengths(seg.split_segments(conv, marker=TRACE_SEGMENT_MARKER))


# ------------------------------------------------------------------- files
# Files that a job writes, or a reader scans, in the checkpoint folder.

def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


BLOCK_BYTES = 65536  # small, so that the files below are scanned in many blocks


def _dataset_files(spark, sf_dir):
    """``events`` as JSON-lines files, one per last digit of the user id, some
    lines blank or cut off; scanned in small blocks."""
    e = tables.load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    path = _scratch(spark, "logs")
    fixture.dataset_lines(e).repartition("file").sortWithinPartitions("file", "event_id").select("file", "value").write.partitionBy("file").text(path)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, BLOCK_BYTES)
    try:  # the scan runs here, as it is stored
        return traces.dataset_rows(spark, path, fixture.DATASET_SCHEMA)
    finally:
        spark.conf.set(setting, before)


def _file_of(path):
    return F.regexp_extract(path, "file=([0-9]+)", 1).cast("bigint").alias("file")


@query("log_line_addresses")
def q_log_line_addresses(spark, sf_dir):
    """Byte address of every line, from a scan of many blocks."""
    rows = _dataset_files(spark, sf_dir)
    at = traces.line_addresses(rows).join(rows.select("path", "ord", "n_bytes", F.coalesce("r.event_id", F.lit(-1)).alias("event_id")), ["path", "ord"])
    return at.select(_file_of(F.col("path")), "address", "n_bytes", "event_id")


@query("strict_faults")
def q_strict_faults(spark, sf_dir):
    """What a strict read of these files would name."""
    return traces.faults(_dataset_files(spark, sf_dir)).select(_file_of(F.col("path")), "address", "cause")


@query("expert_files")
def q_expert_files(spark, sf_dir):
    """The per-label sets as read back from their files."""
    labels = _labeled(spark, sf_dir)
    lines = tables.to_sharegpt(fixture.trace_turns(spark, sf_dir)).join(labels.select("conv_id", "label"), "conv_id", "inner")
    path = _scratch(spark, "experts")
    traces.write_partitioned(lines.select("conversations", "label"), path)
    back = spark.read.schema("conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>, label STRING").json(path)
    size = F.aggregate("conversations", F.lit(0).cast("bigint"), lambda n, t: n + F.length(t["value"]))
    return back.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("conversations")).cast("bigint").alias("n_turns"), F.sum(size).alias("n_chars"))


@query("manifest_status")
def q_manifest_status(spark, sf_dir):
    """Two versions of the manifest: every other label trained with success."""
    root = _scratch(spark, "manifest")
    write_version(rt.expert_manifest(_labeled(spark, sf_dir)), root)
    m = read_version(spark, root)
    jobs.finish_experts(spark, root, m.select("label", (F.length("label") % 2 == 0).alias("ok")))
    return read_version(spark, root)
