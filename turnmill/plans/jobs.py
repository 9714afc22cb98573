"""Multi-operator jobs (the user-level pipelines).

Each job is one Spark lineage; tables that several reports read (labels,
signals) are written once instead of being recomputed per report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
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
from ..session import apply_defaults, cut_lineage, read_version, store, write_version
from ..sources import tables, traces


def convert_traces(events: DataFrame, spark: SparkSession, key: str = "conv_id", include_thinking: bool = True,
                   min_messages: int = fixed.MIN_MESSAGES, max_length: int = fixed.MAX_LENGTH, rules=None,
                   template: str = fixed.PROMPT_TEMPLATE, empty_below: int = fixed.EMPTY_BELOW):
    """Parsed events, or ``stored_events`` of them -> (conversations,
    dispositions, prompts).

    Conversations are long-form ``key, turn, role, text`` with the system
    prompt as turn 0; events are keyed by ``key`` (the session path). A
    session whose every line is bad has the disposition ``parse_error``.
    Parsed events are rendered and stored once; all else reads that table."""
    if "blocks" in events.columns:
        events = ev_op.stored_events(events, include_thinking)
    prompts = cut_lineage(system_prompts(events, spark, key, rules, template))
    msgs = store(ev_op.message_turns(ev_op.merge_chunks(events, key), key), "messages")
    conv, disp = turns_op.build_conversations(msgs, key=key, min_messages=min_messages, max_length=max_length,
                                              empty_below=empty_below, rules=rules, prompts=prompts)
    return conv, disp.unionByName(unreadable(events, key)), prompts


def unreadable(events: DataFrame, key: str = "conv_id") -> DataFrame:
    """Dispositions of the sessions that hold no good line."""
    n = events.groupBy(key).agg(F.count_if(~F.col("bad")).alias("n_good"))
    zero = F.lit(0).cast("bigint")
    return n.where("n_good = 0").select(
        key, *[zero.alias(c) for c in ("n_messages", "n_turns", "total_chars", "body_chars")],
        F.lit(None).cast("string").alias("pair_hash"), F.lit("parse_error").alias("disposition"))


def system_prompts(events: DataFrame, spark: SparkSession, key: str = "conv_id", rules=None,
                   template: str = fixed.PROMPT_TEMPLATE) -> DataFrame:
    """Parsed events -> ``key, prompt``, from one narrow aggregate (no
    message is rendered for it)."""
    return render.system_prompt(ev_op.conversation_metadata(events, key), key, rules=rules, template=template)


def build_dataset(spark: SparkSession, root: str, out: str, include_thinking: bool = True,
                  include_subagents: bool = False, min_messages: int = fixed.MIN_MESSAGES,
                  max_length: int = fixed.MAX_LENGTH, rules=None, marker: str = fixed.SEGMENT_MARKER) -> dict:
    """Session logs under ``root`` -> converted and segmented tables under
    ``out`` (Parquet; long form), the segments in the edge format, and the
    reports: what became of every session (``dispositions``) with its bad
    lines and lost chunks (``line_report``), dataset statistics, split
    ledger, length distribution and fit table."""
    apply_defaults(spark)
    seen = Observation("lines")
    events = ev_op.stored_events(traces.read_events(spark, root, include_subagents).withColumnRenamed("path", "conv_id"),
                                 include_thinking, seen)
    conv, disp, _ = convert_traces(events, spark, min_messages=min_messages, max_length=max_length, rules=rules)
    paths = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{out}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    saved, ledger = save("conversations", conv), save("dispositions", disp)
    save("disposition_ledger", turns_op.disposition_ledger(ledger))
    save("line_report", line_report(events))
    segs = save("segments", seg.split_segments(saved, marker=marker))
    # Edge format: one {"conversations": [{"from", "value"}, ...]} line per
    # segment, UTF-8 as is.
    seg_rows = segs.withColumn("conv_id", F.concat_ws("#", F.col("conv_id"), F.col("segment").cast("string")))
    save("line_counts", spark.createDataFrame([(seen.get["n_lines"], seen.get["n_bad"])], "n_lines BIGINT, n_bad BIGINT"))
    paths["segments_jsonl"] = f"{out}/segments_jsonl"
    traces.write_jsonl(tables.to_sharegpt(seg_rows).select("conversations"), paths["segments_jsonl"])
    lengths = save("segment_lengths", seg.segment_lengths(segs))
    save("statistics", rep.dataset_stats(saved))
    save("split_ledger", seg.segment_ledger(saved, segs))
    save("length_distribution", seg.rank_statistics(lengths, "n_chars"))
    save("fit_under_limit", seg.fit_under_limits(lengths))
    return paths


def line_report(events: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per session: lines, bad lines, and streamed chunks that were lost in
    the merge (content of another kind than their message's first). Reads
    narrow columns only."""
    lines = events.groupBy(key).agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("bad").alias("n_bad"))
    lost = ev_op.with_epochs(events, key).groupBy(key).agg(F.count_if(~F.col("contributes")).alias("n_lost"))
    return lines.join(lost, key, "left").withColumn("n_lost", F.coalesce("n_lost", F.lit(0)))


def label_conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Signals + cascade, one row per conversation."""
    return classify_op.classify(sig.conversation_signals(turns, key), key)


def build_experts(spark: SparkSession, turns: DataFrame, out: str, min_examples: int = fixed.MIN_EXPERT_EXAMPLES,
                  min_count: int = fixed.ROUTER_MIN_COUNT, key: str = "conv_id", balance: bool = False,
                  max_chars: int = fixed.ROUTER_MAX_CHARS, previous: str | None = None) -> dict:
    """Classify once, write labels, per-label conversation sets (one
    directory per label, one conversation a line, one pass), router examples
    with ids and split (on request as many per label as the rarest has, and
    cut to ``max_chars``), the label map and the expert manifest, in versions.
    Labels that the manifest at ``previous`` has as ``done`` are not trained again."""
    labels = label_conversations(turns, key)
    labels.write.mode("overwrite").parquet(f"{out}/labels")
    labels = spark.read.parquet(f"{out}/labels")
    lines = tables.to_sharegpt(turns, key).join(labels.select(key, "label"), key, "inner")
    traces.write_partitioned(lines.select("conversations", "label"), f"{out}/experts", by="label")
    examples = rt.router_examples(labels, rt.router_inputs(turns, key, max_chars=max_chars), key)
    kept, removed = rt.apply_min_count(examples, min_count)
    if balance:
        kept = rt.balance(kept, key)
    mapping = rt.label_map(kept)
    mapping.write.mode("overwrite").json(f"{out}/label_map")
    rt.stratified_split(rt.encode(kept, mapping), key).write.mode("overwrite").parquet(f"{out}/router_examples")
    # The classified router data as JSON lines of {"input", "label"}.
    traces.write_jsonl(kept.select("input", "label"), f"{out}/router_training_data")
    earlier = None if previous is None else read_version(spark, previous)
    write_version(rt.expert_manifest(labels, min_examples, earlier), f"{out}/manifest")
    return {"labels": f"{out}/labels", "experts": f"{out}/experts", "label_map": f"{out}/label_map",
            "router_examples": f"{out}/router_examples", "router_training_data": f"{out}/router_training_data",
            "manifest": f"{out}/manifest"}


def finish_experts(spark: SparkSession, manifest: str, results: DataFrame) -> str:
    """Next version of the manifest, after training: ``results(label, ok)``
    turns the labels to train into ``done`` or ``failed``; the rest stay as
    they were. Readers see the version before until this one is committed."""
    return write_version(settled(read_version(spark, manifest), results), manifest)


def settled(manifest: DataFrame, results: DataFrame) -> DataFrame:
    status = F.when((F.col("status") == "train") & F.col("ok"), "done").when(
        (F.col("status") == "train") & ~F.col("ok"), "failed").otherwise(F.col("status"))
    return manifest.join(results.select("label", "ok"), "label", "left").select("label", "rows", status.alias("status"))


def evaluate(labels: DataFrame, predictions: DataFrame, mapping: DataFrame, inputs: DataFrame | None = None,
             key: str = "conv_id") -> dict:
    """Router evaluation against the rule labels: examples whose label is in
    the mapping (and, given ``inputs``, that have an eligible input) paired
    with ``predictions(key, predicted)`` -> accuracy, per-class recall and
    the top confusions."""
    truth = labels.select(key, "label")
    if inputs is not None:
        truth = truth.join(inputs.where(F.col("input").isNotNull()).select(key), key, "left_semi")
    pairs = ev.eval_pairs(truth, predictions, mapping, key)
    return {"accuracy": ev.accuracy(pairs), "per_class": ev.per_class(pairs), "confusions": ev.confusions(pairs)}


def analyze(spark: SparkSession, turns: DataFrame, key: str = "conv_id") -> dict:
    """Label distribution report with examples (the analyze-only path)."""
    labels = label_conversations(turns, key)
    dist = rep.label_distribution(labels, rep.categories_table(spark))
    return {"distribution": dist, "smallest": rep.smallest_class(dist),
            "examples": rep.label_examples(labels, turns, key)}


def build_training_text(turns: DataFrame, seq_length: int = 8192, eval_fraction: float = fixed.EVAL_FRACTION,
                        seed: int = fixed.SPLIT_SEED, key: str = "conv_id") -> DataFrame:
    """Validity -> length budget -> chat text of the kept -> train/eval split."""
    fit = prep.within_budget(prep.chat_lengths(turns, key), seq_length)
    return prep.train_eval_split(prep.chat_text(turns, key, only=fit), key, eval_fraction, seed)
