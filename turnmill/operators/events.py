"""Event-level operators: chunk merge, metadata, tools per conversation.

Plan: blocks are parsed and rendered once, where the event is scanned, and
stored with the event (``stored_events``); every later step reads the few
columns it uses. Epochs, message groups and message numbers are worked out
on narrow keys: epochs are counted per (conversation, chunk of the file) and
shifted by the chunks before, messages are grouped by (conversation, epoch,
message key), so a hot session spreads over tasks. The text meets its
message once, by (conversation, chunk) (``gather``). Metadata and tools are
one narrow partial aggregate.

Merge semantics (streamed assistant chunks):

* an assistant event's key is ``message.id``, else ``requestId``;
* chunks with the same key between two ``user`` events form one message
  (only user events flush; a key seen again after a user event starts a
  new message); other events and keyless assistant events pass through
  at their own position, i.e. before the keyed messages of their epoch;
* content lists are concatenated in file order if the first chunk's
  content is a list (or missing); if it is a string, later chunks add
  nothing; a later non-list chunk adds nothing;
* the message keeps the last non-empty ``usage`` and the last ``uuid``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed
from ..functions.text import ordered_join
from ..session import store
from . import render
from .gather import gather
from .prefix import CHUNK_ROWS, chunked_row_number


META_FIELDS = ["cwd", "git_branch", "version", "model"]


def render_events(events: DataFrame, include_thinking: bool = True) -> DataFrame:
    """Map-side: every event with its rendered ``text`` (NULL without a part),
    ``n_parts`` and the ``tools`` it uses, in place of its content."""
    blocks = render.parsed_blocks(F.col("blocks"))
    x = events.withColumn("_b", F.when(F.col("kind") == "list", blocks))
    parts = F.filter(F.transform("_b", lambda b: render.render_block(b, include_thinking)), lambda p: p.isNotNull())
    x = x.withColumn("_p", F.when(F.col("kind") == "list", parts).when(
        (F.col("kind") == "text") & F.col("content").isNotNull(), F.array("content")).otherwise(F.array().cast("array<string>")))
    usage = F.when(F.col("usage") != "{}", F.col("usage"))
    return x.select(
        *[c for c in events.columns if c not in ("content", "blocks", "usage")], usage.alias("usage"),
        F.when(F.size("_p") > 0, F.array_join("_p", fixed.PART_SEP)).alias("text"), F.size("_p").cast("bigint").alias("n_parts"),
        F.coalesce(render.tool_names(F.col("_b")), F.array().cast("array<string>")).alias("tools"))


def stored_events(events: DataFrame, include_thinking: bool = True, seen: Observation | None = None) -> DataFrame:
    """Parsed events -> rendered events, written once. ``seen`` takes the
    number of lines and bad lines in that same pass."""
    if seen is not None:
        events = events.observe(seen, F.count(F.lit(1)).alias("n_lines"), F.count_if("bad").alias("n_bad"))
    return store(render_events(events, include_thinking), "events")


def _chunk_of(df: DataFrame) -> Column:
    """Chunk of the file order: the file block for scanned files (lines of
    one block are contiguous), else ``ord // CHUNK_ROWS``."""
    if isinstance(df.schema["ord"].dataType, StructType):
        return F.col("ord.blk")
    return F.floor(F.col("ord") / CHUNK_ROWS).cast("bigint")


def with_epochs(events: DataFrame, key: str = "conv_id") -> DataFrame:
    """Narrow rows of user and assistant events: ``key, chunk, ord, type,
    kind`` with their epoch (number of user events so far, inclusive),
    message key, ``msg_ord`` (first event of the message) and whether the
    event contributes to it.

    The running count is taken per (key, chunk) and shifted by the user
    events of the earlier chunks. ``_start`` is the chunk where the epoch
    began and ``_open`` whether it is the last that began there (only that
    one can reach into later chunks). The group windows partition by (key,
    epoch, message key); an event without a key is a group by itself."""
    mkey = F.when(F.col("type") == "assistant", F.coalesce(F.nullif(F.col("msg_id"), F.lit("")),
                                                          F.nullif(F.col("request_id"), F.lit(""))))
    ev = events.where(~F.col("bad") & F.col("type").isin("user", "assistant")).select(
        key, _chunk_of(events).alias("chunk"), "ord", "type", "kind", mkey.alias("mkey"))
    is_user = F.col("type") == "user"
    w = Window.partitionBy(key, "chunk").orderBy("ord")
    ev = ev.withColumn("_lep", F.sum(F.when(is_user, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cs = ev.groupBy(key, "chunk").agg(F.count_if(is_user).alias("_u"))
    wk = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    cs = cs.select(
        key, "chunk", "_u", F.coalesce(F.sum("_u").over(wk), F.lit(0)).alias("_off"),
        F.coalesce(F.last(F.when(F.col("_u") > 0, F.col("chunk")), ignorenulls=True).over(wk), F.lit(-1)).alias("_before"))
    ev = ev.join(cs, [key, "chunk"], "inner")
    here = F.col("_lep") > 0
    ev = ev.withColumn("epoch", F.col("_off") + F.col("_lep")).withColumn(
        "_start", F.when(here, F.col("chunk")).otherwise(F.col("_before"))).withColumn(
        "_open", ~here | (F.col("_lep") == F.col("_u"))).drop("_off", "_lep", "_u", "_before")
    ev = ev.withColumn("_alone", F.when(F.col("mkey").isNull(), F.col("ord")))
    g = Window.partitionBy(key, "epoch", "mkey", "_alone").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ev = ev.withColumn("_first_kind", F.first("kind").over(g)).withColumn("msg_ord", F.first("ord").over(g))
    first_is_list = F.col("_first_kind").isNull() | (F.col("_first_kind") == "list")
    contributes = (F.col("ord") == F.col("msg_ord")) | (first_is_list & (F.col("kind") == "list"))
    return ev.withColumn("contributes", F.coalesce(contributes, F.lit(False))).drop("_first_kind", "kind")


def message_numbers(epochs: DataFrame, key: str = "conv_id") -> DataFrame:
    """Narrow event rows -> ``key, msg_ord, seq, epoch, spans``, one row per
    message in emission order: by epoch; within it pass-through events (no
    key) at their position, then keyed messages by first position. Numbers
    are taken per stretch of that order that starts and ends with a file
    chunk, plus the counts of earlier stretches: epochs that lie within a
    chunk form one stretch; one that may reach further forms a stretch per
    class and chunk."""
    m = epochs.groupBy(key, "epoch", "mkey", "_alone", "msg_ord").agg(
        F.first("_start").alias("_start"), F.first("_open").alias("_open"), F.min("chunk").alias("_first"),
        (F.min("chunk") < F.max("chunk")).alias("spans"))
    cls = F.when(F.col("mkey").isNull(), 0).otherwise(1)
    only = lambda c: F.when(F.col("_open"), c)
    m = m.withColumn("_cls", cls).withColumn(
        "_stretch", F.struct("_start", "_open", only(cls).alias("c"), only(F.col("_first")).alias("k")))
    m = chunked_row_number(m, key, F.col("_stretch"), ["epoch", "_cls", "msg_ord"], "seq")
    return m.select(key, "msg_ord", "seq", "epoch", "spans")


def merge_chunks(events: DataFrame, key: str = "conv_id", include_thinking: bool = True) -> DataFrame:
    """Parsed events, or ``stored_events`` of them -> merged events, one row
    each, in emission order: ``key, seq, epoch, type, msg_role, has_message,
    text, n_parts, n_chunks, n_lost, usage, uuid``."""
    if "blocks" in events.columns:
        events = stored_events(events, include_thinking)
    # Several steps below read these narrow rows.
    ep = store(with_epochs(events, key), "epochs")
    groups = ep.select(key, "chunk", "ord", "msg_ord", "contributes").join(message_numbers(ep, key), [key, "msg_ord"], "inner")
    groups = groups.select(key, "chunk", "ord", "contributes", "spans", F.struct("seq", "epoch").alias("msg"))
    text = events.where(~F.col("bad") & F.col("type").isin("user", "assistant")).select(
        key, _chunk_of(events).alias("chunk"), "ord", "type", "msg_role", "has_message", "text", "n_parts", "usage", "uuid")
    last = lambda c, by: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(by)))
    first, sums = ("type", "msg_role", "has_message"), ("n_parts", "n_chunks", "n_lost")
    out = gather(
        text, groups, [key, "chunk"], ["ord"], [key, "msg"],
        {**{c: F.min_by(c, "ord") for c in first}, "text": ordered_join("CASE WHEN contributes THEN text END", "ord", fixed.PART_SEP),
         "n_parts": F.sum(F.when(F.col("contributes"), F.col("n_parts")).otherwise(0)), "n_chunks": F.count(F.lit(1)),
         "n_lost": F.count_if(~F.col("contributes")), "usage": last("usage", "ord"), "uuid": last("uuid", "ord")},
        {**{c: F.min_by(c, "chunk") for c in first}, "text": ordered_join("text", "chunk", fixed.PART_SEP),
         **{c: F.sum(c) for c in sums}, "usage": last("usage", "chunk"), "uuid": last("uuid", "chunk")})
    return out.select(key, "msg.seq", "msg.epoch", "type", "msg_role", "has_message", "text", "n_parts", "n_chunks", "n_lost", "usage", "uuid")


def message_turns(merged: DataFrame, key: str = "conv_id") -> DataFrame:
    """Merged events -> message turns ``key, turn, role, text``: user and
    assistant events with a message; the message role maps user -> human,
    assistant -> gpt (any other role is a message that renders no turn)."""
    m = merged.where(F.col("type").isin("user", "assistant") & F.col("has_message"))
    role = F.when(F.col("msg_role") == "user", F.lit(fixed.ROLE_HUMAN)).when(
        F.col("msg_role") == "assistant", F.lit(fixed.ROLE_GPT)).otherwise(F.lit("other"))
    return m.select(key, F.col("seq").alias("turn"), role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _platform(cwd):
    cwd = F.coalesce(cwd, F.lit(""))
    win = cwd.contains("\\") | cwd.startswith("C:") | cwd.startswith("E:")
    return F.when(win, "win32").otherwise("linux")


def conversation_metadata(events: DataFrame, key: str = "conv_id", core=None) -> DataFrame:
    """One row per conversation, from parsed or stored events: first non-empty
    cwd, git branch, version and model in file order, the platform inferred
    from the working directory, and ``tools``: distinct tool names used plus
    the core tools, sorted. One narrow partial aggregate over the events."""
    core = core or fixed.CORE_TOOLS
    used = F.col("tools") if "tools" in events.columns else F.when(F.col("kind") == "list", render.tool_names(render.parsed_blocks(F.col("blocks"))))
    ev = events.where(~F.col("bad")).select(key, "ord", *META_FIELDS, F.explode_outer(used).alias("tool"))

    def first_set(c):
        return F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.col("ord")))

    m = ev.groupBy(key).agg(*[first_set(c).alias(c) for c in META_FIELDS], F.collect_set("tool").alias("_used"))
    tools = F.array_sort(F.array_union("_used", F.array(*[F.lit(c) for c in core])))
    return m.select(key, *META_FIELDS, _platform(F.col("cwd")).alias("platform"), tools.alias("tools"))
