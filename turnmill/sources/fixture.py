"""Coding-session traces derived from the driver's ``events`` table.

The driver ships no session logs, so every event becomes one turn of a
synthetic coding session (rules below). Everything is a narrow
projection plus one window by conversation; the work grows with
``events``.

Turn rules (``k`` = the integer in ``props``, ``persona = user_id % 10``):

* conversation ``conv_id = user_id * 1000 + floor((day(ts) - 1) / (1 + user_id % 4))``,
  turns ordered by ``(ts, event_id)`` from 1; turn 0 is the system turn;
* signup -> human ``Please handle task <event_id>``;
  error -> human tool result ``Error: step <k> failed``;
  view / click / purchase -> gpt: a think block of ``1 + k`` letters
  (``200 + k`` for persona 3), ``Working on it.``, and a tool call chosen
  by persona (see ``_tool``).

The same rows are also encoded as raw session-log lines (one JSON object
per line, streamed assistant chunks, a non-message line and broken lines)
so the whole ingest path runs on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import json_string
from ..operators.prefix import chunked_row_number
from .tables import load

HOME = "/home/dev"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _tool(persona, k):
    even = k % 2 == 0
    return (
        F.when(persona == 0, F.when((k % 5 == 0) | (k % 5 == 2), "Edit").when(k % 5 == 4, "Read").otherwise("Write"))
        .when(persona == 1, F.when(k % 3 == 0, "Grep").when(k % 3 == 1, "Glob").otherwise("Read"))
        .when(persona == 2, F.when(even, "Edit").otherwise("Bash"))
        .when(persona == 4, F.lit("Bash"))
        .when(persona.isin(5, 6, 7), F.when(k % 3 == 0, "Edit").when(k % 3 == 1, "Bash").otherwise("Read"))
        .when(persona == 8, F.lit("Edit"))
        .when((persona == 9) & (k % 4 == 0), F.lit("Edit"))
    )


def _file_path(persona, k):
    even = k % 2 == 0
    return (
        F.when(persona == 5, F.when(even, f"{HOME}/src/a.tsx").otherwise(f"{HOME}/web/b.css"))
        .when(persona == 6, F.when(even, f"{HOME}/ci/app.yaml").otherwise(f"{HOME}/pyproject.toml"))
        .when(persona == 7, F.when(even, f"{HOME}/pkg/tests/a.py").otherwise(f"{HOME}/pkg/m_test.go"))
        .otherwise(F.concat(F.lit(f"{HOME}/src/m"), k.cast("string"), F.lit(".py")))
    )


def event_rows(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One row per event with its conversation, turn and turn parts. Turns are
    numbered on a few numbers; all other columns follow from them later.
    ``dealt`` rows lie in as many partitions as the session shuffles into, for
    work that is heavy for the few bytes of a row."""
    e = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    conv = (F.col("user_id") * 1000 + F.floor((F.dayofmonth("ts") - 1) / (1 + F.col("user_id") % 4))).cast("bigint")
    kinds = F.array(*[F.lit(x) for x in EVENT_TYPES])
    e = e.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.array_position(kinds, F.col("event_type")).cast("tinyint").alias("kind"),
                 k.alias("k"), conv.alias("conv_id"))
    # Per hour plus earlier hours (operators.prefix).
    hour = F.floor(F.col("us") / 3_600_000_000).cast("bigint")
    e = chunked_row_number(e, "conv_id", hour, ["us", "event_id"], "turn")
    if dealt:
        e = e.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id", "turn")
    persona = F.floor(F.col("conv_id") / 1000) % 10
    e = e.withColumn("persona", persona).withColumn("path", session_path(F.col("conv_id"), F.col("persona"))).withColumn(
        "event_type", F.element_at(kinds, F.col("kind").cast("int")))
    human = F.col("event_type").isin("signup", "error")
    tool = F.when(~human, _tool(F.col("persona"), F.col("k")))
    return e.select(
        "conv_id", "path", "turn", "event_id", "event_type", "k", "persona",
        F.when(human, "human").otherwise("gpt").alias("role"),
        tool.alias("tool"),
        F.when(tool.isin("Edit", "Write", "Read"), _file_path(F.col("persona"), F.col("k"))).alias("file_path"),
        F.when(tool == "Bash", F.when(F.col("persona") == 7, "pytest -q").otherwise("git status")).alias("command"),
        F.when(tool.isin("Grep", "Glob"), F.concat(F.lit("x"), F.col("k").cast("string"))).alias("pattern"),
        F.when(F.col("persona") == 3, 200 + F.col("k")).otherwise(1 + F.col("k")).alias("think_len"),
    )


def _input_json():
    fp, cmd, pat = F.col("file_path"), F.col("command"), F.col("pattern")
    return (
        F.when(fp.isNotNull(), F.to_json(F.struct(fp.alias("file_path"))))
        .when(cmd.isNotNull(), F.to_json(F.struct(cmd.alias("command"))))
        .when(pat.isNotNull(), F.to_json(F.struct(pat.alias("pattern"))))
    )


def _call_text():
    return F.concat(
        F.lit('<tool_call>\n{"name": "'), F.col("tool"), F.lit('", "input": '), _input_json(), F.lit("}\n</tool_call>")
    )


def trace_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ShareGPT-dialect turns ``(conv_id, turn, role, text)``, system turn 0
    included, turns not collapsed (signals accept any order)."""
    r = event_rows(spark, sf_dir)
    human_text = F.when(
        F.col("event_type") == "signup", F.concat(F.lit("Please handle task "), F.col("event_id").cast("string"))
    ).otherwise(F.concat(F.lit("<tool_response>\nError: step "), F.col("k").cast("string"), F.lit(" failed\n</tool_response>")))
    gpt_text = F.concat(
        F.lit("<think>\n"), F.repeat(F.lit("x"), F.col("think_len").cast("int")), F.lit("\n</think>\n\nWorking on it."),
        F.when(F.col("tool").isNotNull(), F.concat(F.lit("\n\n"), _call_text())).otherwise(F.lit("")),
    )
    text = F.when(F.col("role") == "human", human_text).otherwise(gpt_text)
    system = F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("system").alias("role"),
                      F.concat(F.lit("system for "), F.col("conv_id").cast("string")).alias("text"))
    own = F.struct(F.col("turn"), F.col("role"), text.alias("text"))
    # The first turn of each conversation also emits the system turn.
    rows = F.when(F.col("turn") == 1, F.array(system, own)).otherwise(F.array(own))
    return r.select("conv_id", F.explode(rows).alias("t")).select("conv_id", "t.turn", "t.role", "t.text")


def session_path(conv_id, persona):
    return F.concat(F.lit("sessions/p"), persona.cast("string"), F.lit("/"), conv_id.cast("string"), F.lit(".jsonl"))


def trace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions as raw log lines ``(path, ord, value)``.

    Per conversation: a ``summary`` line first (not a message, does not
    flush streamed chunks), a broken line when ``conv_id % 5 = 0``, then
    one ``user`` line per human turn and two ``assistant`` chunk lines
    sharing one message id per gpt turn (thinking; then text + tool use).
    ``cwd`` is ``/home/dev/p<persona>`` (``E:\\work\\p9`` for persona 9),
    ``gitBranch`` is ``b<k>`` or ``HEAD`` when ``event_id % 10 = 0``, the
    first event carries an empty ``version``.
    """
    r = event_rows(spark, sf_dir, dealt=True)
    cwd = F.when(F.col("persona") == 9, F.lit("E:\\work\\p9")).otherwise(F.concat(F.lit(f"{HOME}/p"), F.col("persona").cast("string")))
    branch = F.when(F.col("event_id") % 10 == 0, F.lit("HEAD")).otherwise(F.concat(F.lit("b"), F.col("k").cast("string")))
    version = F.when(F.col("turn") == 1, F.lit("")).otherwise(F.concat(F.lit("2."), F.col("persona").cast("string"), F.lit("."), (F.col("k") % 3).cast("string")))
    model = F.concat(F.lit("model-"), (F.col("k") % 2).cast("string"))
    eid = F.col("event_id").cast("string")

    user_content = F.when(
        F.col("event_type") == "signup", json_string(F.concat(F.lit("Please handle task "), eid))
    ).otherwise(F.to_json(F.array(F.struct(
        F.lit("tool_result").alias("type"), F.concat(F.lit("t"), eid).alias("tool_use_id"),
        F.concat(F.lit("step "), F.col("k").cast("string"), F.lit(" failed")).alias("content"),
        F.lit(True).alias("is_error"),
    ))))

    think = F.to_json(F.array(F.struct(F.lit("thinking").alias("type"), F.repeat(F.lit("x"), F.col("think_len").cast("int")).alias("thinking"))))
    text_block = F.concat(F.lit('{"type":"text","text":"Working on it."}'))
    tool_block = F.concat(
        F.lit('{"type":"tool_use","id":"t'), eid, F.lit('","name":"'), F.col("tool"), F.lit('","input":'), _input_json(), F.lit("}")
    )
    chunk_b = F.concat(F.lit("["), text_block, F.when(F.col("tool").isNotNull(), F.concat(F.lit(","), tool_block)).otherwise(F.lit("")), F.lit("]"))

    def line(type_, extra, msg):
        return F.concat(
            F.lit('{"type":"'), F.lit(type_), F.lit('","uuid":"'), extra, F.lit('","cwd":'), json_string(cwd),
            F.lit(',"gitBranch":"'), branch, F.lit('","version":"'), version, F.lit('","message":'), msg, F.lit("}"),
        )

    user_line = line("user", F.concat(F.lit("u"), eid), F.concat(F.lit('{"role":"user","content":'), user_content, F.lit("}")))
    a_msg = F.concat(F.lit('{"id":"m'), eid, F.lit('","role":"assistant","model":"'), model, F.lit('","content":'))
    chunk_a_line = line("assistant", F.concat(F.lit("a"), eid), F.concat(a_msg, think, F.lit("}")))
    chunk_b_line = line("assistant", F.concat(F.lit("b"), eid), F.concat(
        a_msg, chunk_b, F.lit(',"usage":{"output_tokens":'), F.col("k").cast("string"), F.lit("}}")))

    summary = F.struct(F.lit(0).cast("bigint").alias("o"), F.lit('{"type":"summary","summary":"earlier work"}').alias("v"))
    broken = F.struct(F.lit(1).cast("bigint").alias("o"), F.lit('{"type": "user", broken').alias("v"))
    base = F.col("turn") * 2
    own = F.when(F.col("role") == "human", F.array(F.struct(base.alias("o"), user_line.alias("v")))).otherwise(
        F.array(F.struct(base.alias("o"), chunk_a_line.alias("v")), F.struct((base + 1).alias("o"), chunk_b_line.alias("v"))))
    # The first event of a session also emits the lines that open the file.
    lead = F.when(F.col("turn") == 1, F.when(F.col("conv_id") % 5 == 0, F.array(summary, broken)).otherwise(F.array(summary))
                  ).otherwise(F.array().cast("array<struct<o:bigint,v:string>>"))
    return r.select("path", F.explode(F.concat(lead, own)).alias("l")).select(
        "path", F.col("l.o").cast("bigint").alias("ord"), F.col("l.v").alias("value"))


def shifted_predictions(labeled: DataFrame, mapping: DataFrame, key: str = "conv_id", every: int = 7) -> DataFrame:
    """Deterministic stand-in for model output: the true label, except the
    next label id (cyclic) when ``key % every = 0``."""
    # The label count rides on the (<= 10-row) mapping itself.
    m = mapping.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    d = labeled.select(key, "label").join(m, "label", "inner")
    pid = F.when(F.col(key) % every == 0, (F.col("label_id") + 1) % F.col("_n")).otherwise(F.col("label_id"))
    d = d.withColumn("_pid", pid)
    inv = mapping.select(F.col("label_id").alias("_pid"), F.col("label").alias("predicted"))
    return d.join(inv, "_pid", "inner").select(key, "predicted")


DATASET_SCHEMA = "event_id BIGINT, kind STRING, note STRING"


def dataset_lines(events: DataFrame) -> DataFrame:
    """``file, event_id, value``: one JSON line per event; blank where
    ``event_id % 50 = 7``, cut off where it is 31."""
    eid = F.col("event_id")
    whole = F.concat(F.lit('{"event_id": '), eid.cast("string"), F.lit(', "kind": "'), F.col("event_type"), F.lit('", "note": "é'),
                     F.repeat(F.lit("x"), (eid % 37).cast("int")), F.lit('"}'))
    value = F.when(eid % 50 == 7, "").when(eid % 50 == 31, F.concat(F.lit('{"event_id": '), eid.cast("string"))).otherwise(whole)
    return events.select((F.col("user_id") % 10).alias("file"), "event_id", value.alias("value"))
