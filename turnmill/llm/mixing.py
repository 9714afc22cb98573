"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed per (source, language, topic). Raking finds
factors a(source) * b(language) * c(topic) such that the weighted table
has the target margins. Sources may be many (hosts), so their factors
stay distributed: one row per source holds its (language, topic) cells,
and given b and c its own factor is local to the row. Each round is one
narrow aggregate that returns the weighted language x topic table, a few
dozen cells, from which b and c are scaled in turn. Documents are then
drawn with probability proportional to the factor of their cell, the
largest factor being certain, so expected kept tokens stand in the
target proportions.

DataFrame functions only. The per-source table is a partial aggregate;
it is written, so the join back to documents is a broadcast if its file
size is under the session's threshold and a shuffled, skew-split join
otherwise.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import text_key, unwrapped, wrapped, written

# A margin's target shares are its observed token shares to this power,
# rescaled: below 1 flattens the margin.
POWERS = {"source": 0.9, "lang": 0.9, "topic": 0.98}
# First rule that matches names the topic.
TOPICS = [
    ("licence", ["License", "license", "Copyright"]),
    ("contact", ["@"]),
    ("listing", [" | "]),
]
OTHER = "prose"
TOLERANCE = 1e-10
ROUNDS = 100
SEED = "mix-1"


def topic_of(text: str) -> Column:
    """Topic by the marks a text holds anywhere; ``prose`` without one and
    for a null text."""
    c = F.when(F.col(text).isNull(), OTHER)
    for name, marks in TOPICS:
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.col(text).contains(m)
        c = c.when(hit, name)
    return c.otherwise(OTHER)


def category(col) -> Column:
    """A margin's value as text, with null as a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def prepared(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """(row, ...): docs whole, with _tokens (words plus one, so that no document weighs
    nothing), _s, _l, _t (margin values) and _u (its draw)."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^ \t\n\r]+"))
    name = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lower(F.hex(text_key(text_col))))
    draw = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)
    return wrapped(docs, _tokens=(words + 1).cast("bigint"), _s=category(source_col), _l=category(lang_col),
                   _t=topic_of(text_col), _u=draw)


def rake(d: DataFrame, powers: dict[str, float]) -> tuple[DataFrame, dict, dict, float]:
    """(per-source factors (_s, a), b by language, c by topic, largest
    factor of any cell). An empty table gives no factors and 1. Margins that
    are not met after ``ROUNDS`` rounds raise a warning that says how far
    they are off; the factors of the last round hold."""
    cells = d.groupBy("_s", "_l", "_t").agg(F.sum("_tokens").cast("double").alias("x"))
    per_source = written(
        cells.groupBy("_s").agg(F.collect_list(F.struct("_l", "_t", "x")).alias("cells"), F.sum("x").alias("w"))
        .withColumn("goal", F.pow("w", F.lit(powers["source"]))), "mix-sources")
    table = {(r["_l"], r["_t"]): r["x"] for r in
             per_source.select(F.explode("cells").alias("c")).groupBy("c._l", "c._t").agg(F.sum("c.x").alias("x")).collect()}
    if not table:
        return per_source.select("_s", F.lit(1.0).alias("a")), {}, {}, 1.0
    total = sum(table.values())
    goal_sum = per_source.agg(F.sum("goal")).first()[0]

    def goals(axis: int, power: float) -> dict:
        seen: dict = {}
        for k, x in table.items():
            seen[k[axis]] = seen.get(k[axis], 0.0) + x
        raised = {k: v**power for k, v in seen.items()}
        return {k: total * v / sum(raised.values()) for k, v in raised.items()}

    want_l, want_t = goals(0, powers["lang"]), goals(1, powers["topic"])
    b, c = dict.fromkeys(want_l, 1.0), dict.fromkeys(want_t, 1.0)

    def factors() -> DataFrame:
        lookup = {}
        for name, f in (("_l", b), ("_t", c)):
            lookup[name] = F.create_map(*[F.lit(v) for kv in sorted(f.items()) for v in kv])
        inside = F.aggregate("cells", F.lit(0.0), lambda acc, e: acc + e["x"] * lookup["_l"][e["_l"]] * lookup["_t"][e["_t"]])
        return per_source.withColumn("a", F.col("goal") * F.lit(total / goal_sum) / inside)

    for _ in range(ROUNDS):
        now = {(r["_l"], r["_t"]): r["x"] * b[r["_l"]] * c[r["_t"]] for r in
               factors().select("a", F.explode("cells").alias("e")).groupBy("e._l", "e._t")
               .agg(F.sum(F.col("a") * F.col("e.x")).alias("x")).collect()}
        off = 0.0
        for axis, want, f in ((0, want_l, b), (1, want_t, c)):
            for k, goal in want.items():
                got = sum(x for kk, x in now.items() if kk[axis] == k)
                off = max(off, abs(got / goal - 1))
                f[k] *= goal / got
                now = {kk: x * goal / got if kk[axis] == k else x for kk, x in now.items()}
        if off < TOLERANCE:
            break
    else:  # margins that no factors meet, as cells are empty, or nearly so
        warnings.warn(f"raking ended after {ROUNDS} rounds; before the last, margins were off by up to {off:.1e}", stacklevel=2)
    found = written(factors().select("_s", "a", "cells"), "mix-factors")
    pairs = found.select("_s", "a", F.explode("cells").alias("e")).groupBy("e._l", "e._t").agg(F.max("a").alias("a")).collect()
    top = max(r["a"] * b[r["_l"]] * c[r["_t"]] for r in pairs)
    return found.select("_s", "a"), b, c, top


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", powers: dict[str, float] | None = None) -> DataFrame:
    """(row, _tokens, _t, _p, _kept): every input row whole, its tokens, its
    topic, its probability of being kept and whether it is.

    The draw is fixed by the id and the text, so repeated rows share their
    fate. Null sources and languages are values of their own; a null or
    empty text weighs one token. No rows in, no rows out."""
    d = prepared(docs, id_col, text_col, source_col, lang_col)
    a, b, c, top = rake(d, powers or POWERS)
    d = d.join(a.select(F.col("_s").alias("_as"), "a"), F.col("_s") == F.col("_as"), "inner")
    p = F.col("a") / F.lit(top)
    for name, f in (("_l", b), ("_t", c)):
        if f:
            p = p * F.create_map(*[F.lit(v) for kv in sorted(f.items()) for v in kv])[F.col(name)]
    d = d.withColumn("_p", F.least(F.lit(1.0), p))
    return d.withColumn("_kept", F.col("_u") < F.col("_p")).drop("_as", "a", "_s", "_l", "_u")


def mix_table(docs: DataFrame) -> DataFrame:
    """(doc_id, topic, tokens, probability, kept) per document."""
    return mix(docs.select("doc_id", "text", "source", "lang")).select(
        "row.doc_id", F.col("_t").alias("topic"), F.col("_tokens").alias("tokens"),
        F.round("_p", 6).alias("probability"), F.col("_kept").alias("kept"))


def mixed(docs: DataFrame) -> DataFrame:
    """The kept rows, with the columns of ``docs``."""
    return unwrapped(mix(docs).where("_kept"))


def sql(rounds: int = 40) -> str:
    """DuckDB twin: the same raking as unrolled rounds over the cells."""
    marks = "".join(f" WHEN {' OR '.join(f'contains(text, {m!r})' for m in ms)} THEN '{t}'" for t, ms in TOPICS)
    steps, prev = [], "f0"
    for i in range(rounds):
        for m in ("source", "lang", "topic"):
            steps.append(f"f{i}{m} AS MATERIALIZED (SELECT source, lang, topic, x, gs, gl, gt, "
                         f"w * g{m[0]} / sum(w) OVER (PARTITION BY {m}) AS w FROM {prev})")
            prev = f"f{i}{m}"
    power = POWERS
    return f"""
WITH d AS (SELECT doc_id, coalesce('=' || source, 'null') AS source, coalesce('=' || lang, 'null') AS lang,
       CASE WHEN text IS NULL THEN '{OTHER}'{marks} ELSE '{OTHER}' END AS topic,
       len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) + 1 AS tokens,
       ('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), md5(text))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
       FROM documents),
x AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS x FROM d GROUP BY ALL),
ms AS (SELECT source, pow(sum(x), {power['source']}) AS r FROM x GROUP BY source),
ml AS (SELECT lang, pow(sum(x), {power['lang']}) AS r FROM x GROUP BY lang),
mt AS (SELECT topic, pow(sum(x), {power['topic']}) AS r FROM x GROUP BY topic),
f0 AS (SELECT source, lang, topic, x, x AS w,
       (SELECT sum(x) FROM x) * ms.r / (SELECT sum(r) FROM ms) AS gs,
       (SELECT sum(x) FROM x) * ml.r / (SELECT sum(r) FROM ml) AS gl,
       (SELECT sum(x) FROM x) * mt.r / (SELECT sum(r) FROM mt) AS gt
       FROM x JOIN ms USING (source) JOIN ml USING (lang) JOIN mt USING (topic)),
{', '.join(steps)},
p AS (SELECT source, lang, topic, least(1.0, (w / x) / (SELECT max(w / x) FROM {prev})) AS p FROM {prev})
SELECT doc_id, topic, tokens::BIGINT AS tokens, round(p, 6) AS probability, u < p AS kept
FROM d JOIN p USING (source, lang, topic)
"""
