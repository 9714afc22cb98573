"""Removal of repeated lines by overlapping three-line windows.

Every run of three consecutive lines of a document is hashed (two 64-bit
hashes). A window that occurs more than once anywhere keeps its first
occurrence, in order of (doc_id, place); every later occurrence covers
its three lines. Covered lines are merged over overlapping windows and
removed. Only hashes and places are shuffled to find repeats; texts move
once, to meet their covered lines.

Plan against skew: a window may be shared by any number of documents.
Its first occurrence is a partial aggregate, stored, then joined back; the
join has exchanges on both sides, so AQE splits a hot window. Copies of a
row give each place once, by a partial aggregate, so what is gathered for a
document is bounded by its own lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import stored, text_key

WINDOW = 3


def windows_of(rows: DataFrame) -> DataFrame:
    """(id, key, pos, h1, h2): one row per window that holds at least one
    line with something but spaces."""
    lines = rows.where("text is not null").select("id", "key", F.split("text", "\n", -1).alias("ls"))
    lines = lines.where(F.size("ls") >= WINDOW)
    three = ", ".join(f"element_at(ls, i + {j + 1})" for j in range(WINDOW))
    cell = f"named_struct('pos', i, 'h1', xxhash64({three}), 'h2', xxhash64('second', {three}), 'blank', trim(concat({three})) = '')"
    return (
        lines.select("id", "key", F.explode(F.expr(f"transform(sequence(0, size(ls) - {WINDOW}), i -> {cell})")).alias("w"))
        .where("not w.blank")
        .select("id", "key", "w.pos", "w.h1", "w.h2")
    )


def removed_lines(rows: DataFrame) -> DataFrame:
    """(id, key, gone): sorted line numbers (from 0) to remove, for the
    documents that lose any."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "pos")
    w = windows_of(rows)
    firsts = stored(
        w.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    )
    later = w.join(firsts, ["h1", "h2"], "inner").where(place != F.col("first")).select("id", "key", "pos").distinct()
    covered = F.expr(f"array_sort(array_distinct(flatten(transform(collect_list(pos), p -> sequence(p, p + {WINDOW - 1})))))")
    return later.groupBy("id", "key").agg(covered.alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, spans, clean_text), one row per input
    row. ``spans`` lists the removed line ranges as ``start-end`` (from 0,
    end exclusive), comma-joined.

    Lines are parted by the line feed and compared exactly. A null text has
    no lines and stays null; an empty text is one empty line. Documents of
    fewer than three lines never change. Rows with the same id and text
    count as one document, so they keep or lose the same lines; null ids
    come last in the order of first occurrence. Other columns of the input
    are ignored, whatever their names."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", text_key("text"))
    gone = removed_lines(rows).select(F.col("id").alias("gid"), F.col("key").alias("gkey"), "gone")
    on = F.col("id").eqNullSafe(F.col("gid")) & F.col("key").eqNullSafe(F.col("gkey"))
    d = rows.join(gone, on, "left").withColumn("ls", F.split("text", "\n", -1))
    after = F.transform("gone", lambda x: x + 1)
    spans = F.zip_with(F.array_except("gone", after), F.array_except(after, "gone"), lambda a, b: F.concat(a.cast("string"), F.lit("-"), b.cast("string")))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(ls) - 1), gone), i -> element_at(ls, i + 1)), '\n')")
    return d.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("ls")).cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), "").otherwise(F.array_join(spans, ",")).alias("spans"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("clean_text"),
    )


SQL = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(0, greatest(len(ls) - 2, 0))) AS pos FROM l),
w AS (SELECT doc_id, pos, ls[pos + 1] AS a, ls[pos + 2] AS b, ls[pos + 3] AS c FROM p
      WHERE trim(ls[pos + 1] || ls[pos + 2] || ls[pos + 3]) <> ''),
later AS (SELECT doc_id, pos FROM w
          QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS line FROM later),
run AS (SELECT doc_id, line, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS g FROM gone),
span AS (SELECT doc_id, g, min(line) AS lo, max(line) + 1 AS hi FROM run GROUP BY doc_id, g),
spans AS (SELECT doc_id, string_agg(lo || '-' || hi, ',' ORDER BY lo) AS spans, sum(hi - lo) AS n FROM span GROUP BY doc_id),
line AS (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM l),
kept AS (SELECT line.doc_id, string_agg(ls[i + 1], chr(10) ORDER BY i) AS t FROM line
         ANTI JOIN gone ON gone.doc_id = line.doc_id AND gone.line = line.i GROUP BY line.doc_id)
SELECT l.doc_id, coalesce(len(l.ls), 0)::BIGINT AS n_lines, coalesce(s.n, 0)::BIGINT AS n_removed,
       coalesce(s.spans, '') AS spans, CASE WHEN s.n IS NULL THEN l.text ELSE coalesce(k.t, '') END AS clean_text
FROM l LEFT JOIN spans s USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
