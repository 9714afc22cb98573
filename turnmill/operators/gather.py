"""Late materialisation of text: which rows belong together, and in what
order, is worked out on narrow keys; the text meets its group afterwards,
in one exchange.

Rows carry a chunk, a bounded range of their key's order. Text and group
ids meet by (key, chunk), and a group's rows of one chunk are put together
in the same partition. Only the groups that reach into several chunks are
put together again from their pieces, a row per chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


def gather(text: DataFrame, groups: DataFrame, at: list[str], row: list[str], group: list[str],
           pieces: dict[str, Column], joined: dict[str, Column]) -> DataFrame:
    """``text`` and ``groups`` meet by ``at`` (key and chunk) and ``row`` (what
    names a row there, once in ``groups``); ``groups`` also has the columns
    ``group`` and whether a group ``spans`` chunks. One row per ``group``:
    ``pieces`` aggregates the rows of one chunk, ``joined`` such pieces under
    the same names."""
    n = int(text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Read several times below; what led to them runs once.
    groups = store(groups, "groups")
    ids = [*at, *row]
    named = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    text = text.where(named)

    def put_together(met):
        part = met.groupBy(*at, *[g for g in group if g not in at], "spans").agg(*[c.alias(x) for x, c in pieces.items()])
        return part.select(*group, *[c for c in at if c not in group], *pieces)

    # A join would deal rows by all of ``ids``, and the aggregate move the text
    # again. Text and group rows side by side need one layout, by ``at``.
    inner = groups.where(~F.col("spans") & named).select(*ids, F.struct(*[c for c in groups.columns if c not in ids]).alias("_group"))
    both = text.withColumn("_text", F.lit(True)).unionByName(inner, allowMissingColumns=True).repartition(n, *at)
    both = both.withColumn("_group", F.max("_group").over(Window.partitionBy(*ids))).where("_text and _group is not null")
    whole = put_together(both.select(*text.columns, "_group.*"))
    # The few chunks (a chunk holds many rows) with groups that reach further.
    wide = groups.where("spans")
    far = text.join(F.broadcast(wide.select(*at).distinct()), at, "left_semi").join(wide, ids, "inner")
    rest = put_together(far).groupBy(*group).agg(*[c.alias(x) for x, c in joined.items()])
    return whole.select(*group, *pieces).unionByName(rest.select(*group, *pieces))
