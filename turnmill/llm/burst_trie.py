"""Prefix trie of rebuilt conversations by burst tries.

Turns travel as a 128-bit id of (role, text) and a byte count; texts never
leave their scan. A prefix is known by its depth and three sums over its
(position, turn id) hashes, so its parent's sums are a subtraction away, and
running sums are taken per chunk of a conversation.

Equal conversations become one weighted sequence. The root is a trie head
whose containers hold the suffixes of all sequences by first turn id. A
container of several sequences that holds more than ``CONTAINER_TURNS`` turns
bursts: it becomes a trie head itself and its suffixes go to containers by
the next turn id. The levels of one pass double (4, 8, 16, ...), and only
sequences under an oversized container are in the next, so a chain of
thousands of shared turns takes a dozen passes. The containers that remain
are dealt by head, sorted by their turn ids, and swept into nodes with a
stack; one that holds a single sequence is a chain, whose nodes follow from
its rows. What trie heads add up over their subtrees are partial aggregates
over the sequences through them.

No task holds more of a key than a container or a chunk: conversations are
numbered by ranges of their turns, copies are counted before they meet, and
the ids of equal conversations are joined to strings in pieces, which one
stream hashes.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import discard, stored, written

# Turns that a container of several sequences holds at most.
CONTAINER_TURNS = 8192
# Turns of one conversation that a window holds at most.
CHUNK = 65_536
# Ids of equal conversations that are joined to one string.
IDS_IN_STRING = 4096
# Turns that a conversation takes over from its base at most.
HEAD_MOD, BASE_MOD = 9, 5
BITS = 40
SUMS = ("s1", "s2", "s3")
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _mod(c: Column) -> Column:
    return c.bitwiseAND(F.lit((1 << BITS) - 1))


def _ranges(df: DataFrame, *keys: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def _number(batches):
    """Position of each turn among those of its conversation in this task."""
    part, conv, n = TaskContext.get().partitionId(), None, 0
    for pdf in batches:
        if pdf.empty:
            continue
        c = pdf["conv_id"].to_numpy()
        first = np.append(True, c[1:] != c[:-1])
        at = np.arange(len(c))
        pos = at - np.maximum.accumulate(np.where(first, at, 0))
        if conv == c[0]:
            run = np.cumsum(first) == 1
            pos[run] += n
        conv, n = c[-1], int(pos[-1]) + 1
        yield pdf.assign(part=part, pos=pos)[["conv_id", "part", "pos", "tid", "nb"]]


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, nb): turns numbered from 1, by turn (null first),
    role and turn id. Ranges of that order are numbered each by itself; at
    most one conversation of a range has begun before it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("tid"),
        F.octet_length(text).cast("bigint").alias("nb"), F.monotonically_increasing_id().alias("row"))
    local = written(_ranges(t, "conv_id", "turn", "role", "tid", "row").select("conv_id", "tid", "nb").mapInPandas(
        _number, "conv_id bigint, part bigint, pos bigint, tid binary, nb bigint"), "trie-turns")
    # One row per task.
    s = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos")).alias("l"))
    s = s.withColumn("upto", F.sum(F.col("l.pos") + 1).over(Window.partitionBy("l.conv_id").orderBy("part")))
    before = Window.orderBy("part")
    s = s.select("part", F.col("first").alias("conv_id"),
                 F.when(F.lag("l.conv_id").over(before) == F.col("first"), F.lag("upto").over(before)).alias("off")).where("off is not null")
    d = local.join(F.broadcast(s), ["part", "conv_id"], "left")
    return d.select("conv_id", (F.col("pos") + 1 + F.coalesce("off", F.lit(0))).alias("pos"), "tid", "nb")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): ``c, pos, tid, nb`` of the rebuilt
    conversations, and every ``c`` (some may have no turn)."""
    t = stored(numbered(turns))
    n = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = n.select(F.col("conv_id").alias("b"), "n")
    convs = n.select(F.col("conv_id").alias("c"), (F.col("conv_id") - F.col("conv_id") % BASE_MOD).alias("b"),
                     (F.crc32(F.col("conv_id").cast("string")) % HEAD_MOD).alias("h"))
    convs = stored(convs.join(base, "b", "left").select("c", "b", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("head")))
    first = t.where(F.col("pos") < HEAD_MOD).select(F.col("conv_id").alias("b"), "pos", "tid", "nb")
    heads = convs.join(first, "b").where("pos <= h").select("c", "pos", "tid", "nb")
    own = t.withColumnRenamed("conv_id", "c").join(convs.drop("b"), "c").where("pos > h").select(
        "c", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "tid", "nb")
    return heads.unionByName(own), convs.select("c")


def with_prefixes(rows: DataFrame) -> DataFrame:
    """Adds the sums ``s1, s2, s3`` of the prefix that ends at a row, ``p1,
    p2, p3`` of its parent, and ``bytes`` up to it."""
    r = rows
    for i, s in enumerate(SUMS):
        r = r.withColumn(f"g{i}", _mod(F.xxhash64(F.lit(i), "pos", "tid")))
    g = {**{s: f"g{i}" for i, s in enumerate(SUMS)}, "bytes": "nb"}
    r = r.withColumn("k", F.floor(F.col("pos") / CHUNK).cast("bigint"))
    w = Window.partitionBy("c", "k").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = r.select("*", *[F.sum(v).over(w).alias(s) for s, v in g.items()])
    # Only a conversation longer than a chunk has anything to add.
    t = r.groupBy("c", "k").agg(*[(F.sum(v) if s == "bytes" else _mod(F.sum(v))).alias(f"t_{s}") for s, v in g.items()])
    e = Window.partitionBy("c").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    t = t.select("c", "k", *[F.sum(f"t_{s}").over(e).alias(f"t_{s}") for s in g]).where("k > 0")
    later = local.where("k > 0").join(t, ["c", "k"], "left")
    later = later.select(*[F.col(x) if x not in g else (F.col(x) + F.coalesce(f"t_{x}", F.lit(0))).alias(x) for x in local.columns])
    out = local.where("k = 0").unionByName(later)
    return out.select(
        "c", "pos", "tid", "nb", "bytes", *[_mod(F.col(s)).alias(s) for s in SUMS],
        *[_mod(F.col(s) - F.col(f"g{i}") + F.lit(1 << BITS)).alias(f"p{i + 1}") for i, s in enumerate(SUMS)])


def _id_strings(batches):
    """(s, first, ids): runs of conversation ids, comma-joined."""
    for pdf in batches:
        out = []
        for s, g in pdf.groupby("s", sort=False)["c"]:
            ids = g.tolist()
            for i in range(0, len(ids), IDS_IN_STRING):
                part = ids[i:i + IDS_IN_STRING]
                out.append((s, part[0], ",".join(map(str, part))))
        yield pd.DataFrame(out, columns=["s", "first", "ids"])


def _hash_strings(batches):
    """SHA-256 of each sequence's strings, streamed in their order."""
    now, h = None, None
    for pdf in batches:
        out = []
        for s, ids in zip(pdf["s"], pdf["ids"]):
            if s == now:
                h.update(b"," + ids.encode())
                continue
            if h is not None:
                out.append((now, h.hexdigest()))
            now, h = s, hashlib.sha256(ids.encode())
        yield pd.DataFrame(out, columns=["s", "ends"])
    if h is not None:
        yield pd.DataFrame([(now, h.hexdigest())], columns=["s", "ends"])


def sequences(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Distinct sequences: ``s`` (smallest conversation), ``n`` copies,
    ``len``, ``total`` bytes, ``ends`` (hash of the copies' ids)."""
    last = rows.groupBy("c").agg(F.max(F.struct("pos", *SUMS, "bytes")).alias("l"))
    zero = F.lit(0).cast("bigint")
    f = convs.join(last, "c", "left").select(
        "c", *[F.coalesce(f"l.{x}", zero).alias(y) for x, y in (("pos", "len"), *((s, s) for s in SUMS), ("bytes", "total"))])
    f = stored(f)
    q = stored(f.groupBy("len", *SUMS).agg(F.min("c").alias("s"), F.count(F.lit(1)).alias("n"), F.first("total").alias("total")))
    copies = f.join(q.select("len", *SUMS, "s"), ["len", *SUMS]).select("s", "c")
    strings = _ranges(copies, "s", "c").mapInPandas(_id_strings, "s bigint, first bigint, ids string")
    n = int(f.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = strings.repartition(n, "s").sortWithinPartitions("s", "first").select("s", "ids").mapInPandas(_hash_strings, "s bigint, ends string")
    return q.join(ends, "s").select("s", "n", "len", "total", "ends")


def burst_heads(rows: DataFrame, limit: int) -> DataFrame | None:
    """(pos, s1, s2, s3) of the trie heads below the root: prefixes of
    several sequences with more than ``limit`` turns from them on."""
    lo, hi, active, found = 0, 4, None, []
    node = ["pos", *SUMS]
    while True:
        part = rows.where((F.col("pos") > lo) & (F.col("pos") <= hi))
        part = part if active is None else part.join(active, "s", "left_semi")
        big = stored(part.groupBy(*node).agg(F.sum(F.col("len") - F.col("pos") + 1).alias("w"), F.count(F.lit(1)).alias("m")).where(
            (F.col("w") > limit) & (F.col("m") > 1)).select(*node))
        if big.isEmpty():
            break
        found.append(big)
        active = stored(part.where(F.col("pos") == hi).join(big, node, "left_semi").select("s"))
        lo, hi = hi, 2 * hi
    out = None
    for big in found:
        out = big if out is None else out.unionByName(big)
    return out


def sweep(rows: list[tuple]) -> list[tuple]:
    """Nodes of one container from its sorted ``(s, n, ends, tids, nbs,
    depth)``: (conv_id, depth, parent, n_convs, n_children, n_leaves, saved,
    ends). The first is the container's head; its parent is left None."""
    depth, parent, size, rep, n, kids, leaves, saved, ends = [], [], [], [], [], [], [], [], []
    path, before = [], []
    for s, copies, end, tids, nbs, top in rows:
        same = 0
        while same < min(len(before), len(tids)) and before[same] == tids[same]:
            same += 1
        del path[same:]
        for j in range(same, len(tids)):
            parent.append(path[-1] if path else -1)
            path.append(len(depth))
            depth.append(top + j)
            size.append(int(nbs[j]))
            rep.append(s), n.append(0), kids.append(0), leaves.append(0), saved.append(0), ends.append(NO_ENDS)
        at = path[-1]
        n[at], ends[at], rep[at] = copies, end, min(rep[at], s)
        before = tids
    for i in range(len(depth) - 1, -1, -1):  # children come after their parents
        leaves[i] = leaves[i] or 1
        saved[i] += (n[i] - 1) * size[i]
        if (p := parent[i]) >= 0:
            n[p] += n[i]
            rep[p] = min(rep[p], rep[i])
            kids[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    return [(rep[i], depth[i], None if parent[i] < 0 else rep[parent[i]], n[i], kids[i], leaves[i], saved[i], ends[i]) for i in range(len(depth))]


def _sweeper(batches):
    """Containers lie whole and sorted in the rows of a task."""
    def rows():
        for pdf in batches:
            yield from zip(zip(pdf["h0"], pdf["h1"], pdf["h2"], pdf["h3"]), pdf["s"].tolist(), pdf["n"].tolist(), pdf["ends"],
                           pdf["tids"], pdf["nbs"], pdf["h0"].tolist(), pdf["p1"], pdf["p2"], pdf["p3"])

    out = []
    for _, g in groupby(rows(), key=lambda r: r[0]):
        g = [(s, n, e, list(t), b, top, p) for _, s, n, e, t, b, top, *p in g]
        for i, node in enumerate(sweep([r[:6] for r in g])):
            out.append((*node, i == 0, *(g[0][6] if i == 0 else (None, None, None))))
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=SWEPT_COLUMNS).astype(_NULLABLE)
            out = []
    yield pd.DataFrame(out, columns=SWEPT_COLUMNS).astype(_NULLABLE)


SWEPT_COLUMNS = [*NODE, "is_head", "p1", "p2", "p3"]
SWEPT = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, is_head boolean, p1 bigint, p2 bigint, p3 bigint"
_NULLABLE = {c: "Int64" for c in ("parent_conv_id", "p1", "p2", "p3")}


def trie_nodes(turns: DataFrame, limit: int = CONTAINER_TURNS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored.
    Rows without a conv_id take no part; a null turn comes first, a null role
    or text is empty; turns with the same number go by role, then by a digest
    of role and text, and repeated rows are turns of their own. Texts of any
    length count by their UTF-8 bytes. An empty table has no node."""
    rows, convs = rebuilt(turns.select("conv_id", "turn", "role", "text"))
    rows = written(with_prefixes(rows), "trie-prefixes")
    seqs = written(sequences(rows, convs), "trie-sequences")
    pre = rows
    rows = written(rows.withColumnRenamed("c", "s").join(seqs, "s"), "trie-rows")
    discard(pre)
    node, parent = ["pos", *SUMS], ["p1", "p2", "p3"]

    # Burst rows of each sequence, from the root down; its container begins after them.
    zero = F.lit(0).cast("bigint")
    root = seqs.select("s", "n", "len", "ends", zero.alias("pos"), *[zero.alias(x) for x in (*SUMS, *parent)], zero.alias("nb"), zero.alias("bytes"))
    big = burst_heads(rows, limit)
    b = root if big is None else root.unionByName(rows.join(big, node, "left_semi").select(*root.columns))
    b = stored(b)
    depth = b.groupBy("s").agg(F.max("pos").alias("burst"), F.max("bytes").alias("burst_bytes"))
    suffix = rows.join(depth, "s").where("pos > burst")
    head = stored(suffix.where("pos = burst + 1").select("s", F.col("pos").alias("h0"), *[F.col(x).alias(f"h{i + 1}") for i, x in enumerate(SUMS)], *parent))
    h = ["h0", "h1", "h2", "h3"]
    held = stored(head.join(head.groupBy(*h).agg(F.count(F.lit(1)).alias("m")), h))

    # Containers of one sequence: chains.
    chain = suffix.drop(*parent).join(held.where("m = 1").select("s", *parent), "s").withColumn("is_head", F.col("pos") == F.col("burst") + 1)
    is_end = F.col("pos") == F.col("len")
    chain = chain.select(
        F.col("s").alias("conv_id"), F.col("pos").alias("depth"), F.when(~F.col("is_head"), F.col("s")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(is_end, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("total") - F.col("bytes") + F.col("nb"))).alias("saved_tokens"),
        F.when(is_end, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"), "is_head", *[F.when(F.col("is_head"), F.col(p)).alias(p) for p in parent])

    # The others: sorted and swept.
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = suffix.drop(*parent).join(held.where("m > 1").drop("m"), "s").repartition(n, *h)
    items = dealt.groupBy(*h, "s").agg(
        F.sort_array(F.collect_list(F.struct("pos", "tid", "nb"))).alias("i"), *[F.first(x).alias(x) for x in ("n", "ends", *parent)])
    items = items.select(*h, "s", "n", "ends", F.col("i.tid").alias("tids"), F.col("i.nb").alias("nbs"), *parent)
    swept = items.sortWithinPartitions(*h, "tids").mapInPandas(_sweeper, SWEPT)
    nodes = written(chain.unionByName(swept), "trie-nodes")

    # Trie heads, from the sequences through them and the containers below.
    top = nodes.where("is_head").select(F.col("conv_id").alias("s"), "n_leaves", "saved_tokens")
    reps = b.groupBy(*node).agg(F.min("s").alias("rep"))
    owned = b.join(reps, node).where("s = rep").groupBy("s").agg(F.sum("nb").alias("owned"))
    facts = depth.join(owned, "s", "left").join(top, "s", "left")
    rest = F.col("burst_bytes") - F.col("bytes") + F.col("nb")
    # Bytes of all members' turns in the heads below, less those of each head once.
    saved = F.coalesce("saved_tokens", zero) + F.col("n") * rest - F.least(F.coalesce("owned", zero), rest)
    heads = stored(b.join(facts, "s").groupBy(*node, *parent).agg(
        F.min("s").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum(F.coalesce("n_leaves", zero)).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"), F.max(F.when(F.col("pos") == F.col("len"), F.col("ends"))).alias("ends")))
    below = heads.where("pos > 0").select((F.col("pos") - 1).alias("pos"), *parent).unionByName(
        nodes.where("is_head").select((F.col("depth") - 1).alias("pos"), *parent))
    kids = below.groupBy("pos", *parent).agg(F.count(F.lit(1)).alias("n_children"))
    up = heads.select("pos", *[F.col(s).alias(p) for s, p in zip(SUMS, parent)], F.col("conv_id").alias("parent_conv_id"))
    as_parent = heads.drop(*parent).withColumnsRenamed(dict(zip(SUMS, parent)))
    with_kids = heads.join(as_parent.select("pos", *parent, F.col("conv_id").alias("c0")).join(kids, ["pos", *parent], "left").select(
        "pos", *[F.col(p).alias(s) for s, p in zip(SUMS, parent)], "n_children"), node)
    up1 = up.withColumn("pos", F.col("pos") + 1)
    top_rows = with_kids.join(up1, ["pos", *parent], "left").select(
        "conv_id", F.col("pos").alias("depth"), F.when(F.col("pos") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        # A root without a turn below it is its own leaf.
        F.when(F.coalesce("n_children", zero) == 0, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
        "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    inner = nodes.where("not is_head").select(*NODE)
    tops = nodes.where("is_head").drop("parent_conv_id").withColumn("pos", F.col("depth")).join(up1, ["pos", *parent], "left").select(*NODE)
    return inner.unionByName(tops).unionByName(top_rows)


# crc32 of the decimal id, bit by bit: -1 stands for one shift.
_CRC = """
list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384::BIGINT) END)"""

SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
cs AS (SELECT s.conv_id AS c, s.conv_id - s.conv_id % 5 AS b, xor({_CRC.replace('conv_id', 's.conv_id')}, 4294967295::BIGINT) % 9 AS h, coalesce(o.n, 0) AS bn
       FROM size s LEFT JOIN size o ON o.conv_id = s.conv_id - s.conv_id % 5),
rb AS (SELECT c, pos, r, x FROM cs JOIN t ON t.conv_id = cs.b AND t.pos <= cs.h
       UNION ALL SELECT c, pos - h + least(h, bn), r, x FROM cs JOIN t ON t.conv_id = cs.c AND t.pos > cs.h),
seq AS (SELECT cs.c, coalesce(list({{'r': r, 'x': x}} ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS l FROM cs LEFT JOIN rb USING (c) GROUP BY cs.c),
d AS (SELECT c, l, unnest(range(0, len(l) + 1)) AS depth FROM seq),
m AS (SELECT c, depth, l[1:depth] AS k, CASE WHEN depth > 0 THEN octet_length(encode(l[depth].x)) ELSE 0 END AS nb, depth = len(l) AS at_end FROM d),
node AS (SELECT k, depth, min(c) AS conv_id, count(*) AS n, any_value(nb) AS nb,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE at_end), '')) AS ends FROM m GROUP BY k, depth),
mm AS (SELECT m.c, m.depth, node.conv_id AS node_id FROM m JOIN node USING (k, depth)),
kid AS (SELECT mm.node_id AS conv_id, mm.depth, count(*) AS kids FROM node ch JOIN mm ON mm.c = ch.conv_id AND mm.depth = ch.depth - 1 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kid USING (conv_id, depth)),
sub AS (SELECT mm.node_id AS conv_id, mm.depth, sum((u.kids = 0)::INT) AS leaves, sum((u.n - 1) * u.nb) AS saved
        FROM full_node u JOIN mm ON mm.c = u.conv_id AND mm.depth <= u.depth GROUP BY ALL)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.node_id AS parent_conv_id, f.n::BIGINT AS n_convs, f.kids::BIGINT AS n_children,
       sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN sub USING (conv_id, depth) LEFT JOIN mm p ON p.c = f.conv_id AND p.depth = f.depth - 1
"""
