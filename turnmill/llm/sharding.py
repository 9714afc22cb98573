"""Uniform shuffle into shards of exact size by a hypergeometric
communication matrix.

Rows lie in ``partitions`` hash partitions with known counts. Were all
rows permuted at random and cut into shards of fixed sizes, the number
of rows that partition p sends to shard s would be one cell of a matrix
with fixed margins whose law is multivariate hypergeometric. That matrix
is drawn first, from the counts alone: the list of partitions is halved
again and again, and at each halving the shard sizes of the parent are
split between the halves by one hypergeometric draw per shard (inverse
transform over a 12-sigma window, exact to double precision). Then every
partition permutes its rows (order by a random key) and deals them out
by its row of the matrix, rows are exchanged, and each shard permutes
what it got. Only counts are gathered: a matrix of partitions x shards.

Everything is DataFrame / SQL expressions. A shard is not one task: its
final permutation is cut into slices of the random key, and a row's slot
is its place in the slice plus the rows of earlier slices. Partitions and
slices follow from the number of rows (``TASK_ROWS`` to a sort, about).

Rows that agree in the key are told apart by a running number before
anything hashes them, so a hot key spreads over all partitions: equal keys
are counted first, and the count is written out again in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import unwrapped, wrapped, written

# Rows that one local sort is meant to hold; least partitions and slices.
TASK_ROWS = 1 << 20
PARTITIONS, SLICES = 512, 64
# Copies of a key that are written out together; rows numbered together.
BLOCK_BITS = 16
# Halvings after which the nodes of the matrix are spread over tasks.
SPREAD_LEVEL = 6


def let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value`` (evaluated once)."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(total: str, good: str, draws: str, u: str) -> str:
    """SQL of one draw: good items among ``draws`` taken from ``total``
    items of which ``good`` are good. Weights start at 1 at the low end of
    the window and follow the ratio of neighbouring probabilities, so no
    factorials are needed; the draw is the first value whose running
    weight exceeds ``u`` times the sum of weights."""
    step = (
        f"(({good}) - k + 1D) * (({draws}) - k + 1D) / (k * (({total}) - ({good}) - ({draws}) + k))"
    )
    weight = f"if(k = b.lo, 1D, acc.w * {step})"
    total_weight = (
        "aggregate(sequence(b.lo, b.hi), named_struct('w', 0D, 't', 0D), (acc, k) -> "
        + let(weight, "w1", "named_struct('w', w1, 't', acc.t + w1)")
        + ", acc -> acc.t)"
    )
    pick = (
        "aggregate(sequence(b.lo, b.hi), named_struct('w', 0D, 't', 0D, 'x', cast(null as bigint)), (acc, k) -> "
        + let(weight, "w1", "named_struct('w', w1, 't', acc.t + w1, 'x', "
                            "if(acc.x is null and acc.t + w1 > goal, k, acc.x))")
        + ", acc -> coalesce(acc.x, b.hi))"
    )
    mean = f"(({draws}) * 1D * ({good}) / ({total}))"
    spread = f"(12 * sqrt(greatest(0D, {mean} * (1 - ({good}) / ({total})) * (({total}) - ({draws})) / greatest(({total}) - 1, 1))) + 12)"
    bounds = (
        f"named_struct('lo', greatest(0L, ({draws}) - (({total}) - ({good})), cast(floor({mean} - {spread}) as bigint)), "
        f"'hi', least(({good}), ({draws}), cast(ceil({mean} + {spread}) as bigint)))"
    )
    drawn = let(bounds, "b", f"if(b.lo >= b.hi, b.lo, {let(f'({u}) * {total_weight}', 'goal', pick)})")
    return f"if(({good}) <= 0 or ({draws}) <= 0, 0L, {drawn})"


def communication_matrix(counts: DataFrame, shards: int, partitions: int, seed: int) -> DataFrame:
    """(part, takes ARRAY<BIGINT>): rows that each partition sends to each
    shard. ``counts`` has (part, n), ``partitions`` is a power of two."""
    levels = partitions.bit_length() - 1
    if 1 << levels != partitions:
        raise ValueError("partitions must be a power of two")
    spark = counts.sparkSession
    full = spark.range(partitions).join(counts, F.col("id") == F.col("part"), "left")
    node = full.agg(
        F.expr("transform(array_sort(collect_list(struct(id, coalesce(n, 0L) as n))), x -> x.n)").alias("ns")
    ).select(
        F.lit(0).cast("bigint").alias("part"), "ns",
        F.expr("aggregate(ns, 0L, (a, x) -> a + x)").alias("total"),
    ).select(
        "part", "ns",
        F.expr(f"transform(sequence(0, {shards - 1}), s -> cast(total div {shards} + if(s < total % {shards}, 1, 0) as bigint))")
        .alias("takes"),
    )
    for level in range(levels):
        u = f"shiftrightunsigned(xxhash64({seed}L, {level}, part, i), 11) * {2.0**-53!r}D"
        draw = hypergeometric("st.rest", "element_at(takes, i)", "st.n", u)
        left = (
            f"aggregate(sequence(1, {shards}), named_struct('n', left_n, 'rest', all_n, 'out', cast(array() as array<bigint>)), "
            "(st, i) -> "
            + let(draw, "x", "named_struct('n', st.n - x, 'rest', st.rest - element_at(takes, i), 'out', concat(st.out, array(x)))")
            + ", st -> st.out)"
        )
        half = partitions >> (level + 1)
        if level == SPREAD_LEVEL:
            node = node.repartition(1 << level, "part")
        node = (
            node.withColumn("left_n", F.expr(f"aggregate(slice(ns, 1, {half}), 0L, (a, x) -> a + x)"))
            .withColumn("all_n", F.expr("aggregate(takes, 0L, (a, x) -> a + x)"))
            .withColumn("left", F.expr(left))
            .select(F.explode(F.array(
                F.struct((F.col("part") * 2).alias("part"), F.slice("ns", 1, half).alias("ns"), F.col("left").alias("takes")),
                F.struct((F.col("part") * 2 + 1).alias("part"), F.slice("ns", half + 1, half).alias("ns"),
                         F.zip_with("takes", "left", lambda a, b: a - b).alias("takes")),
            )).alias("c"))
            .select("c.*")
        )
    return node.select("part", "takes")


def power_of_two(x: int) -> int:
    """The least power of two that is not less than ``x``."""
    return 1 << max(0, x - 1).bit_length()


def told_apart(rows: DataFrame, key: list[str], block_bits: int = BLOCK_BITS) -> DataFrame:
    """The ``key`` columns of every row plus ``nth``, 1 .. n among the n rows
    that agree in all of them. Copies are counted (partial aggregates), dealt
    out in blocks and written out again block by block, so that neither one
    task nor one cell holds all copies of a key."""
    k = [F.col(c) for c in key]
    first = F.lit(1 << block_bits).cast("bigint")
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.select(*k, "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {1 << block_bits})")).alias("_block"))
    spread = blocks.repartition(*k, "_block")
    return spread.select(*k, F.explode(F.sequence(
        F.col("_block") * first + 1, F.least(F.col("_n"), (F.col("_block") + 1) * first))).alias("nth"))


def assign_shards(rows: DataFrame, key: list[str], shards: int, partitions: int | None = None, seed: int = 7,
                  slices: int | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``key``, ``nth``, ``shard`` (0 .. shards-1) and ``slot`` (gapless from
    0 within the shard) of every row: a uniform random permutation, fixed by
    ``seed`` and the ``key`` columns, cut into shards whose counts differ by
    at most one.

    Rows that agree in every key column are interchangeable and numbered by
    ``nth``. Null keys are values like any other; an empty input gives an
    empty result. ``partitions`` (a power of two) and ``slices`` are taken
    from the number of rows unless given."""
    if partitions is None or slices is None:
        total = rows.count()
        partitions = partitions or max(PARTITIONS, power_of_two(total // TASK_ROWS))
        slices = slices or max(SLICES, power_of_two(total // (shards * TASK_ROWS)))
    k = [F.col(c) for c in [*key, "nth"]]
    part = F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), *k), F.lit(partitions))
    d = told_apart(rows, key, block_bits).withColumn("_part", part)
    counts = d.groupBy(F.col("_part").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    matrix = communication_matrix(counts, shards, partitions, seed)
    cuts = matrix.select(
        F.col("part").alias("_part"),
        F.expr("aggregate(takes, cast(array(0L) as array<bigint>), (a, x) -> concat(a, array(element_at(a, -1) + x)))").alias("_cuts"),
    )
    local = Window.partitionBy("_part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), *k), *k)
    # cuts has one row of ``shards`` numbers per partition of TASK_ROWS rows;
    # the optimizer weighs it for a broadcast only by its size.
    d = d.withColumn("_rn", F.row_number().over(local)).join(cuts, "_part", "inner")
    d = d.withColumn("shard", F.expr("cast(size(filter(_cuts, c -> c < _rn)) - 1 as int)")).drop("_part", "_cuts", "_rn")
    mix = F.xxhash64(F.lit(seed), F.lit("slot"), *k)
    d = d.withColumn("_mix", mix).withColumn("_slice", F.pmod(F.shiftright("_mix", 32), F.lit(slices)))
    sizes = d.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("shard", "_slice").orderBy("_mix", *k)
    return (
        d.withColumn("_rn", F.row_number().over(within))
        .join(offsets, ["shard", "_slice"], "inner")
        .withColumn("slot", (F.col("_off") + F.col("_rn") - 1).cast("bigint"))
        .drop("_mix", "_slice", "_rn", "_off")
    )


def numbered(rows: DataFrame, key: list[str], tag: str, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(tag, nth): the running number of every row of a key that several rows
    share, by ascending ``tag``. Rows are numbered per block of tags and
    shifted by the counts of the key's earlier blocks, one row a block."""
    same = rows.select(*key, F.col(tag).alias("_tag"), F.shiftright(tag, block_bits).alias("_block"))
    sizes = same.groupBy(*key, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"o_{c}") for c in key], F.col("_block").alias("o_block"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*key, "_block").orderBy("_tag")
    on = F.col("_block") == F.col("o_block")
    for c in key:
        on = on & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    placed = same.withColumn("_rn", F.row_number().over(within)).join(offsets, on)
    return placed.select(F.col("_tag").alias(tag), (F.col("_off") + F.col("_rn")).alias("nth"))


def sized(text: str) -> tuple[Column, Column]:
    """(size, crc): UTF-8 bytes of the text (null: none) plus 16; unsigned
    crc32 of the UTF-8 text (null: that of the empty text)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return (F.octet_length(t) + 16).cast("bigint"), F.crc32(t.cast("binary")).cast("bigint")


def shard_table(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard. The law is ``rows`` (counts at most one apart); equal texts
    are dealt independently, because a uniform shuffle with exact sizes
    can't also hold a group larger than a shard together. Null ids and
    texts are values; repeated rows each get a slot; other columns of the
    input are ignored, whatever their names."""
    size, crc = sized(text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), crc.alias("text_crc32"))
    out = assign_shards(narrow, ["doc_id", "size", "text_crc32"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                    block_bits: int = BLOCK_BITS) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` and ``slot`` (replacing columns
    of those names). Places are drawn on narrow rows; whole rows are written
    once, with a tag, and cross the network once. Rows with equal (id, size,
    crc) are told apart by a running number, worked out in blocks for the
    repeated ones alone; which of them takes which place is free."""
    size, crc = sized(text_col)
    rows = wrapped(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]),
                   k_id=id_col, k_size=size, k_crc=crc)
    keys = ["k_id", "k_size", "k_crc"]
    rows = written(rows.withColumn("tag", F.monotonically_increasing_id()), "shard-rows")
    placed = assign_shards(rows.select(*keys), keys, shards, block_bits=block_bits)
    placed = written(placed.select(*[F.col(k).alias(f"p{k}") for k in keys], F.col("nth").alias("pnth"), "shard", "slot"), "shard-places")
    # A key that has a second place belongs to several rows.
    several = placed.where("pnth = 2").select(*[f"p{k}" for k in keys])
    on = (F.col("k_id").eqNullSafe(F.col("pk_id")) & (F.col("k_size") == F.col("pk_size")) & (F.col("k_crc") == F.col("pk_crc")))
    again = written(numbered(rows.select(*keys, "tag").join(several, on, "left_semi"), keys, "tag", block_bits), "shard-numbers")
    told = rows.join(again.withColumnRenamed("tag", "_tag"), F.col("tag") == F.col("_tag"), "left").withColumn(
        "nth", F.coalesce("nth", F.lit(1).cast("bigint")))
    joined = told.join(placed, on & (F.col("nth") == F.col("pnth")), "inner")
    return unwrapped(joined, "shard", "slot")
