"""Hot keys: one key holds a third of all rows. The chunked plans must
give exactly what whole-key windows give, wherever chunks are cut."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from turnmill.operators import prefix
from turnmill.operators import router as rt
from turnmill.operators import segments as seg
from turnmill.operators import turns as turns_op


def _skewed_turns(spark, n=3000, seed=3):
    rng = random.Random(seed)
    rows = []
    turn_of = {}
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.randint(1, 200)  # key 0: a third of all rows
        t = turn_of.get(key, 0)
        turn_of[key] = t + 1
        role = "system" if t == 0 and key % 2 == 0 else rng.choice(["human", "gpt", "gpt", "human", "human"])
        text = rng.choice(["plain words", "MARK here", "  ", "more text", "MARK again"])
        rows.append((key, t, role, text))
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


def test_chunked_row_number_equals_window(spark):
    df = _skewed_turns(spark)
    a = prefix.chunked_row_number(df, "conv_id", F.floor(F.col("turn") / 7), ["turn"], "rn")
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("bigint"))
    assert sorted(a.select("conv_id", "turn", "rn").collect()) == sorted(b.select("conv_id", "turn", "rn").collect())


def test_chunked_running_sum_equals_window(spark):
    df = _skewed_turns(spark).withColumn("v", F.col("turn") % 5)
    a = prefix.chunked_running_sum(df, ["conv_id"], F.floor(F.col("turn") / 7), ["turn"], "v", "s")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = df.withColumn("s", F.sum("v").over(w).cast("bigint"))
    assert sorted(a.select("conv_id", "turn", "s").collect()) == sorted(b.select("conv_id", "turn", "s").collect())


def test_segmentation_hot_key_chunk_sizes_agree(spark):
    df = _skewed_turns(spark)
    assert sorted(seg.split_segments(df, marker="MARK").collect()) == sorted(seg.split_segments(df, marker="MARK", chunk_rows=64).collect())


def test_turn_building_hot_key_chunk_sizes_agree(spark):
    df = _skewed_turns(spark)
    w_conv, w_disp = turns_op.build_conversations(df, min_messages=1, empty_below=0)
    c_conv, c_disp = turns_op.build_conversations(df, min_messages=1, empty_below=0, chunk_rows=50)
    assert sorted(w_conv.collect()) == sorted(c_conv.collect())
    assert sorted(w_disp.collect(), key=str) == sorted(c_disp.collect(), key=str)
    assert w_conv.where("conv_id = 0").count() > 100


@pytest.mark.parametrize("chunk_rows", [1, 65536])
def test_null_text_stays_in_its_segment(spark, chunk_rows):
    rows = [(1, 0, "human", None), (1, 1, "gpt", "a"), (1, 2, "human", "MARK b"), (1, 3, "gpt", None)]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = {r.turn: r.segment for r in seg.split_segments(df, marker="MARK", chunk_rows=chunk_rows).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}


def test_rank_statistics_equal_sorted_positions(spark):
    rng = random.Random(4)
    for n in (1, 2, 7, 500):
        values = [rng.choice([0, 1, 3, rng.randint(0, 10**6), rng.randint(0, 2**40)]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "v BIGINT")
        got = {r.stat: r.chars for r in seg.rank_statistics(df, "v").collect()}
        s = sorted(values)
        at = {"min": 0, "p10": n // 10, "p25": n // 4, "median": n // 2, "p75": 3 * n // 4, "p90": 9 * n // 10,
              "p95": int(n * 0.95), "max": n - 1}
        assert got == {k: s[i] for k, i in at.items()}
    assert seg.rank_statistics(df.limit(0), "v").count() == 0


def test_building_a_plan_starts_no_job(spark):
    """No size check runs while a plan is put together."""
    df = _skewed_turns(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plans")
    seg.rank_statistics(seg.segment_lengths(seg.split_segments(df, marker="MARK")), "n_chars")
    turns_op.repair_alternation(turns_op.collapse_runs(df))
    jobs = tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert list(jobs) == []


def test_balance_has_no_window_by_label_alone(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(30)], "conv_id BIGINT, label STRING")
    plan = rt.balance(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert windows and all("_b" in line.split("], [")[1] for line in windows)
