"""Pipelines end to end on the derived sessions (sf0.001) and the
conversations table, plus the strict / dialect-tolerant dataset readers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from turnmill.operators import router as rt
from turnmill.plans import jobs
from turnmill.session import read_version, versions
from turnmill.sources import fixture, tables

SF = "/root/testdata/sf0.001"


def test_analyze_report(spark):
    out = jobs.analyze(spark, fixture.trace_turns(spark, SF))
    dist = out["distribution"].collect()
    assert sum(r.n for r in dist) == fixture.trace_turns(spark, SF).select("conv_id").distinct().count()
    assert [r.n for r in dist] == sorted((r.n for r in dist), reverse=True)
    assert abs(sum(r.pct for r in dist) - 100.0) < 1e-9
    assert out["smallest"].first().min_count == min(r.n for r in dist)
    ex = out["examples"].collect()
    assert all(r.rn <= 3 for r in ex)


def test_build_experts_writes_one_directory_per_label(spark, tmp_path):
    turns = fixture.trace_turns(spark, SF)
    out = jobs.build_experts(spark, turns, str(tmp_path / "experts"), min_examples=10, min_count=5)
    labels = spark.read.parquet(out["labels"])
    dirs = sorted(d.split("=", 1)[1] for d in os.listdir(out["experts"]) if d.startswith("label="))
    assert dirs == sorted(r.label for r in labels.select("label").distinct().collect())
    manifest = {r.label: (r.rows, r.status) for r in read_version(spark, out["manifest"]).collect()}
    assert all((s == "train") == (n >= 10) for n, s in manifest.values())
    ex = spark.read.parquet(out["router_examples"])
    assert set(ex.columns) >= {"conv_id", "input", "label", "label_id", "split"}
    per_label = ex.groupBy("label").pivot("split", ["test", "train"]).count().collect()
    for r in per_label:
        n = (r.test or 0) + (r.train or 0)
        assert (r.test or 0) == -(-15 * n // 100)  # ceil(0.15 n), at least one test row
    mapping = [json.loads(line) for f in os.listdir(out["label_map"]) if f.endswith(".json")
               for line in open(os.path.join(out["label_map"], f))]
    assert sorted(m["label_id"] for m in mapping) == list(range(len(mapping)))
    rtd = spark.read.json(out["router_training_data"])
    assert sorted(rtd.columns) == ["input", "label"] and rtd.count() == ex.count()


def test_expert_files_hold_conversation_lines(spark, tmp_path):
    """What output_accounting says before the write is what lies on disk."""
    from turnmill.operators import reports as rep

    turns = tables.with_home_prefix(fixture.trace_turns(spark, SF), "é\n\"")
    out = jobs.build_experts(spark, turns, str(tmp_path / "a"), balance=True, max_chars=12)
    said = {r.label: (r.rows, r.bytes) for r in rep.output_accounting(turns, spark.read.parquet(out["labels"])).collect()}
    found = {}
    for d in os.listdir(out["experts"]):
        if d.startswith("label="):
            text = b"".join(open(os.path.join(out["experts"], d, f), "rb").read()
                            for f in os.listdir(os.path.join(out["experts"], d)) if f.endswith(".json"))
            assert all(list(json.loads(line)) == ["conversations"] for line in text.splitlines()[:3])
            found[d.split("=", 1)[1]] = (text.count(b"\n"), len(text))
    assert found == said
    ex = spark.read.parquet(out["router_examples"])
    assert len({r["count"] for r in ex.groupBy("label").count().collect()}) == 1
    assert ex.agg(F.max(F.length("input"))).first()[0] == 12


def test_manifest_keeps_finished_experts(spark, tmp_path):
    turns = fixture.trace_turns(spark, SF)
    first = jobs.build_experts(spark, turns, str(tmp_path / "one"))
    todo = sorted(r.label for r in read_version(spark, first["manifest"]).where("status = 'train'").collect())
    results = spark.createDataFrame([(x, i != 0) for i, x in enumerate(todo)], "label STRING, ok BOOLEAN")
    done = jobs.finish_experts(spark, first["manifest"], results)
    assert {r.label: r.status for r in read_version(spark, done).collect() if r.label in todo} == {
        x: "done" if i else "failed" for i, x in enumerate(todo)}
    again = jobs.build_experts(spark, turns, str(tmp_path / "two"), previous=done)
    status = {r.label: r.status for r in read_version(spark, again["manifest"]).collect()}
    assert [status[x] for x in todo] == ["train"] + ["done"] * (len(todo) - 1)


def test_evaluate_job_with_perfect_and_shifted_predictions(spark):
    labels = jobs.label_conversations(fixture.trace_turns(spark, SF))
    mapping = rt.label_map(labels)
    perfect = labels.select("conv_id", F.col("label").alias("predicted"))
    r = jobs.evaluate(labels, perfect, mapping)
    assert r["accuracy"].first().accuracy == 1.0 and r["confusions"].count() == 0
    shifted = fixture.shifted_predictions(labels, mapping)
    r = jobs.evaluate(labels, shifted, mapping)
    wrong = labels.where("conv_id % 7 = 0").count()
    acc = r["accuracy"].first()
    assert acc.n_total - acc.n_correct == wrong
    assert sum(c.n for c in r["confusions"].collect()) <= wrong


def test_training_text_split_is_stable_under_repartitioning(spark):
    turns = tables.conversation_turns(spark, SF)
    a = {r.conv_id: r.split for r in jobs.build_training_text(turns, seq_length=1024).collect()}
    b = {r.conv_id: r.split for r in jobs.build_training_text(turns.repartition(7), seq_length=1024).collect()}
    assert a == b and set(a.values()) <= {"train", "eval"}


def test_balance_gives_equal_counts(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b", "x") for i in range(30)], "conv_id BIGINT, label STRING, input STRING")
    counts = {r.label: r.n for r in rt.label_counts(rt.balance(df)).collect()}
    assert counts == {"a": 10, "b": 10}


def test_read_sharegpt_both_dialects_and_strict_mode(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    p.write_text(json.dumps({"conversations": [{"from": "system", "value": "s"}, {"from": "human", "value": "h"}]}) + "\n"
                 + json.dumps({"conversations": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]}) + "\n")
    t = tables.read_sharegpt(spark, str(p))
    assert sorted((r.turn, r.role, r.text) for r in t.collect()) == [(0, "human", "u"), (0, "system", "s"), (1, "gpt", "a"), (1, "human", "h")]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"conversations": [}\n')
    with pytest.raises(ValueError, match="bad.jsonl at byte 0: not an object"):
        tables.read_sharegpt(spark, str(bad)).collect()
    blank = tmp_path / "blank.jsonl"
    blank.write_text(p.read_text() + "\n" + p.read_text())
    with pytest.raises(ValueError, match=r"blank.jsonl at byte \d+: blank"):
        tables.read_sharegpt(spark, str(blank)).collect()
    assert tables.read_sharegpt(spark, str(blank), strict=False).select("conv_id").distinct().count() == 4


def test_a_stopped_write_leaves_the_earlier_manifest(spark, tmp_path):
    from turnmill.session import write_version

    root = str(tmp_path / "m")
    with pytest.raises(ValueError, match="no committed version"):
        read_version(spark, root)
    write_version(spark.createDataFrame([("a", 1)], "label STRING, rows INT"), root)
    write_version(spark.createDataFrame([("a", 2)], "label STRING, rows INT"), root)
    os.remove(os.path.join(root, "v000002", "_SUCCESS"))  # as if stopped before the commit
    assert [r.rows for r in read_version(spark, root).collect()] == [1]
    write_version(spark.createDataFrame([("a", 3)], "label STRING, rows INT"), root)
    assert versions(spark, root) == [1, 3] and [r.rows for r in read_version(spark, root).collect()] == [3]


def test_hot_label_is_written_by_many_tasks(spark, tmp_path):
    from turnmill.sources import traces

    rows = [(i, f"{i} " + "x" * 90, "hot" if i % 3 else f"l{i % 9}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id INT, text STRING, label STRING")
    traces.write_partitioned(df, str(tmp_path / "o"), file_bytes=20_000)
    files = {d: [f for f in os.listdir(tmp_path / "o" / d) if f.endswith(".json")] for d in os.listdir(tmp_path / "o") if d.startswith("label=")}
    # As many as it has tasks, where the sets ask for more files than that; one for each small label.
    assert len(files["label=hot"]) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(1 <= len(f) <= 3 for d, f in files.items() if d != "label=hot")
    assert sorted(tuple(r) for r in spark.read.json(str(tmp_path / "o")).select("id", "text", "label").collect()) == sorted(rows)


def test_line_addresses_do_not_depend_on_the_split(spark, tmp_path):
    from turnmill.sources import traces

    lines = [json.dumps({"conversations": [{"from": "human", "value": "é" * (i % 40)}]}, ensure_ascii=False) for i in range(800)]
    (tmp_path / "d.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    want, at = [], 0
    for x in lines:
        want.append(at)
        at += len(x.encode()) + 1
    found = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1500", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = traces.dataset_rows(spark, str(tmp_path / "d.jsonl"), "conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>")
        found.append(sorted(r.address for r in traces.line_addresses(rows).collect()))
        found.append(sorted({int(r.conv_id.rsplit("#")[-1]) for r in tables.read_sharegpt(spark, str(tmp_path / "d.jsonl")).select("conv_id").collect()}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(f == want for f in found)


def test_many_mixed_blocks_in_linear_time(spark):
    import time

    from turnmill.sources import traces

    blocks = [f"plain {i}" if i % 3 else {"type": "text", "text": f"é {i}"} for i in range(100_000)]
    line = json.dumps({"type": "user", "message": {"role": "user", "content": blocks}}, ensure_ascii=False)
    df = spark.createDataFrame([("p", 1, line)], "path STRING, ord LONG, value STRING")
    t0 = time.time()
    got = traces.parse_events(df).select("blocks").first().blocks
    assert time.time() - t0 < 30
    assert [b.quoted for b in got] == [isinstance(b, str) for b in blocks]
    assert all(b.raw == x if isinstance(x, str) else json.loads(b.raw) == x for b, x in zip(got, blocks))


def test_conversion_parses_the_log_once(spark, session_dir, monkeypatch):
    """One scan of the text, in the write of the rendered events; counts of
    lines come from that write."""
    from tests.conftest import assistant, text_block, user, write_session
    from turnmill.operators import events as ev_op

    for s in range(3):
        turns = [x for i in range(6) for x in (user(f"question {i}"), assistant([text_block(f"answer {i} of {s}")], mid=f"m{i}"))]
        write_session(session_dir, f"s{s}.jsonl", turns, {3: "{broken"})
    calls, stored = [], ev_op.store
    monkeypatch.setattr(ev_op, "store", lambda df, name: calls.append(df) or stored(df, name))
    out = jobs.build_dataset(spark, session_dir, session_dir + "/out")
    assert len(calls) == 1 and calls[0]._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert spark.read.parquet(out["line_counts"]).collect() == [(39, 3)]
    assert {(r.n_lines, r.n_bad, r.n_lost) for r in spark.read.parquet(out["line_report"]).collect()} == {(13, 1, 0)}


def test_text_is_aggregated_once(spark):
    """One string aggregate over the rows of a chunk; the second one joins
    the pieces of runs that reach into several chunks."""
    from turnmill.operators import turns as turns_op

    turns = tables.conversation_turns(spark, SF)
    plan = turns_op.collapse_runs(turns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("listagg(") == 3 and plan.count("spans") > 0  # one for whole groups, the same and one more for spanning ones
