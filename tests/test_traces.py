"""Hand-made session logs: the edge cases of ingest, chunk merge, block
rendering, turn building, prompt and sanitization. Expected values are
"""

from pyspark.sql import functions as F

from tests.conftest import assistant, text_block, user, write_session
from turnmill.functions.text import PY_WHITESPACE
from turnmill.operators import events as ev_op
from turnmill.operators import signals as sig
from turnmill.operators import turns
from turnmill.plans import jobs
from turnmill.sources import fixture, tables, traces


def events_of(spark, root, include_subagents=False):
    return traces.read_events(spark, root, include_subagents).withColumnRenamed("path", "conv_id")


def convert(spark, root, **kw):
    kw.setdefault("min_messages", 1)
    kw.setdefault("empty_below", 0)
    conv, disp, prompts = jobs.convert_traces(events_of(spark, root), spark, **kw)
    return conv, disp, prompts


def turns_by_file(conv):
    out = {}
    for r in conv.orderBy("conv_id", "turn").collect():
        out.setdefault(r.conv_id.rsplit("/", 1)[-1], []).append((r.role, r.text))
    return out


def merged_of(spark, root, **kw):
    m = ev_op.merge_chunks(events_of(spark, root), **kw)
    return [r.asDict() for r in m.orderBy("conv_id", "seq").collect()]


def test_bad_lines_skipped_order_kept(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("first question"), assistant([text_block("first answer")], mid="m1"),
                                           user("second question"), assistant([text_block("second answer")], mid="m2")],
                  raw_lines={0: "", 2: "{bad", 3: "   "})
    ev = events_of(spark, session_dir)
    assert ev.where("bad").count() == 3
    t = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1:]
    assert t == [("human", "first question"), ("gpt", "first answer"), ("human", "second question"), ("gpt", "second answer")]


def test_non_object_line_dropped_and_counted(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("question here"), assistant("answer here")], raw_lines={1: "[1]"})
    ev = events_of(spark, session_dir)
    assert ev.where("bad").count() == 1
    assert turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1:] == [("human", "question here"), ("gpt", "answer here")]


def test_chunks_merge_across_a_system_event(spark, session_dir):
    write_session(session_dir, "a.jsonl", [
        user("go"),
        assistant([text_block("one")], mid="m"),
        {"type": "system", "content": "note"},
        assistant([text_block("two")], mid="m"),
        assistant([{"type": "tool_use", "name": "Bash", "input": {"command": "ls"}}], mid="m"),
    ])
    m = [r for r in merged_of(spark, session_dir) if r["type"] == "assistant"]
    assert len(m) == 1 and m[0]["n_chunks"] == 3
    assert m[0]["text"] == 'one\n\ntwo\n\n<tool_call>\n{"name": "Bash", "input": {"command":"ls"}}\n</tool_call>'
    order = [r["type"] for r in merged_of(spark, session_dir)]
    assert order == ["user", "assistant"]  # only messages are merged and numbered


def test_id_reuse_after_user_event_starts_new_message(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("q1"), assistant([text_block("a")], mid="m"), user("q2"),
                                           assistant([text_block("b")], mid="m")])
    m = [r["text"] for r in merged_of(spark, session_dir) if r["type"] == "assistant"]
    assert m == ["a", "b"]


def test_keyless_assistant_event_comes_first(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("q"), assistant([text_block("keyed-1")], mid="k1"),
                                           assistant([text_block("keyless")]),
                                           assistant([text_block("keyed-2")], mid="k2")])
    m = [r["text"] for r in merged_of(spark, session_dir) if r["type"] == "assistant"]
    assert m == ["keyless", "keyed-1", "keyed-2"]


def test_string_chunk_after_list_is_lost_and_counted(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("q"), assistant([text_block("kept")], mid="m"), assistant("lost", mid="m"),
                                           assistant([text_block("also kept")], mid="m")])
    m = [r for r in merged_of(spark, session_dir) if r["type"] == "assistant"][0]
    assert m["text"] == "kept\n\nalso kept" and m["n_lost"] == 1


def test_string_first_chunk_drops_later_chunks(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("q"), assistant("head", mid="m"), assistant([text_block("tail")], mid="m")])
    m = [r for r in merged_of(spark, session_dir) if r["type"] == "assistant"][0]
    assert m["text"] == "head" and m["n_lost"] == 1


def test_request_id_only_merges(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("q"), assistant([text_block("x")], mid="", req="r1"),
                                           assistant([text_block("y")], mid="", req="r1")])
    m = [r["text"] for r in merged_of(spark, session_dir) if r["type"] == "assistant"]
    assert m == ["x\n\ny"]


def test_usage_and_uuid_carry(spark, session_dir):
    first = {**assistant([text_block("x")], mid="m"), "uuid": "u1"}
    first["message"]["usage"] = {"output_tokens": 5}
    second = {**assistant([text_block("y")], mid="m"), "uuid": "u2"}
    second["message"]["usage"] = {}
    write_session(session_dir, "a.jsonl", [user("q"), first, second])
    m = [r for r in merged_of(spark, session_dir) if r["type"] == "assistant"][0]
    assert m["usage"] == '{"output_tokens":5}' and m["uuid"] == "u2"


def test_blank_user_between_gpt_turns_merges_them(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("question"), assistant("part one"), user("   "), assistant("part two")])
    t = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1:]
    assert t == [("human", "question"), ("gpt", "part one\n\npart two")]


def test_leading_gpt_and_trailing_human_dropped(spark, session_dir):
    write_session(session_dir, "a.jsonl", [assistant("hello"), user("question"), assistant("answer"), user("bye")])
    t = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1:]
    assert t == [("human", "question"), ("gpt", "answer")]


def test_tool_results_join_and_error_prefix(spark, session_dir):
    write_session(session_dir, "a.jsonl", [
        user("do it"), assistant("calling"),
        user([{"type": "tool_result", "content": "ok output"}]),
        user([{"type": "tool_result", "content": "boom", "is_error": True}]),
        assistant("done"),
    ])
    t = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1:]
    assert t[2] == ("human", "<tool_response>\nok output\n</tool_response>\n\n<tool_response>\nError: boom\n</tool_response>")
    assert len(t) == 4


def test_list_tool_result_and_unknown_blocks(spark, session_dir):
    write_session(session_dir, "a.jsonl", [
        user([{"type": "tool_result", "content": [{"type": "text", "text": "l1"}, {"type": "image"}, {"type": "text", "text": "l2"}]},
              {"type": "mystery", "x": 1}, {"type": "image", "source": {}}, "plain string"]),
        assistant("fine"),
    ])
    t = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1:]
    assert t[0] == ("human", "<tool_response>\nl1\n[image]\nl2\n</tool_response>\n\n[image]\n\nplain string")


def test_thinking_toggle(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("q?"), assistant([{"type": "thinking", "thinking": "hmm"}, text_block("answer")], mid="m")])
    on = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][2]
    off = turns_by_file(convert(spark, session_dir, include_thinking=False)[0])["a.jsonl"][2]
    assert on == ("gpt", "<think>\nhmm\n</think>\n\nanswer") and off == ("gpt", "answer")


def test_unicode_whitespace_stripped_like_python(spark, session_dir):
    padded = "\x1c\xa0\t question \u3000\u2009\n"
    write_session(session_dir, "a.jsonl", [user(padded), assistant("answer")])
    t = turns_by_file(convert(spark, session_dir)[0])["a.jsonl"][1]
    assert t == ("human", padded.strip())
    assert all(c.isspace() for c in PY_WHITESPACE)


def test_literal_prefix_sanitizing(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("open /home/alice/x and /home/al/y", cwd="/home/al/proj"), assistant("ok")])
    conv, _, prompts = convert(spark, session_dir, rules=[("/home/al", "/home/user")])
    t = turns_by_file(conv)["a.jsonl"]
    assert t[1] == ("human", "open /home/userice/x and /home/user/y")
    assert "runs in /home/user/proj on linux" in prompts.first().prompt


def test_windows_platform_and_branch_rules(spark, session_dir):
    write_session(session_dir, "w.jsonl", [user("question", cwd="C:\\Users\\me\\p", gitBranch="HEAD"), assistant("a")])
    write_session(session_dir, "e.jsonl", [user("question", cwd="E:/work", gitBranch="dev"), assistant("a")])
    meta = {r.conv_id.rsplit("/", 1)[-1]: r for r in ev_op.conversation_metadata(events_of(spark, session_dir)).collect()}
    assert meta["w.jsonl"].platform == "win32" and meta["e.jsonl"].platform == "win32"
    prompts = {r.conv_id.rsplit("/", 1)[-1]: r.prompt for r in convert(spark, session_dir)[2].collect()}
    assert "branch" not in prompts["w.jsonl"] and prompts["e.jsonl"].endswith(", branch dev.")


def test_mcp_and_unknown_tools_in_prompt(spark, session_dir):
    write_session(session_dir, "a.jsonl", [
        user("q"),
        assistant([{"type": "tool_use", "name": "mcp__z__b", "input": {}}, {"type": "tool_use", "name": "mcp__a__c", "input": {}},
                   {"type": "tool_use", "name": "Frobnicate", "input": {}}, {"type": "tool_use", "name": "WebSearch", "input": {}}], mid="m"),
    ])
    p = convert(spark, session_dir)[2].first().prompt
    assert "mcp__a__c, mcp__z__b" in p and "Frobnicate" not in p
    assert p.index("* `Bash(") < p.index("* `Edit(") < p.index("* `WebSearch(")


def test_too_short_by_message_count(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("question"), assistant("answer"), user("more")])
    _, disp, _ = convert(spark, session_dir, min_messages=4)
    assert [r.disposition for r in disp.collect()] == ["too_short"]


def test_duplicate_first_pair_keeps_first_path(spark, session_dir):
    body = [user("same question " * 10), assistant("same answer " * 10)]
    write_session(session_dir, "a.jsonl", body + [user("tail a"), assistant("x")])
    write_session(session_dir, "b.jsonl", body + [user("tail b"), assistant("y")])
    _, disp, _ = convert(spark, session_dir)
    d = {r.conv_id.rsplit("/", 1)[-1]: r.disposition for r in disp.collect()}
    assert d == {"a.jsonl": "ok", "b.jsonl": "duplicate"}


def test_subagent_files_excluded_unless_asked(spark, session_dir):
    write_session(session_dir, "main.jsonl", [user("q"), assistant("a")])
    write_session(session_dir, "x/subagents/s.jsonl", [user("q"), assistant("a")])
    assert events_of(spark, session_dir).select("conv_id").distinct().count() == 1
    assert events_of(spark, session_dir, include_subagents=True).select("conv_id").distinct().count() == 2


def test_bad_tool_json_and_non_object_input(spark):
    rows = [(1, 1, "gpt", '<tool_call>\n{"name": "Edit", bad}\n</tool_call>\n<tool_call>{"name": "Edit", "input": 3}</tool_call>')]
    t = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    s = sig.conversation_signals(t).first()
    assert s.n_calls == 1 and s.n_edit == 1 and s.n_files == 0


def test_loose_path_patterns(spark):
    call = '<tool_call>{{"name": "Read", "input": {{"file_path": "{p}"}}}}</tool_call>'
    text = "\n".join(call.format(p=p) for p in ["/x/latest/x.py", "/x/data.json", "/x/a.css\\n"])
    t = spark.createDataFrame([(1, 1, "gpt", text)], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    s = sig.conversation_signals(t).first()
    assert (s.test_files, s.config_files, s.frontend_files, s.n_files) == (1, 1, 0, 3)


def test_build_dataset_job_writes_tables(spark, session_dir, tmp_path):
    write_session(session_dir, "a.jsonl", [user("q " * 60), assistant("a " * 60), user("MARK then more"), assistant("b")])
    out = jobs.build_dataset(spark, session_dir, str(tmp_path / "out"), min_messages=1, marker="MARK")
    assert spark.read.parquet(out["dispositions"]).first().disposition == "ok"
    assert [tuple(r)[1:] for r in spark.read.parquet(out["line_report"]).collect()] == [(4, 0, 0)]
    assert spark.read.parquet(out["split_ledger"]).first().segments_out == 2
    assert spark.read.parquet(out["statistics"]).first().conversations == 1
    assert spark.read.parquet(out["fit_under_limit"]).count() == 6
    assert {r.stat for r in spark.read.parquet(out["length_distribution"]).collect()} >= {"min", "max"}
    segs = spark.read.parquet(out["segments"])
    assert sorted(r.segment for r in segs.select("segment").distinct().collect()) == [0, 1]
    assert segs.where("role = 'system'").count() == 2
    # Edge format round trip through the strict reader.
    back = tables.read_sharegpt(spark, out["segments_jsonl"])
    assert back.select("conv_id").distinct().count() == 2 and back.count() == segs.count()
    assert sorted(r.role for r in back.where("turn = 0").collect()) == ["system", "system"]


def test_empty_rule_counts_non_system_characters(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("short"), assistant("reply")])
    _, disp, _ = convert(spark, session_dir, empty_below=100)
    assert [r.disposition for r in disp.collect()] == ["empty"]


def test_tool_input_is_kept_as_written(spark, session_dir):
    """Key order, the last of repeated keys, non-ASCII text."""
    raw = ('{"type":"assistant","message":{"role":"assistant","id":"m","content":[{"type":"tool_use","name":"Edit",'
           '"input":{"z":1,"a":{"y":[1, 2],"b":"é"},"z":3}}]}}')
    write_session(session_dir, "a.jsonl", [user("question")], raw_lines={1: raw})
    m = [r for r in merged_of(spark, session_dir) if r["type"] == "assistant"]
    assert m[0]["text"] == '<tool_call>\n{"name": "Edit", "input": {"z":1,"a":{"y":[1,2],"b":"é"},"z":3}}\n</tool_call>'
    t = spark.createDataFrame([(1, 1, "gpt", '<tool_call>{"name":"x","name":"Edit","input":{"file_path":"/a","file_path":"/b.py"}}</tool_call>')],
                              "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    assert [tuple(r) for r in sig.tool_calls(t).select("name", "file_path").collect()] == [("Edit", "/b.py")]


def test_strings_that_look_like_json(spark, session_dir):
    write_session(session_dir, "a.jsonl", [
        user("[1, 2]"),
        assistant(['{"type":"text","text":"no block"}', text_block("block"), "[]", 7, None, {"type": "tool_result", "content": "[3]"},
                   {"type": "tool_result", "content": ['{"type":"image"}', {"type": "image"}], "is_error": 1}], mid="m"),
    ])
    t = [r["text"] for r in merged_of(spark, session_dir)]
    assert t[0] == "[1, 2]"
    assert t[1] == ('{"type":"text","text":"no block"}\n\nblock\n\n[]\n\n<tool_response>\n[3]\n</tool_response>\n\n'
                    '<tool_response>\nError: {"type":"image"}\n[image]\n</tool_response>')


def test_empty_message_object_is_no_message(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("question"), assistant("answer"), {"type": "user", "message": {}},
                                           {"type": "user", "message": {"x": 1}}, {"type": "user", "message": None}])
    ev = events_of(spark, session_dir).orderBy("ord")
    assert [r.has_message for r in ev.collect()] == [True, True, False, True, False]
    _, disp, _ = convert(spark, session_dir, min_messages=4)
    assert [(r.n_messages, r.disposition) for r in disp.collect()] == [(3, "too_short")]


def test_very_long_content_is_parsed(spark, session_dir):
    n = 150_000_000
    write_session(session_dir, "a.jsonl", [user("x" * n), assistant("answer")])
    ev = events_of(spark, session_dir).orderBy("ord").select("bad", F.length("content").alias("n")).collect()
    assert [(r.bad, r.n) for r in ev] == [(False, n), (False, 6)]


def test_file_of_bad_lines_is_a_parse_error(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("question"), assistant("answer")])
    write_session(session_dir, "b.jsonl", [], raw_lines={0: "{bad", 1: "[1]"})
    _, disp, _ = convert(spark, session_dir)
    assert {r.conv_id.rsplit("/", 1)[-1]: r.disposition for r in disp.collect()} == {"a.jsonl": "ok", "b.jsonl": "parse_error"}


def test_pairs_that_join_to_the_same_text_are_different(spark, session_dir):
    write_session(session_dir, "a.jsonl", [user("a\u0001b"), assistant("c")])
    write_session(session_dir, "b.jsonl", [user("a"), assistant("b\u0001c")])
    _, disp, _ = convert(spark, session_dir)
    assert [r.disposition for r in disp.collect()] == ["ok", "ok"]


def test_one_epoch_hot_session_numbers_messages(spark, monkeypatch):
    """Thousands of replies after one user event, cut in small file chunks."""
    rows = [("s", 0, '{"type":"user","message":{"role":"user","content":"q"}}')]
    for i in range(1, 400):
        mid = f'"id":"m{i // 2}",' if i % 5 else ""
        rows.append(("s", i, '{"type":"assistant","message":{%s"role":"assistant","content":[{"type":"text","text":"t%d"}]}}' % (mid, i)))
        rows.append(("s", 1000 + i, '{"type":"progress"}'))
    ev = traces.parse_events(spark.createDataFrame(rows, "path STRING, ord BIGINT, value STRING")).withColumnRenamed("path", "conv_id")
    whole = [tuple(r) for r in ev_op.merge_chunks(ev).orderBy("seq").select("seq", "text", "n_chunks").collect()]
    monkeypatch.setattr(ev_op, "CHUNK_ROWS", 7)
    cut = [tuple(r) for r in ev_op.merge_chunks(ev).orderBy("seq").select("seq", "text", "n_chunks").collect()]
    assert whole == cut and [r[0] for r in whole] == list(range(1, len(whole) + 1))
    keyless = [f"t{i}" for i in range(5, 400, 5)]
    assert [r[1] for r in whole[1 : 1 + len(keyless)]] == keyless


def test_windows_profile_rules_cover_three_spellings():
    from turnmill.operators.render import home_rules

    rules = home_rules("C:\\Users\\al", windows=True)
    assert [old for old, _ in rules] == ["C:\\Users\\al", "C:\\\\Users\\\\al", "/c/Users/al"]
    assert all(new == "/home/user" for _, new in rules)
    assert home_rules("/home/al") == [("/home/al", "/home/user")] and home_rules("") == []


def test_text_meets_its_group_in_one_exchange(spark):
    """The layout in which text and groups meet serves the aggregate too;
    groups that reach into several chunks are put together from pieces."""
    from turnmill.functions.text import ordered_join
    from turnmill.operators.gather import gather

    text = spark.createDataFrame([(k, i // 4, i, f"{k}{i}") for k in "ab" for i in range(8)] + [("c", None, 1, "x")], "k STRING, chunk BIGINT, at BIGINT, text STRING")

    def gathered(size):
        groups = [(k, i // 4, i, i // size, i // size * size // 4 != (i // size * size + size - 1) // 4) for k in "ab" for i in range(8)]
        groups = spark.createDataFrame(groups, "k STRING, chunk BIGINT, at BIGINT, g BIGINT, spans BOOLEAN")
        out = gather(text, groups, ["k", "chunk"], ["at"], ["k", "g"], {"text": ordered_join("text", "at", ",")}, {"text": ordered_join("text", "chunk", ",")})
        return sorted(tuple(r) for r in out.collect()), out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        got, plan = gathered(2)
        across, _ = gathered(3)
    finally:
        spark.conf.set(setting, before)
    assert got == [(k, g, f"{k}{2 * g},{k}{2 * g + 1}") for k in "ab" for g in range(4)]
    assert across == [(k, g, ",".join(f"{k}{i}" for i in range(3 * g, min(3 * g + 3, 8)))) for k in "ab" for g in range(3)]
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_json_string_keeps_brackets_and_nulls(spark):
    from turnmill.functions.text import json_string

    rows = spark.createDataFrame([("a]",), ('"]]',), ("",), (None,), ("[é\n",)], "s STRING").select(json_string("s")).collect()
    assert [r[0] for r in rows] == ['"a]"', r'"\"]]"', '""', "null", r'"[é\n"']


def test_only_lists_are_parsed_as_lists(spark, session_dir):
    """Texts that begin like a list, in a message and in a tool result, stay texts."""
    result = lambda c: {"type": "tool_result", "tool_use_id": "t", "content": c}
    write_session(session_dir, "a.jsonl", [user("[1] first"), user([result("[2]"), result([text_block("x"), "y"]), result("plain"), result([])])])
    texts = [r["text"] for r in merged_of(spark, session_dir)]
    assert texts == ["[1] first", "\n\n".join(f"<tool_response>\n{t}\n</tool_response>" for t in ("[2]", "x\ny", "plain", ""))]


def test_session_lines_are_dealt_to_all_partitions(spark, tmp_path):
    rows = spark.range(40).selectExpr("id AS event_id", "timestamp_seconds(1700000000 + id) AS ts", "id % 3 AS user_id", "'view' AS event_type", "'{\"k\": 1}' AS props")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fixture.trace_lines(spark, str(tmp_path)).rdd.getNumPartitions() == n


def test_run_ids_are_worked_out_once(spark, monkeypatch):
    plans, repair = [], turns.repair_alternation
    monkeypatch.setattr(turns, "repair_alternation", lambda runs, key: plans.append(
        runs._jdf.queryExecution().executedPlan().toString()) or repair(runs, key))
    rows = [(1, 1, "human", "a"), (1, 2, "gpt", "b"), (1, 3, "gpt", " "), (2, 1, "gpt", "c")]
    conv, _ = turns.build_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), min_messages=1, empty_below=0)
    assert [(x.turn, x.text) for x in conv.where("conv_id = 1").orderBy("turn").collect()] == [(1, "a"), (2, "b")]
    assert len(plans) == 1 and "Window" not in plans[0] and "Exchange" not in plans[0]
