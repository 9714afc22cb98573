"""Independent DuckDB formulations of the registered queries.

Written separately from the Spark operators (correlated subqueries,
self-joins and list functions instead of the Spark windows) so that an
agreement means something. Tables are the driver's views.

Fixed values in here (word lists, patterns, thresholds of the rule cascade,
reason formats, token limits) equal those of ``functions.fixed`` on purpose
and are stated again as SQL text.
"""

from __future__ import annotations

MARKER = "thti"

# Conversations in ShareGPT roles.
CONV = """
conv AS (
  SELECT conv_id, turn,
         CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS role,
         text
  FROM conversations
)"""

def segments_sql(marker: str) -> str:
    """Segmentation CTEs over a ``conv(conv_id, turn, role, text)`` CTE."""
    return SEGMENTS_BODY.replace("@MARKER@", marker.replace("'", "''"))


SEGMENTS_BODY = """,
first_turn AS (SELECT conv_id, min(turn) AS t0 FROM conv GROUP BY conv_id),
marked AS (
  SELECT c.*, (c.turn = f.t0 AND c.role = 'system') AS is_head
  FROM conv c JOIN first_turn f USING (conv_id)
),
body AS (SELECT * FROM marked WHERE NOT is_head),
hits AS (SELECT conv_id, turn FROM body WHERE contains(text, '@MARKER@')),
first_body AS (SELECT conv_id, min(turn) AS tb FROM body GROUP BY conv_id),
lead_hit AS (
  SELECT f.conv_id, CASE WHEN h.turn IS NULL THEN 0 ELSE 1 END AS lead
  FROM first_body f LEFT JOIN hits h ON h.conv_id = f.conv_id AND h.turn = f.tb
),
body_seg AS (
  SELECT b.conv_id, b.turn, b.role, b.text,
         (SELECT count(*) FROM hits h WHERE h.conv_id = b.conv_id AND h.turn <= b.turn) - l.lead AS segment
  FROM body b JOIN lead_hit l USING (conv_id)
),
seg_ids AS (SELECT DISTINCT conv_id, segment FROM body_seg),
head_rows AS (
  SELECT m.conv_id, coalesce(s.segment, 0) AS segment, m.turn, m.role, m.text
  FROM marked m LEFT JOIN seg_ids s USING (conv_id)
  WHERE m.is_head
),
segments AS (
  SELECT conv_id, CAST(segment AS BIGINT) AS segment, turn, role, text FROM body_seg
  UNION ALL
  SELECT conv_id, CAST(segment AS BIGINT), turn, role, text FROM head_rows
),
seg_len AS (
  SELECT conv_id, segment, CAST(sum(length(text)) AS BIGINT) AS n_chars, count(*) AS n_turns
  FROM segments GROUP BY conv_id, segment
)"""

SEGMENTS = CONV + segments_sql(MARKER)

SQL: dict[str, str] = {}

SQL["segment_turns"] = "WITH" + SEGMENTS + "\nSELECT * FROM segments"

SQL["segment_lengths"] = "WITH" + SEGMENTS + "\nSELECT * FROM seg_len"

SQL["segment_ledger"] = "WITH" + SEGMENTS + """,
per AS (SELECT conv_id, count(DISTINCT segment) AS n FROM segments GROUP BY conv_id)
SELECT count(*) AS conversations_in, CAST(sum(n) AS BIGINT) AS segments_out,
       CAST(sum(n - 1) AS BIGINT) AS added_by_splits,
       count(*) FILTER (WHERE n > 1) AS conversations_split
FROM per"""

SQL["length_percentiles"] = "WITH" + SEGMENTS + """,
ranked AS (SELECT n_chars, row_number() OVER (ORDER BY n_chars) - 1 AS i, count(*) OVER () AS n FROM seg_len),
wanted AS (
  SELECT * FROM (VALUES ('min', 0), ('p10', 1), ('p25', 2), ('median', 3), ('p75', 4),
                        ('p90', 5), ('p95', 6), ('max', 7)) v(stat, stat_order)
),
n AS (SELECT count(*) AS n FROM seg_len),
pos AS (
  SELECT stat, stat_order, n,
         CASE stat WHEN 'min' THEN 0 WHEN 'p10' THEN n // 10 WHEN 'p25' THEN n // 4
                   WHEN 'median' THEN n // 2 WHEN 'p75' THEN (3 * n) // 4
                   WHEN 'p90' THEN (9 * n) // 10 WHEN 'p95' THEN CAST(floor(n * 0.95) AS BIGINT)
                   ELSE n - 1 END AS i
  FROM wanted, n
)
SELECT p.stat, CAST(p.stat_order AS BIGINT) AS stat_order, CAST(p.n AS BIGINT) AS n,
       CAST(r.n_chars AS BIGINT) AS chars, CAST(r.n_chars // 4 AS BIGINT) AS tokens
FROM pos p JOIN ranked r ON r.i = p.i"""

SQL["fit_under_limit"] = "WITH" + SEGMENTS + """,
limits AS (SELECT * FROM (VALUES (4096), (8192), (16384), (32768), (65536), (131072)) v(limit_tokens))
SELECT CAST(l.limit_tokens AS BIGINT) AS limit_tokens, CAST(l.limit_tokens * 4 AS BIGINT) AS limit_chars,
       CAST(count(s.n_chars) AS BIGINT) AS n_fit, CAST((SELECT count(*) FROM seg_len) AS BIGINT) AS n_total,
       CAST(count(s.n_chars) AS DOUBLE) * 100.0::DOUBLE / CAST((SELECT count(*) FROM seg_len) AS DOUBLE) AS pct
FROM limits l LEFT JOIN seg_len s ON s.n_chars <= l.limit_tokens * 4
GROUP BY l.limit_tokens"""


def _chars(s: str) -> str:
    return "(" + "||".join(f"chr({ord(c)})" for c in s) + ")"


def _ws() -> str:
    from ..functions.text import PY_WHITESPACE

    return _chars(PY_WHITESPACE)


NL2 = "(chr(10)||chr(10))"

PERTURBED = CONV + f""",
pert AS (
  SELECT conv_id, turn,
         CASE WHEN role <> 'system' AND turn % 3 = 2 THEN 'gpt' ELSE role END AS role,
         CASE WHEN (conv_id + turn) % 11 = 0 THEN ' '||chr(10)||chr(9)||' ' ELSE text END AS text
  FROM conv
)"""


def runs_sql(src: str) -> str:
    """Islands by the row-number difference, from table ``src``."""
    return f""",
msgs AS (SELECT conv_id, turn, role, trim(text, {_ws()}) AS text FROM {src} WHERE role IN ('human', 'gpt')),
msg_count AS (SELECT conv_id, count(*) AS n_messages FROM {src} WHERE role IN ('human', 'gpt') GROUP BY conv_id),
nonblank AS (SELECT * FROM msgs WHERE length(text) > 0),
isl AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn)
            - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS grp
  FROM nonblank
),
runs0 AS (
  SELECT conv_id, role, grp, min(turn) AS first_turn, count(*) AS n_parts,
         string_agg(text, {NL2} ORDER BY turn) AS text
  FROM isl GROUP BY conv_id, role, grp
),
runs AS (
  SELECT r.conv_id, CAST(rank() OVER (PARTITION BY r.conv_id ORDER BY r.first_turn) AS BIGINT) AS run,
         r.role, r.text, r.first_turn, CAST(r.n_parts AS BIGINT) AS n_parts, CAST(m.n_messages AS BIGINT) AS n_messages
  FROM runs0 r JOIN msg_count m USING (conv_id)
),
bounds AS (
  SELECT conv_id, min(run) FILTER (WHERE role = 'human') AS first_h, max(run) AS last_run
  FROM runs GROUP BY conv_id
),
kept AS (
  SELECT r.conv_id, CAST(row_number() OVER (PARTITION BY r.conv_id ORDER BY r.run) AS BIGINT) AS turn,
         r.role, r.text, r.n_parts
  FROM runs r JOIN bounds b USING (conv_id)
  WHERE r.run >= b.first_h AND NOT (r.run = b.last_run AND r.role = 'human')
)"""


SQL["turn_collapse"] = "WITH" + PERTURBED + runs_sql("pert") + """
SELECT conv_id, run, role, text, first_turn, n_parts FROM runs"""

SQL["alternation_repair"] = "WITH" + PERTURBED + runs_sql("pert") + """
SELECT * FROM kept"""

DISPOSITIONS = "WITH" + PERTURBED + """,
copies AS (SELECT * FROM pert UNION ALL SELECT -conv_id - 1, turn, role, text FROM pert)""" + runs_sql("copies") + f""",
heads AS (
  SELECT c.conv_id, c.text FROM copies c
  WHERE c.role = 'system' AND c.turn = (SELECT min(turn) FROM copies x WHERE x.conv_id = c.conv_id)
),
allc AS (SELECT conv_id, count(*) FILTER (WHERE role IN ('human', 'gpt')) AS n_messages FROM copies GROUP BY conv_id),
ks AS (
  SELECT conv_id, count(*) AS n_turns, sum(length(text)) AS body_chars,
         max(CASE WHEN turn = 1 THEN text END) AS h, max(CASE WHEN turn = 2 THEN text END) AS g
  FROM kept GROUP BY conv_id
),
summary AS (
  SELECT a.conv_id, CAST(a.n_messages AS BIGINT) AS n_messages,
         CAST(coalesce(k.n_turns, 0) AS BIGINT) AS n_turns,
         CAST(coalesce(k.body_chars, 0) AS BIGINT) AS body_chars,
         CAST(coalesce(k.body_chars, 0) + coalesce((SELECT length(h.text) FROM heads h WHERE h.conv_id = a.conv_id), 0) AS BIGINT) AS total_chars,
         CASE WHEN k.h IS NOT NULL AND k.g IS NOT NULL THEN struct_pack(h := k.h, g := k.g) END AS pair_hash
  FROM allc a LEFT JOIN ks k USING (conv_id)
),
pre AS (
  SELECT *, CASE WHEN n_messages < 4 THEN 'too_short' WHEN n_turns < 2 THEN 'too_short'
                 WHEN total_chars > 4000 THEN 'too_long' WHEN body_chars < 100 THEN 'empty' END AS pre
  FROM summary
),
disp AS (
  SELECT p.conv_id, p.n_messages, p.n_turns, p.total_chars, p.body_chars, p.pair_hash,
         coalesce(p.pre, CASE WHEN EXISTS (SELECT 1 FROM pre q WHERE q.pre IS NULL AND q.pair_hash = p.pair_hash
                                           AND q.conv_id < p.conv_id) THEN 'duplicate' ELSE 'ok' END) AS disposition
  FROM pre p
)"""

SQL["disposition_ledger"] = DISPOSITIONS + "\nSELECT disposition, count(*) AS n FROM disp GROUP BY disposition"

SQL["length_band"] = DISPOSITIONS + "\nSELECT conv_id, n_messages, n_turns, total_chars, body_chars, disposition FROM disp"

SQL["dedup_first_pair"] = DISPOSITIONS + """
SELECT min(conv_id) AS kept_conv_id, count(*) AS n_copies
FROM disp WHERE disposition IN ('ok', 'duplicate') GROUP BY pair_hash"""

SQL["clean_conversations"] = DISPOSITIONS + """
SELECT h.conv_id, CAST(0 AS BIGINT) AS turn, 'system' AS role, h.text FROM heads h
WHERE h.conv_id IN (SELECT conv_id FROM disp WHERE disposition = 'ok')
UNION ALL
SELECT k.conv_id, k.turn, k.role, k.text FROM kept k
WHERE k.conv_id IN (SELECT conv_id FROM disp WHERE disposition = 'ok')"""


# ------------------------------------------------------------ trace fixture
TRACE = """
ev AS (
  SELECT event_id, ts, event_type, user_id,
         CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k,
         user_id % 10 AS persona,
         CAST(user_id * 1000 + floor((day(ts) - 1) / (1 + user_id % 4)) AS BIGINT) AS conv_id
  FROM events
),
ev2 AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY ts, event_id) AS BIGINT) AS turn,
         CASE WHEN event_type IN ('signup', 'error') THEN 'human' ELSE 'gpt' END AS role
  FROM ev
),
ev3 AS (
  SELECT *,
    CASE WHEN role = 'human' THEN NULL
         WHEN persona = 0 THEN CASE WHEN k % 5 IN (0, 2) THEN 'Edit' WHEN k % 5 = 4 THEN 'Read' ELSE 'Write' END
         WHEN persona = 1 THEN CASE k % 3 WHEN 0 THEN 'Grep' WHEN 1 THEN 'Glob' ELSE 'Read' END
         WHEN persona = 2 THEN CASE WHEN k % 2 = 0 THEN 'Edit' ELSE 'Bash' END
         WHEN persona = 4 THEN 'Bash'
         WHEN persona IN (5, 6, 7) THEN CASE k % 3 WHEN 0 THEN 'Edit' WHEN 1 THEN 'Bash' ELSE 'Read' END
         WHEN persona = 8 THEN 'Edit'
         WHEN persona = 9 AND k % 4 = 0 THEN 'Edit'
    END AS tool,
    CASE WHEN persona = 3 THEN 200 + k ELSE 1 + k END AS think_len
  FROM ev2
),
ev4 AS (
  SELECT *,
    CASE WHEN tool IN ('Edit', 'Write', 'Read') THEN
      CASE WHEN persona = 5 THEN CASE WHEN k % 2 = 0 THEN '/home/dev/src/a.tsx' ELSE '/home/dev/web/b.css' END
           WHEN persona = 6 THEN CASE WHEN k % 2 = 0 THEN '/home/dev/ci/app.yaml' ELSE '/home/dev/pyproject.toml' END
           WHEN persona = 7 THEN CASE WHEN k % 2 = 0 THEN '/home/dev/pkg/tests/a.py' ELSE '/home/dev/pkg/m_test.go' END
           ELSE '/home/dev/src/m' || k || '.py' END END AS file_path,
    CASE WHEN tool = 'Bash' THEN CASE WHEN persona = 7 THEN 'pytest -q' ELSE 'git status' END END AS command,
    CASE WHEN tool IN ('Grep', 'Glob') THEN 'x' || k END AS pattern
  FROM ev3
),
ev5 AS (
  SELECT *,
    CASE WHEN file_path IS NOT NULL THEN '{"file_path":"' || file_path || '"}'
         WHEN command IS NOT NULL THEN '{"command":"' || command || '"}'
         WHEN pattern IS NOT NULL THEN '{"pattern":"' || pattern || '"}' END AS input_json
  FROM ev4
),
trace AS (
  SELECT conv_id, turn, role,
    CASE WHEN event_type = 'signup' THEN 'Please handle task ' || event_id
         WHEN event_type = 'error' THEN '<tool_response>' || chr(10) || 'Error: step ' || k || ' failed' || chr(10) || '</tool_response>'
         ELSE '<think>' || chr(10) || repeat('x', think_len) || chr(10) || '</think>' || chr(10) || chr(10) || 'Working on it.'
              || CASE WHEN tool IS NULL THEN '' ELSE chr(10) || chr(10) || '<tool_call>' || chr(10) || '{"name": "' || tool
                      || '", "input": ' || input_json || '}' || chr(10) || '</tool_call>' END
    END AS text
  FROM ev5
  UNION ALL
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 'system', 'system for ' || conv_id FROM ev
)"""

CALLS = TRACE + r""",
call_lists AS (
  SELECT conv_id, turn, regexp_extract_all(text, '(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>', 1) AS l
  FROM trace WHERE role = 'gpt'
),
raw_calls AS (SELECT conv_id, turn, unnest(l) AS c, generate_subscripts(l, 1) AS i FROM call_lists),
calls AS (
  SELECT conv_id, turn, i, coalesce(json_extract_string(c, '$.name'), '') AS name,
         json_extract_string(c, '$.input.file_path') AS file_path,
         json_extract_string(c, '$.input.command') AS command
  FROM raw_calls WHERE json_valid(c)
),
files AS (
  SELECT conv_id, lower(file_path) AS p FROM calls
  WHERE name IN ('Edit', 'Write', 'Read') AND file_path IS NOT NULL AND file_path <> ''
),
cmds AS (
  SELECT conv_id, command AS c, lower(command) AS lc FROM calls
  WHERE name = 'Bash' AND command IS NOT NULL AND command <> ''
)"""

FE_RE = r"(\.tsx|\.jsx|\.css|\.scss|\.less|\.html|\.vue|\.svelte|\.astro|\.ejs|\.hbs|\.pug)$"
CFG_RE = (r"(\.yaml|\.yml|\.toml|\.ini|\.cfg|\.env|\.json|\.xml)$|(dockerfile|docker-compose|makefile|cmakelists|"
          r"\.gitignore|\.eslintrc|\.prettierrc|tsconfig|package\.json|pyproject\.toml|setup\.py|setup\.cfg|"
          r"cargo\.toml|go\.mod|pom\.xml|build\.gradle)")
TEST_RE = r"(test[_/]|_test\.|\.test\.|\.spec\.|tests/|__tests__/|spec/|pytest|jest|mocha|vitest)"
TCMD_RE = r"(pytest|jest|npm test|cargo test|go test|vitest|mocha|rspec|unittest|make test)"
BCMD_RE = r"(npm |yarn |pip |cargo |make|docker |go build|mvn |gradle)"

SIGNALS = CALLS + f""",
turn_agg AS (
  SELECT conv_id, count(*) AS n_turns,
         CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'gpt'), 0) AS BIGINT) AS gpt_chars,
         CAST(coalesce(sum(list_sum(list_transform(regexp_extract_all(text, '(?s)<think>(.*?)</think>', 1), lambda m: length(m))))
              FILTER (WHERE role = 'gpt'), 0) AS BIGINT) AS think_chars,
         count(*) FILTER (WHERE role = 'human' AND contains(text, '<tool_response>')
              AND (contains(lower(text), 'error') OR contains(lower(text), 'traceback')
                   OR contains(lower(text), 'failed') OR contains(lower(text), 'exception'))) AS error_turns
  FROM trace GROUP BY conv_id
),
call_agg AS (
  SELECT conv_id, count(*) AS n_calls,
         count(*) FILTER (WHERE name = 'Edit') AS n_edit, count(*) FILTER (WHERE name = 'Write') AS n_write,
         count(*) FILTER (WHERE name = 'Read') AS n_read, count(*) FILTER (WHERE name = 'Bash') AS n_bash,
         count(*) FILTER (WHERE name = 'Grep') AS n_grep, count(*) FILTER (WHERE name = 'Glob') AS n_glob
  FROM calls GROUP BY conv_id
),
file_agg AS (
  SELECT conv_id, count(*) AS n_files,
         count(*) FILTER (WHERE regexp_matches(p, '{FE_RE}')) AS frontend_files,
         count(*) FILTER (WHERE regexp_matches(p, '{CFG_RE}')) AS config_files,
         count(*) FILTER (WHERE regexp_matches(p, '{TEST_RE}')) AS test_files
  FROM files GROUP BY conv_id
),
cmd_agg AS (
  SELECT conv_id, count(*) AS n_cmds,
         count(*) FILTER (WHERE regexp_matches(lc, '{TCMD_RE}')) AS test_cmds,
         count(*) FILTER (WHERE starts_with(trim(c, {_ws()}), 'git ')) AS git_cmds,
         count(*) FILTER (WHERE regexp_matches(lc, '{BCMD_RE}')) AS build_cmds
  FROM cmds GROUP BY conv_id
),
signals AS (
  SELECT t.conv_id, CAST(t.n_turns AS BIGINT) AS n_turns, t.gpt_chars, t.think_chars,
    CAST(coalesce(c.n_calls, 0) AS BIGINT) AS n_calls, CAST(coalesce(c.n_edit, 0) AS BIGINT) AS n_edit,
    CAST(coalesce(c.n_write, 0) AS BIGINT) AS n_write, CAST(coalesce(c.n_read, 0) AS BIGINT) AS n_read,
    CAST(coalesce(c.n_bash, 0) AS BIGINT) AS n_bash, CAST(coalesce(c.n_grep, 0) AS BIGINT) AS n_grep,
    CAST(coalesce(c.n_glob, 0) AS BIGINT) AS n_glob, CAST(t.error_turns AS BIGINT) AS error_turns,
    CAST(coalesce(f.n_files, 0) AS BIGINT) AS n_files, CAST(coalesce(f.frontend_files, 0) AS BIGINT) AS frontend_files,
    CAST(coalesce(f.config_files, 0) AS BIGINT) AS config_files, CAST(coalesce(f.test_files, 0) AS BIGINT) AS test_files,
    CAST(coalesce(m.n_cmds, 0) AS BIGINT) AS n_cmds, CAST(coalesce(m.test_cmds, 0) AS BIGINT) AS test_cmds,
    CAST(coalesce(m.git_cmds, 0) AS BIGINT) AS git_cmds, CAST(coalesce(m.build_cmds, 0) AS BIGINT) AS build_cmds,
    CAST(coalesce(c.n_calls, 0) + t.error_turns AS BIGINT) AS total,
    CAST(t.think_chars AS DOUBLE) / CAST(greatest(t.gpt_chars, 1) AS DOUBLE) AS think_share
  FROM turn_agg t LEFT JOIN call_agg c USING (conv_id) LEFT JOIN file_agg f USING (conv_id)
  LEFT JOIN cmd_agg m USING (conv_id)
),
classified AS (
  SELECT *,
    CASE WHEN n_turns < 3 THEN 1
         WHEN n_turns <= 5 AND total <= 2 THEN 2
         WHEN think_share > 0.5 AND total <= 3 THEN 3
         WHEN test_files >= 2 OR (test_files >= 1 AND test_cmds >= 1) THEN 4
         WHEN test_cmds >= 2 THEN 5
         WHEN frontend_files >= 2 OR (frontend_files >= 1 AND frontend_files / greatest(n_files, 1) > 0.4) THEN 6
         WHEN config_files >= 2 OR (config_files >= 1 AND config_files / greatest(n_files, 1) > 0.5) THEN 7
         WHEN error_turns >= 2 AND n_edit >= 1 THEN 8
         WHEN n_bash >= 3 AND n_edit <= 1 THEN 9
         WHEN n_grep + n_glob + n_read >= 4 AND n_edit + n_write <= 1 THEN 10
         WHEN n_edit >= 4 AND n_write <= 1 THEN 11
         WHEN n_edit + n_write >= 2 THEN 12
         WHEN total >= 2 THEN 13
         ELSE 14 END AS rule
  FROM signals
),
labeled AS (
  SELECT *,
    CASE WHEN rule IN (1, 2, 14) THEN 'compact' WHEN rule = 3 THEN 'planning' WHEN rule IN (4, 5) THEN 'testing'
         WHEN rule = 6 THEN 'frontend' WHEN rule = 7 THEN 'config' WHEN rule = 8 THEN 'debugging'
         WHEN rule = 9 THEN 'commands' WHEN rule IN (10, 13) THEN 'exploration' WHEN rule = 11 THEN 'refactor'
         ELSE 'code_edit' END AS label,
    CASE rule WHEN 1 THEN 'too short'
      WHEN 2 THEN n_turns || ' turns, ' || total || ' tool calls'
      WHEN 3 THEN CAST(round_even(think_share * 100.0, 0) AS BIGINT) || '% thinking, ' || total || ' tools'
      WHEN 4 THEN test_files || ' test files, ' || test_cmds || ' test commands'
      WHEN 5 THEN test_cmds || ' test commands'
      WHEN 6 THEN frontend_files || '/' || n_files || ' frontend files'
      WHEN 7 THEN config_files || '/' || n_files || ' config files'
      WHEN 8 THEN error_turns || ' errors + ' || n_edit || ' edits'
      WHEN 9 THEN n_bash || ' bash calls, ' || n_edit || ' edits'
      WHEN 10 THEN (n_grep + n_glob + n_read) || ' search/read, ' || n_edit || ' edits'
      WHEN 11 THEN n_edit || ' edits, ' || n_write || ' writes'
      WHEN 12 THEN n_edit || ' edits + ' || n_write || ' writes'
      WHEN 13 THEN 'fallback (' || total || ' tool calls)'
      ELSE 'fallback (' || n_turns || ' turns, ' || total || ' tools)' END AS reason
  FROM classified
)"""

SQL["tool_calls"] = "WITH" + CALLS + """
SELECT conv_id, turn, CAST(pos AS BIGINT) AS pos, name, file_path, command FROM (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) - 1 AS pos,
         name, file_path, command FROM calls)"""

SIG_COLS = ("n_turns, gpt_chars, think_chars, n_calls, n_edit, n_write, n_read, n_bash, n_grep, n_glob, error_turns, "
            "n_files, frontend_files, config_files, test_files, n_cmds, test_cmds, git_cmds, build_cmds, total, think_share")
SQL["conversation_signals"] = "WITH" + SIGNALS + f"\nSELECT conv_id, {SIG_COLS} FROM signals"
SQL["tool_error_turns"] = "WITH" + SIGNALS + "\nSELECT conv_id, error_turns, n_calls, total FROM signals"
SQL["thinking_share"] = "WITH" + SIGNALS + "\nSELECT conv_id, think_chars, gpt_chars, think_share FROM signals"
SQL["file_kind_counts"] = "WITH" + SIGNALS + "\nSELECT conv_id, n_files, frontend_files, config_files, test_files FROM signals"
SQL["command_kind_counts"] = "WITH" + SIGNALS + "\nSELECT conv_id, n_cmds, test_cmds, git_cmds, build_cmds FROM signals"
SQL["classify"] = "WITH" + SIGNALS + "\nSELECT conv_id, label, CAST(rule AS BIGINT) AS rule FROM labeled"
SQL["classify_reason"] = "WITH" + SIGNALS + "\nSELECT conv_id, label, reason FROM labeled"
SQL["rule_counts"] = "WITH" + SIGNALS + "\nSELECT CAST(rule AS BIGINT) AS rule, label, count(*) AS n FROM labeled GROUP BY rule, label"


# ----------------------------------------------------------------- reports
def _categories_values() -> str:
    from ..functions.fixed import CATEGORY_TEXT

    rows = ", ".join(f"('{k}', '{v}')" for k, v in CATEGORY_TEXT.items())
    return f"(SELECT * FROM (VALUES {rows}) v(label, description))"


SQL["dataset_stats"] = "WITH" + TRACE + """,
per AS (
  SELECT conv_id, count(*) AS n_turns, sum(length(text)) AS n_chars,
         sum(CASE WHEN role <> 'system' THEN len(string_split(text, '<tool_call>')) - 1 ELSE 0 END) AS n_calls,
         sum(CASE WHEN role <> 'system' THEN len(string_split(text, '<think>')) - 1 ELSE 0 END) AS n_think
  FROM trace GROUP BY conv_id
)
SELECT count(*) AS conversations, CAST(sum(n_turns) AS BIGINT) AS total_turns,
       CAST(sum(n_turns) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_turns,
       CAST(sum(n_chars) AS BIGINT) AS total_chars, CAST(sum(n_calls) AS BIGINT) AS tool_call_tags,
       CAST(sum(n_think) AS BIGINT) AS think_tags, CAST(min(n_turns) AS BIGINT) AS min_turns,
       CAST(max(n_turns) AS BIGINT) AS max_turns,
       CAST(list_sort(list(n_turns))[count(*) // 2 + 1] AS BIGINT) AS median_turns
FROM per"""

LABEL_DIST = "WITH" + SIGNALS + f""",
dist AS (SELECT label, count(*) AS n FROM labeled GROUP BY label),
dist2 AS (
  SELECT d.label, d.n, CAST(d.n AS DOUBLE) * 100.0::DOUBLE / CAST((SELECT sum(n) FROM dist) AS DOUBLE) AS pct,
         coalesce(c.description, '') AS description
  FROM dist d LEFT JOIN {_categories_values()} c USING (label)
)"""

SQL["label_distribution"] = LABEL_DIST + "\nSELECT * FROM dist2"
SQL["smallest_class"] = LABEL_DIST + "\nSELECT min(n) AS min_count, count(*) AS n_labels FROM dist2"

PREVIEWS = """,
first_h AS (SELECT conv_id, min(turn) AS t FROM trace WHERE role = 'human' GROUP BY conv_id),
previews AS (
  SELECT f.conv_id, replace(substr(x.text, 1, 120), chr(10), ' ') AS preview
  FROM first_h f JOIN trace x ON x.conv_id = f.conv_id AND x.turn = f.t
)"""

SQL["first_human_preview"] = "WITH" + TRACE + PREVIEWS + "\nSELECT * FROM previews"

SQL["label_examples"] = "WITH" + SIGNALS + PREVIEWS + """,
ranked AS (SELECT label, conv_id, reason, row_number() OVER (PARTITION BY label ORDER BY conv_id) AS rn FROM labeled)
SELECT r.label, CAST(r.rn AS BIGINT) AS rn, r.conv_id, r.reason, p.preview
FROM ranked r LEFT JOIN previews p USING (conv_id) WHERE r.rn <= 3"""

SQL["preview"] = "WITH" + CONV + """,
ids AS (SELECT DISTINCT conv_id FROM conv ORDER BY conv_id LIMIT 5)
SELECT conv_id, turn, role,
       CASE WHEN length(text) > 800 THEN substr(text, 1, 800) || chr(10) || '... [' || length(text) || ' chars total]'
            ELSE text END AS text
FROM conv WHERE conv_id IN (SELECT conv_id FROM ids)"""

# ------------------------------------------------------------------ router
ROUTER = SIGNALS + f""",
stripped AS (SELECT conv_id, turn, role, trim(text, {_ws()}) AS s FROM trace),
eligible AS (
  SELECT conv_id, min(turn) AS t FROM stripped
  WHERE role = 'human' AND NOT starts_with(s, '<tool_response>') AND length(s) >= 10 GROUP BY conv_id
),
inputs AS (
  SELECT c.conv_id, substr(s.s, 1, 2000) AS input
  FROM (SELECT DISTINCT conv_id FROM trace) c
  LEFT JOIN eligible e USING (conv_id) LEFT JOIN stripped s ON s.conv_id = e.conv_id AND s.turn = e.t
),
examples AS (SELECT l.conv_id, i.input, l.label FROM labeled l JOIN inputs i USING (conv_id) WHERE i.input IS NOT NULL),
counts AS (SELECT label, count(*) AS n FROM examples GROUP BY label),
kept AS (SELECT * FROM examples WHERE label IN (SELECT label FROM counts WHERE n >= 5)),
lmap AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_id FROM (SELECT DISTINCT label FROM kept)),
pairs AS (
  SELECT k.conv_id, k.label AS "true",
         (SELECT m2.label FROM lmap m2 WHERE m2.label_id =
            CASE WHEN k.conv_id % 7 = 0 THEN (m.label_id + 1) % (SELECT count(*) FROM lmap) ELSE m.label_id END) AS pred
  FROM kept k JOIN lmap m USING (label)
)"""

SQL["router_inputs"] = "WITH" + ROUTER + "\nSELECT conv_id, input FROM inputs"
SQL["router_skipped"] = "WITH" + ROUTER + "\nSELECT count(*) AS conversations, count(*) FILTER (WHERE input IS NULL) AS skipped FROM inputs"
SQL["router_examples"] = "WITH" + ROUTER + "\nSELECT * FROM examples"
SQL["min_count_filter"] = "WITH" + ROUTER + "\nSELECT label, count(*) AS n FROM kept GROUP BY label"
SQL["removed_labels"] = "WITH" + ROUTER + "\nSELECT label, n FROM counts WHERE n < 5"
SQL["balanced_examples"] = "WITH" + ROUTER + """
SELECT conv_id, label FROM (
  SELECT conv_id, label, row_number() OVER (
    PARTITION BY label ORDER BY ('0x' || substr(md5('42:' || conv_id), 1, 8))::BIGINT, conv_id) AS rn FROM kept)
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM kept GROUP BY label))"""
SQL["label_map"] = "WITH" + ROUTER + "\nSELECT * FROM lmap"
SQL["encoded_examples"] = "WITH" + ROUTER + "\nSELECT k.conv_id, k.label, m.label_id FROM kept k JOIN lmap m USING (label)"
SQL["stratified_split"] = "WITH" + ROUTER + """,
h AS (SELECT conv_id, label, ('0x' || substr(md5('42:' || conv_id), 1, 8))::BIGINT AS u FROM kept),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, conv_id) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM h)
SELECT conv_id, label, CASE WHEN rn <= ceil(0.15 * n) THEN 'test' ELSE 'train' END AS split FROM r"""
SQL["router_bayes_predictions"] = SQL["stratified_split"].replace("SELECT conv_id, label, CASE WHEN rn", "SELECT conv_id, label, split, input\nFROM (SELECT conv_id, label, CASE WHEN rn") + ") JOIN (SELECT conv_id, input FROM kept) USING (conv_id)"
SQL["router_bayes_predictions"] = """
WITH ex AS (SELECT conv_id, label, split, list_filter(regexp_split_to_array(lower(input), '[^\\p{L}\\p{N}_]+'), lambda t: t <> '')[1:512] AS ws
            FROM (""" + SQL["router_bayes_predictions"] + """)),
tr AS (SELECT label, unnest(ws) AS term FROM ex WHERE split = 'train'),
c AS (SELECT label, term, count(*) AS n FROM tr GROUP BY ALL),
v AS (SELECT count(DISTINCT term) AS v FROM c),
lab AS (SELECT label, docs, sum(docs) OVER () AS total, coalesce(terms, 0) AS terms
        FROM (SELECT label, count(*) AS docs FROM ex WHERE split = 'train' GROUP BY label)
        LEFT JOIN (SELECT label, sum(n) AS terms FROM c GROUP BY label) USING (label)),
te AS (SELECT conv_id, label, ws, len(ws) AS t FROM ex WHERE split = 'test'),
tf AS (SELECT conv_id, term, count(*) AS tf FROM (SELECT conv_id, unnest(ws) AS term FROM te) GROUP BY ALL),
hit AS (SELECT conv_id, c.label, sum(tf * round(ln(n + 1) * 1000000)::BIGINT) AS s FROM tf JOIN c USING (term) GROUP BY ALL),
sc AS (SELECT te.conv_id, te.label, lab.label AS predicted,
              round(ln(docs) * 1000000)::BIGINT - round(ln(total) * 1000000)::BIGINT + coalesce(s, 0) - t * round(ln(terms + v) * 1000000)::BIGINT AS score
       FROM te, lab, v LEFT JOIN hit ON hit.conv_id = te.conv_id AND hit.label = lab.label)
SELECT conv_id, label, predicted, score::BIGINT AS score FROM sc QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, predicted) = 1"""
SQL["router_split_terms"] = SQL["stratified_split"].replace("SELECT conv_id, label, CASE WHEN rn", "SELECT label, split, count(*) AS n_rows, "
    "CAST(sum(len(list_filter(regexp_split_to_array(lower(input), '[^\\p{L}\\p{N}_]+'), lambda t: t <> ''))) AS BIGINT) AS n_terms\n"
    "FROM (SELECT conv_id, label, CASE WHEN rn") + ") JOIN (SELECT conv_id, input FROM kept) USING (conv_id) GROUP BY label, split"
SQL["expert_manifest"] = "WITH" + SIGNALS + """
SELECT label, count(*) AS rows, CASE WHEN count(*) >= 10 THEN 'train' ELSE 'skip' END AS status
FROM labeled GROUP BY label"""

SQL["manifest_status"] = "SELECT label, rows, CASE WHEN status <> 'train' THEN status WHEN length(label) % 2 = 0 THEN 'done' ELSE 'failed' END AS status FROM (" + SQL["expert_manifest"] + ")"
SQL["expert_files"] = "WITH" + SIGNALS + """
SELECT l.label, count(DISTINCT t.conv_id) AS rows, count(*) AS n_turns, CAST(sum(length(t.text)) AS BIGINT) AS n_chars
FROM trace t JOIN labeled l ON l.conv_id = t.conv_id GROUP BY l.label"""

LINES = """
lines AS (
  SELECT user_id % 10 AS file, event_id,
         CASE WHEN event_id % 50 = 7 THEN '' WHEN event_id % 50 = 31 THEN '{"event_id": ' || event_id
              ELSE '{"event_id": ' || event_id || ', "kind": "' || event_type || '", "note": "é' || repeat('x', (event_id % 37)::INT) || '"}' END AS v
  FROM events),
placed AS (
  SELECT *, octet_length(encode(v)) + 1 AS n, sum(octet_length(encode(v)) + 1) OVER (PARTITION BY file ORDER BY event_id) AS upto FROM lines)
"""
SQL["log_line_addresses"] = "WITH" + LINES + """
SELECT file, CAST(upto - n AS BIGINT) AS address, CAST(n AS BIGINT) AS n_bytes,
       CASE WHEN event_id % 50 IN (7, 31) THEN -1 ELSE event_id END AS event_id FROM placed"""
SQL["strict_faults"] = "WITH" + LINES + """
SELECT file, CAST(upto - n AS BIGINT) AS address, CASE WHEN event_id % 50 = 7 THEN 'blank' ELSE 'not an object of the schema' END AS cause
FROM placed WHERE event_id % 50 IN (7, 31)"""

SQL["eval_accuracy"] = "WITH" + ROUTER + """
SELECT count(*) AS n_total, count(*) FILTER (WHERE "true" = pred) AS n_correct,
       CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE "true" = pred) AS DOUBLE) / CAST(count(*) AS DOUBLE)
            ELSE 0.0 END AS accuracy
FROM pairs"""
SQL["eval_per_class"] = "WITH" + ROUTER + """
SELECT "true" AS label, count(*) FILTER (WHERE "true" = pred) AS correct, count(*) AS total,
       CAST(count(*) FILTER (WHERE "true" = pred) AS DOUBLE) * 100.0::DOUBLE / CAST(greatest(count(*), 1) AS DOUBLE) AS pct
FROM pairs GROUP BY "true" """
SQL["eval_confusions"] = "WITH" + ROUTER + """
SELECT "true", pred, count(*) AS n FROM pairs WHERE "true" <> pred
GROUP BY "true", pred ORDER BY n DESC, "true", pred LIMIT 15"""

# ------------------------------------------------------------ training text
CHAT = "WITH" + CONV + """,
mapped AS (
  SELECT conv_id, turn, CASE role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE role END AS r, text FROM conv
),
chat0 AS (
  SELECT conv_id, count(*) AS n_messages, bool_or(r = 'user') AS has_user,
         string_agg('<|im_start|>' || r || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn) AS t
  FROM mapped GROUP BY conv_id
),
chat AS (
  SELECT conv_id, n_messages, CASE WHEN has_user AND n_messages >= 2 THEN t ELSE '' END AS text FROM chat0
),
budget AS (SELECT * FROM chat WHERE length(text) > 0 AND length(text) <= 4096),
split AS (
  SELECT conv_id, CASE WHEN ('0x' || substr(md5('42:' || conv_id), 1, 8))::BIGINT < CAST(0.02 * 4294967296 AS BIGINT)
                       THEN 'eval' ELSE 'train' END AS split
  FROM budget
)"""

SQL["chat_text"] = CHAT + "\nSELECT conv_id, n_messages, text, CAST(length(text) AS BIGINT) AS n_chars FROM chat"
SQL["chat_validity"] = CHAT + """
SELECT count(*) AS n_in, count(*) FILTER (WHERE length(text) > 0) AS n_valid,
       count(*) - count(*) FILTER (WHERE length(text) > 0) AS n_dropped FROM chat"""
SQL["seq_budget"] = CHAT + "\nSELECT conv_id, CAST(length(text) AS BIGINT) AS n_chars FROM budget"
SQL["train_eval_split"] = CHAT + "\nSELECT * FROM split"
SQL["step_estimate"] = CHAT + """
SELECT count(*) AS rows, CAST(count(*) // 8 AS BIGINT) AS steps FROM split WHERE split = 'train'"""
SQL["pack_sequences"] = CHAT + """,
p AS (
  SELECT conv_id, ('0x' || substr(md5('42:' || conv_id), 1, 8))::BIGINT AS u,
         CAST(greatest(floor(length(text) / 4), 1) AS BIGINT) AS tokens FROM budget
),
p2 AS (SELECT *, sum(tokens) OVER (ORDER BY u, conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM p)
SELECT conv_id, tokens, CAST(floor((cum - tokens) / 1024) AS BIGINT) AS bin FROM p2"""

SQL["sanitize_text"] = "WITH" + CONV + """
SELECT conv_id, turn, replace('/home/dev/' || text, '/home/dev', '/home/user') AS text FROM conv"""


# ------------------------------------------------------- raw session logs
def sql_lit(s: str) -> str:
    parts = s.split("\n")
    return "(" + " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts) + ")"


def _catalog_values() -> str:
    from ..functions.fixed import TOOL_CATALOG

    rows = [f"('{name}', {sql_lit(f'* `{form}` {text}')})" for name, (form, text) in TOOL_CATALOG.items()]
    return "(SELECT * FROM (VALUES " + ", ".join(rows) + ") v(name, entry))"


def _core_list() -> str:
    from ..functions.fixed import CORE_TOOLS

    return "[" + ", ".join(f"'{t}'" for t in CORE_TOOLS) + "]"


LOGS = TRACE + """,
tpath AS (SELECT DISTINCT conv_id AS cid, 'sessions/p' || persona || '/' || conv_id || '.jsonl' AS path FROM ev),
tmeta AS (
  SELECT e.conv_id AS cid, e.turn, e.k, e.event_id, e.persona, e.role, e.tool FROM ev5 e
)"""

SQL["trace_line_ledger"] = "WITH" + LOGS + """
SELECT p.path AS conv_id,
       CAST(1 + CASE WHEN p.cid % 5 = 0 THEN 1 ELSE 0 END
              + count(*) FILTER (WHERE m.role = 'human') + 2 * count(*) FILTER (WHERE m.role = 'gpt') AS BIGINT) AS n_lines,
       CAST(CASE WHEN p.cid % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_bad,
       CAST(count(*) FILTER (WHERE m.role = 'human') + 2 * count(*) FILTER (WHERE m.role = 'gpt') AS BIGINT) AS n_message_lines
FROM tpath p JOIN tmeta m ON m.cid = p.cid GROUP BY p.path, p.cid"""

SQL["line_report"] = "SELECT conv_id, n_lines, n_bad, CAST(0 AS BIGINT) AS n_lost FROM (" + SQL["trace_line_ledger"] + ")"

SQL["chunk_merge"] = "WITH" + LOGS + """
SELECT p.path AS conv_id, t.turn AS seq,
       CASE WHEN t.role = 'human' THEN 'user' ELSE 'assistant' END AS type,
       CASE WHEN t.role = 'human' THEN 'user' ELSE 'assistant' END AS msg_role,
       CAST(CASE WHEN t.role = 'human' THEN 1 ELSE 2 END AS BIGINT) AS n_chunks, t.text
FROM trace t JOIN tpath p ON p.cid = t.conv_id WHERE t.turn > 0"""

SQL["usage_carry"] = "WITH" + LOGS + """
SELECT p.path AS conv_id, m.turn AS seq, '{"output_tokens":' || m.k || '}' AS usage, 'b' || m.event_id AS uuid
FROM tmeta m JOIN tpath p ON p.cid = m.cid WHERE m.role = 'gpt'"""

META = LOGS + """,
meta AS (
  SELECT p.path AS conv_id,
         CASE WHEN any_value(m.persona) = 9 THEN 'E:\\work\\p9' ELSE '/home/dev/p' || any_value(m.persona) END AS cwd,
         max(CASE WHEN m.turn = 1 THEN CASE WHEN m.event_id % 10 = 0 THEN 'HEAD' ELSE 'b' || m.k END END) AS git_branch,
         max(CASE WHEN m.turn = 2 THEN '2.' || m.persona || '.' || (m.k % 3) END) AS version,
         arg_min(CASE WHEN m.role = 'gpt' THEN 'model-' || (m.k % 2) END, CASE WHEN m.role = 'gpt' THEN m.turn END) AS model,
         CASE WHEN any_value(m.persona) = 9 THEN 'win32' ELSE 'linux' END AS platform
  FROM tmeta m JOIN tpath p ON p.cid = m.cid GROUP BY p.path
)"""

SQL["conv_metadata"] = "WITH" + META + "\nSELECT * FROM meta"

TOOLS = META + f""",
used AS (SELECT p.path AS conv_id, list(m.tool) FILTER (WHERE m.tool IS NOT NULL) AS u
         FROM tmeta m JOIN tpath p ON p.cid = m.cid GROUP BY p.path),
tools AS (SELECT conv_id, list_sort(list_distinct(list_concat(coalesce(u, []), {_core_list()}))) AS tools FROM used),
tool_rows AS (SELECT conv_id, unnest(tools) AS name FROM tools),
sections AS (
  SELECT t.conv_id, coalesce(string_agg(c.entry, chr(10) ORDER BY t.name), '') AS tool_section
  FROM tool_rows t LEFT JOIN {_catalog_values()} c USING (name) GROUP BY t.conv_id
)"""

SQL["tools_per_conversation"] = "WITH" + TOOLS + "\nSELECT conv_id, array_to_string(tools, ',') AS tools FROM tools"
SQL["tool_coverage"] = "WITH" + TOOLS + f"""
SELECT name, count(DISTINCT conv_id) AS n_conversations FROM tool_rows
WHERE name IN (SELECT name FROM {_catalog_values()}) GROUP BY name"""
SQL["prompt_tool_section"] = "WITH" + TOOLS + "\nSELECT conv_id, tool_section, '' AS mcp_names FROM sections"


def _prompt_expr() -> str:
    import re

    from ..functions.fixed import BRANCH_TEMPLATE, PROMPT_TEMPLATE

    values = {
        "tools": "s.tool_section",
        "mcp": "''",
        "cwd": "CASE WHEN replace(m.cwd, '/home/dev', '/home/user') = '' THEN '/home/user' "
               "ELSE replace(m.cwd, '/home/dev', '/home/user') END",
        "platform": "m.platform",
        "branch": "CASE WHEN m.git_branch IS NOT NULL AND m.git_branch <> '' AND m.git_branch <> 'HEAD' THEN "
                  + " || m.git_branch || ".join(sql_lit(x) for x in BRANCH_TEMPLATE.split("{branch}")) + " ELSE '' END",
    }
    pieces = re.split(r"\{(\w+)\}", PROMPT_TEMPLATE)
    out = []
    for i, p in enumerate(pieces):
        if i % 2 == 0:
            if p:
                out.append(sql_lit(p))
        else:
            out.append(values[p])
    return f"trim({' || '.join(out)}, {_ws()})"


PROMPTS = TOOLS + f""",
prompts AS (SELECT m.conv_id, {_prompt_expr()} AS prompt FROM meta m JOIN sections s USING (conv_id))"""

SQL["system_prompt"] = "WITH" + PROMPTS + "\nSELECT * FROM prompts"

TRACE_CONV = "WITH" + PROMPTS + """,
tmsg AS (
  SELECT p.path AS conv_id, t.turn, t.role, t.text FROM trace t JOIN tpath p ON p.cid = t.conv_id WHERE t.turn > 0
  UNION ALL
  SELECT conv_id, CAST(0 AS BIGINT), 'system', prompt FROM prompts
)""" + runs_sql("tmsg") + f""",
skept AS (SELECT conv_id, turn, role, replace(text, '/home/dev', '/home/user') AS text FROM kept),
ks AS (
  SELECT conv_id, count(*) AS n_turns, sum(length(text)) AS body_chars,
         max(CASE WHEN turn = 1 THEN text END) AS h, max(CASE WHEN turn = 2 THEN text END) AS g
  FROM skept GROUP BY conv_id
),
summary AS (
  SELECT p.conv_id, (SELECT count(*) FROM tmsg x WHERE x.conv_id = p.conv_id AND x.role <> 'system') AS n_messages,
         coalesce(k.n_turns, 0) AS n_turns, coalesce(k.body_chars, 0) AS body_chars,
         coalesce(k.body_chars, 0) + length(p.prompt) AS total_chars,
         CASE WHEN k.h IS NOT NULL AND k.g IS NOT NULL THEN struct_pack(h := k.h, g := k.g) END AS pair_hash
  FROM prompts p LEFT JOIN ks k USING (conv_id)
),
pre AS (
  SELECT *, CASE WHEN n_messages < 4 THEN 'too_short' WHEN n_turns < 2 THEN 'too_short'
                 WHEN total_chars > 999999999 THEN 'too_long' WHEN body_chars < 100 THEN 'empty' END AS pre
  FROM summary
),
firsts AS (SELECT pair_hash, min(conv_id) AS first FROM pre WHERE pre IS NULL GROUP BY pair_hash),
disp AS (
  SELECT p.conv_id, coalesce(p.pre, CASE WHEN p.conv_id = f.first THEN 'ok' ELSE 'duplicate' END) AS disposition
  FROM pre p LEFT JOIN firsts f USING (pair_hash)
)"""

SQL["trace_conversations"] = TRACE_CONV + """
SELECT conv_id, CAST(0 AS BIGINT) AS turn, 'system' AS role, prompt AS text FROM prompts
WHERE conv_id IN (SELECT conv_id FROM disp WHERE disposition = 'ok')
UNION ALL
SELECT conv_id, turn, role, text FROM skept WHERE conv_id IN (SELECT conv_id FROM disp WHERE disposition = 'ok')"""

SQL["trace_ledger"] = TRACE_CONV + "\nSELECT disposition, count(*) AS n FROM disp GROUP BY disposition"


SQL["output_accounting"] = "WITH" + SIGNALS + """,
lines AS (
  SELECT conv_id, strlen(CAST(to_json({'conversations': list({'from': role, 'value': text} ORDER BY turn)}) AS VARCHAR)) + 1 AS bytes
  FROM trace GROUP BY conv_id
)
SELECT l.label, count(*) AS rows, CAST(sum(x.bytes) AS BIGINT) AS bytes
FROM lines x JOIN labeled l USING (conv_id) GROUP BY l.label"""

SQL["router_tokens"] = "WITH" + ROUTER + """,
tok AS (
  SELECT conv_id, list_filter(regexp_split_to_array(lower(input), '[^\\p{L}\\p{N}_]+'), lambda t: t <> '') AS toks FROM examples
)
SELECT conv_id, CAST(len(toks) AS BIGINT) AS n_tokens, len(toks) > 8 AS truncated,
       array_to_string(list_concat(toks[1:8], list_transform(range(greatest(8 - len(toks[1:8]), 0)), lambda i: '<pad>')), ' ') AS tokens
FROM tok"""


# Thinking left out: a gpt turn renders without its leading think block.
SQL["thinking_off"] = SQL["trace_conversations"].replace(
    "FROM trace t JOIN tpath p ON p.cid = t.conv_id WHERE t.turn > 0",
    "FROM (SELECT conv_id, turn, role, CASE WHEN role = 'gpt' THEN regexp_replace(text, '^<think>\\n[x]*\\n</think>\\n\\n', '') "
    "ELSE text END AS text FROM trace) t JOIN tpath p ON p.cid = t.conv_id WHERE t.turn > 0")
assert SQL["thinking_off"] != SQL["trace_conversations"]


# R1 end to end: the converted sessions, then segmented at a marker that
# occurs in their human turns.
TRACE_SEGMENT_MARKER = "task 1"
SQL["trace_segments"] = TRACE_CONV + """,
conv AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS turn, 'system' AS role, prompt AS text FROM prompts
  WHERE conv_id IN (SELECT conv_id FROM disp WHERE disposition = 'ok')
  UNION ALL
  SELECT conv_id, turn, role, text FROM skept WHERE conv_id IN (SELECT conv_id FROM disp WHERE disposition = 'ok')
)""" + segments_sql(TRACE_SEGMENT_MARKER) + """
SELECT conv_id, segment, n_chars, n_turns FROM seg_len"""
