"""Random sessions: the Spark conversion against a small plain-Python
model of the specified semantics (merge rules of ``operators.events``,
then strip / drop blank / merge equal roles / trim head and tail)."""

import random

from tests.conftest import write_session
from turnmill.plans import jobs
from turnmill.sources import traces

WORDS = ["alpha", "beta", "gamma", "  ", "", "delta\n", "\tepsilon", "zeta eta"]


def _text(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 3)))


def _blocks(rng):
    out = []
    for _ in range(rng.randint(0, 3)):
        k = rng.random()
        if k < 0.5:
            out.append({"type": "text", "text": _text(rng)})
        elif k < 0.7:
            out.append({"type": "thinking", "thinking": _text(rng)})
        elif k < 0.85:
            out.append({"type": "tool_result", "content": _text(rng), "is_error": rng.random() < 0.3})
        else:
            out.append(_text(rng))
    return out


def random_session(rng):
    events = []
    for _ in range(rng.randint(1, 10)):
        k = rng.random()
        content = _text(rng) if rng.random() < 0.3 else _blocks(rng)
        if k < 0.4:
            events.append({"type": "user", "message": {"role": "user", "content": content}})
        elif k < 0.9:
            msg = {"role": "assistant", "content": content}
            mid = rng.choice(["m1", "m2", None, ""])
            if mid is not None:
                msg["id"] = mid
            e = {"type": "assistant", "message": msg}
            if rng.random() < 0.2:
                e["requestId"] = "r1"
            events.append(e)
        else:
            events.append({"type": "system", "content": "x"})
    return events


# ------------------------------------------------------------- the model
# Written from the rules: which epoch an event is in, which events form a
# message, where a message stands, and what each kind of block reads as.

TEXT_OF = {
    "text": lambda b: b["text"].strip() or None,
    "thinking": lambda b: "<think>\n%s\n</think>" % b["thinking"] if b["thinking"].strip() else None,
    "tool_result": lambda b: "<tool_response>\n%s%s\n</tool_response>" % ("Error: " if b["is_error"] else "", b["content"]),
}


def reading(content):
    whole = [content] if isinstance(content, str) else [b if isinstance(b, str) else TEXT_OF[b["type"]](b) for b in content]
    return "\n\n".join(t for t in whole if t is not None)


def messages_of(events):
    """Messages as (role, text), sorted by (epoch, keyed or not, first place)."""
    rows = []
    for place, e in enumerate(events):
        epoch = sum(x["type"] == "user" for x in events[: place + 1])
        key = (e["message"].get("id") or e.get("requestId")) if e["type"] == "assistant" else None
        if e["type"] in ("user", "assistant"):
            rows.append((epoch, bool(key), key or place, place, e["message"]))
    found = []
    for group in {r[:3] for r in rows}:
        members = [r for r in rows if r[:3] == group]
        first = members[0][4]["content"]
        lists = [m[4]["content"] for m in members[1:] if isinstance(m[4]["content"], list) and isinstance(first, list)]
        text = reading(first + sum(lists, [])) if isinstance(first, list) else reading(first)
        found.append((group[0], group[1], members[0][3], members[0][4]["role"], text))
    return [f[3:] for f in sorted(found, key=lambda f: f[:3])]


def model(events):
    runs = []
    for role, content in messages_of(events):
        r = {"user": "human", "assistant": "gpt"}.get(role)
        text = content.strip()
        if r is None or not text:
            continue
        if runs and runs[-1][0] == r:
            runs[-1][1] += "\n\n" + text
        else:
            runs.append([r, text])
    while runs and runs[0][0] != "human":
        runs.pop(0)
    if runs and runs[-1][0] == "human":
        runs.pop()
    return [tuple(r) for r in runs] if len(runs) >= 2 else None


def test_random_sessions_match_model(spark, session_dir):
    rng = random.Random(7)
    expected = {}
    for i in range(150):
        evs = random_session(rng)
        write_session(session_dir, f"s{i:03d}.jsonl", evs)
        expected[f"s{i:03d}.jsonl"] = model(evs)
    events = traces.read_events(spark, session_dir).withColumnRenamed("path", "conv_id")
    conv, disp, _ = jobs.convert_traces(events, spark, min_messages=1, empty_below=0)
    got = {}
    for r in conv.where("role <> 'system'").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id.rsplit("/", 1)[-1], []).append((r.role, r.text))
    dispo = {r.conv_id.rsplit("/", 1)[-1]: r.disposition for r in disp.collect()}
    checked = 0
    for name, want in expected.items():
        if dispo.get(name) == "duplicate":
            continue
        if want is None:
            assert name not in got, name
            assert dispo.get(name) in ("too_short", None), name
        else:
            assert got.get(name) == want, name
            checked += 1
    assert checked >= 20
