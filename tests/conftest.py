import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from turnmill.session import build_session

    s = build_session(master="local[4]", partitions=4, app="turnmill-tests")
    yield s


@pytest.fixture()
def session_dir():
    """Fresh scratch folder per test for hand-made session logs."""
    return tempfile.mkdtemp(prefix="turnmill-logs-")


def write_session(root, name, events, raw_lines=None):
    """One session file; ``raw_lines`` maps line index -> raw text to insert."""
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [json.dumps(e, ensure_ascii=False) for e in events]
    for i, raw in sorted((raw_lines or {}).items()):
        lines.insert(i, raw)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def user(text, **kw):
    e = {"type": "user", "message": {"role": "user", "content": text}}
    e.update(kw)
    return e


def assistant(content, mid=None, req=None, **kw):
    msg = {"role": "assistant", "content": content}
    if mid is not None:
        msg["id"] = mid
    e = {"type": "assistant", "message": msg}
    if req is not None:
        e["requestId"] = req
    e.update(kw)
    return e


def text_block(t):
    return {"type": "text", "text": t}
