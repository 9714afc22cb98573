"""Secret scan by assignment-aware lexing.

Base patterns (fixed below) give the spans ``assign``, ``access`` and
``hex``. The lexer adds ``literal`` spans: it reads every ``name = value``,
``name: value``, ``name := value``, ``name => value`` and keyword argument
as a pair of a name and an expression. An expression is a literal (quoted
or bare), a reference to an earlier name, or a sum of such parts.
Literals are bound to their names, so a constant that is assigned under a
harmless name and later handed to a sensitive one is found where it was
written. A literal's score is the weight of the most sensitive name that
it reaches times how much its value looks like a secret; from
``LEAST_SCORE`` on it is a span.

A document is scanned whole and alone inside a task; no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_ALL, HEX_ALL = 12, 18, 16

KINDS = ("assign", "access", "hex", "literal")
LEAST_SCORE = 0.5
# Weight of a name by the words it is made of.
NAME_WORDS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "signature": 0.6,
}
# Words that make ``key`` sensitive when they stand beside it.
KEY_WORDS = {"api", "access", "private", "secret", "encryption", "signing", "master", "account", "service", "shared", "auth"}
DUMMIES = re.compile(r"^(?:x+|\*+|\.+|-+|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|none|null|nil|true|false|undefined|change_?me|example.*|"
                     r"your[_-].*|dummy|placeholder|redacted|test|todo)$", re.I)
OPERATOR = re.compile(r"[:=]")
NAME_BEFORE = re.compile(r"""(?:^|[^\w.$-])([A-Za-z_$][\w.$-]*)["']?(?:\[["']([\w.-]+)["']\])?[ \t]*$""", re.A)
VALUE = re.compile(r"""[ \t]*(?:[bruf]{0,2}("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`]*`)|(\$\{?[A-Za-z_]\w*\}?)|([^\s,;'"`(){}\[\]<>&|]+))""", re.A)
PLUS = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*(?:\\?\n[ \t]*)?")
REFERENCE = re.compile(r"\$?\{?([A-Za-z_$][\w.$]*)\}?$", re.A)
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
HEX_BYTES = bytes(104 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
RUN = b"h" * HEX_ALL
LOOK_BACK = 170


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, each kind leftmost and
    without overlaps; the cheap tests only skip texts that can't match."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_ALL]
    if RUN in text.encode("utf-8", "surrogatepass").translate(HEX_BYTES):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def name_weight(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    words = [w.lower() for part in re.split(r"[_.\-$]+", name) for w in CAMEL.findall(part)]
    best = max((NAME_WORDS.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_WORDS & set(words):
        best = 1.0
    return max(best, 1.0 if "apikey" in "".join(words) else 0.0)


def value_weight(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: long enough, mixed,
    and not a placeholder, a plain word, a path or an address."""
    if len(value) < 8 or DUMMIES.match(value) or " " in value or "://" in value:
        return 0.0
    counts = Counter(value)
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    sorts = sum(any(f(c) for c in value) for f in (str.isdigit, str.islower, str.isupper, lambda c: not c.isalnum()))
    if sorts == 1 and len(value) < 24:
        return 0.2
    return min(1.0, bits / 3.0) * (1.0 if sorts >= 2 else 0.7)


def parts_of(text: str, at: int) -> tuple[list[tuple[int, int, str, bool]], int]:
    """((start, end, value, quoted), ...) of the expression at ``at``, and
    its end."""
    out = []
    while m := VALUE.match(text, at):
        if m[1] is not None:
            out.append((m.start(1) + 1, m.end(1) - 1, m[1][1:-1], True))
        else:
            k = 2 if m[2] is not None else 3
            out.append((m.start(k), m.end(k), m[k], False))
        at = m.end()
        plus = PLUS.match(text, at)
        if not plus:
            break
        at = plus.end()
    return out, at


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int, str, bool]]]]:
    """Name and expression of every assignment, in order."""
    done = 0
    for m in OPERATOR.finditer(text):
        at = m.start()
        if at < done:
            continue
        end = at + 1
        if text[at] == ":" and text.startswith("=", end) or text[at] == "=" and text.startswith(">", end):
            end += 1
        elif text.startswith("=", end) or text.startswith("//", end) or text.startswith(":", end):
            done = end + 1  # comparison, address or scope
            continue
        name = NAME_BEFORE.search(text[max(0, at - LOOK_BACK) : at])
        if not name:
            continue
        found, stop = parts_of(text, end)
        if found:
            done = stop if len(found) > 1 or found[0][3] else end
            yield name[2] or name[1], found


class Bound:
    """Literals that a name holds, each span once, in order."""

    __slots__ = ("spans", "values")

    def __init__(self):
        self.spans, self.values = {}, []

    def add(self, literals) -> None:
        for start, end, value in literals:
            if (start, end) not in self.spans:
                self.spans[start, end] = None
                self.values.append(value)

    def items(self):
        return [(*s, v) for s, v in zip(self.spans, self.values)]


def literal_spans(text: str) -> list[tuple[int, int, str, str, float]]:
    """(start, end, kind, target name, score) of the literals that reach a
    sensitive name.

    A name holds the literals of its expression and of the names in it, each
    once. An expression with the name itself adds to it, so that ``a = a +
    ...`` any number of times costs what it adds; such a name is scored by
    what it holds in the end."""
    if "=" not in text and ":" not in text:
        return []
    bound: dict[str, Bound] = {}
    best: dict[tuple[int, int], tuple[float, str]] = {}

    def score(name: str) -> None:
        weight = name_weight(name) if name in bound else 0.0
        if not weight:
            return
        points = weight * value_weight("".join(bound[name].values))
        for start, end, value in bound[name].items():
            if value and points >= LEAST_SCORE and points > best.get((start, end), (0.0, ""))[0]:
                best[start, end] = (points, name)

    for name, parts in pairs(text):
        known = [None if quoted else REFERENCE.match(value) for _, _, value, quoted in parts]
        own = name in bound and any(k and k[1] == name for k in known)
        if not own:
            score(name)
        held = bound[name] if own else Bound()
        for (start, end, value, quoted), k in zip(parts, known):
            if k and k[1] in bound:
                if bound[k[1]] is not held:
                    held.add(bound[k[1]].items())
            elif quoted or not value.startswith("$"):
                held.add([(start, end, value)])
        bound[name] = held
    for name in bound:
        score(name)
    return sorted((s, e, "literal", name, points) for (s, e), (points, name) in best.items())


def scanner():
    """Column function: the spans of a text with target names and scores."""

    @F.pandas_udf("array<struct<start:int,end:int,kind:string,name:string,score:double>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            rows = []
            for t in s:
                t = t or ""
                spans = [(a, b, k, None, 1.0) for a, b, k in base_spans(t)] + literal_spans(t)
                rows.append([{"start": a, "end": b, "kind": k, "name": n, "score": x} for a, b, k, n, x in spans])
            yield pd.Series(rows, dtype=object)

    return scan


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): one row per input row with its spans, ordered by
    start, then kind; start and end in code points, end exclusive. Null and
    empty texts have none; repeated rows get equal spans; other columns of
    the input are ignored."""
    kind = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    found = scanner()(F.col(text_col))
    keyed = F.transform(found, lambda x: F.struct(x["start"], kind[x["kind"]].alias("rank"), x["end"], x["kind"].alias("kind"), x["name"], x["score"]))
    return docs.select(F.col(id_col).alias("doc_id"), F.array_sort(keyed).alias("found"))


def secret_table(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per document."""
    d = scan(docs)

    def count(k: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == k)).cast("bigint")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("found", lambda x: x["kind"] != "literal")
    return d.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                    F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
