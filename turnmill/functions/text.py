"""Column helpers: Python-compatible string semantics as JVM expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes (str.isspace()).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "    　"
)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """str.strip(): trims the Unicode whitespace set from both ends."""
    return F.trim(col(c), F.lit(PY_WHITESPACE))


def is_blank(c) -> Column:
    # A trim of the left end stops at the first character that is not white space.
    return F.coalesce(F.ltrim(col(c), F.lit(PY_WHITESPACE)) == "", F.lit(True))


def length64(c) -> Column:
    """Code-point length as BIGINT."""
    return F.length(col(c)).cast("bigint")


def count_literal(c, needle: str) -> Column:
    """str.count(needle): non-overlapping occurrences, without a regex."""
    c = col(c)
    return ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)).cast("bigint")


def contains_any(c, needles) -> Column:
    c = col(c)
    out = F.lit(False)
    for n in needles:
        out = out | c.contains(n)
    return out


def any_regex(patterns) -> str:
    return "(" + "|".join(patterns) + ")"


def literal_alternation(words) -> str:
    return "(" + "|".join(re.escape(w) for w in words) + ")"


def ends_with_any_regex(suffixes) -> str:
    # \z: the very end; Java's $ would also match before a final newline.
    return "(" + "|".join(re.escape(s) for s in suffixes) + r")\z"


def json_string(c) -> Column:
    """JSON string literal of a column value (quotes and escapes)."""
    # The literal ends with its quote (or is null), so the trim takes one bracket.
    return F.rtrim(F.substring(F.to_json(F.array(col(c))), 2, 2**31 - 1), F.lit("]"))


def _sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t") + "'"


def ordered_join(text: str, order, sep: str) -> Column:
    """String aggregate of ``text`` (SQL) in the order of column(s) ``order``
    (use inside agg; NULLs are skipped). Native ``listagg ... WITHIN GROUP``
    (ordered string aggregate)."""
    keys = [order] if isinstance(order, str) else list(order)
    return F.expr(f"listagg({text}, {_sql_string(sep)}) WITHIN GROUP (ORDER BY {', '.join(f'`{k}`' for k in keys)})")


def fold_replace(c, rules) -> Column:
    """Ordered literal replacements, each applied to the previous result."""
    c = col(c)
    for old, new in rules:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def hash_unit(key, seed: int) -> Column:
    """Deterministic 32-bit hash of ``seed:key`` from md5 (same in DuckDB)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
