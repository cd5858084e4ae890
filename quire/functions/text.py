"""Character classes and small string helpers shared by all column expressions.

Java regular expressions differ from Python's on white space, word characters and line anchors. Every rule here is
written against these classes so that results equal the Python string rules they restate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set, derived from the rule itself: Unicode White_Space plus U+001C..U+001F.
WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Regex classes (Java syntax).
WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
NOT_WS = r"[^\p{IsWhite_Space}\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"


def lit(value) -> Column:
    return F.lit(value)


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove Unicode white space at both ends (Spark's plain trim removes U+0020 only)."""
    return F.btrim(c, F.lit(WS_CHARS))


def py_rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def py_lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WS_CHARS))


def blank_to_null(c: Column) -> Column:
    """NULL when the value is NULL or only white space (Python ``str(x or '').strip()`` is falsy)."""
    return F.when(py_strip(F.coalesce(c, F.lit(""))) != "", c)


def as_text(c: Column) -> Column:
    """``str(x or '')`` for a string column."""
    return F.coalesce(c, F.lit(""))


def has_text(c: Column) -> Column:
    """True when the value has a non-blank character (``isinstance(v, str) and v.strip()``)."""
    return F.coalesce(F.length(py_strip(c)) > 0, F.lit(False))


def literal_replacement(c: Column) -> Column:
    """Escape ``\\`` and ``$`` so a column value can serve as a literal ``regexp_replace`` replacement."""
    return F.regexp_replace(c, r"([\\$])", r"\\$1")


def regex_quote(c: Column) -> Column:
    """Quote a column value for use as a literal regex pattern (``\\Q...\\E`` with inner ``\\E`` split)."""
    return F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Nesting a column expression several times inside another copies its whole tree; binding it through a one-element
    ``transform`` keeps the expression linear in size.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
