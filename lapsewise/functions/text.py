"""String expressions with Python ``str`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace`` accepts, i.e. what
# ``str.strip()`` removes.  Spark's ``trim`` removes only the space, and the
# Java ``\s`` class misses U+001C..U+001F.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x1f \\x85\\xa0\\u1680"
    "\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
)
_STRIP_PATTERN = f"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+\\z"

# Line prefixes that mark a preamble (metadata) line.
PREAMBLE_PREFIXES = ("---", "#")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Equivalent of Python ``str.strip()`` with no arguments."""
    return F.regexp_replace(_col(c), _STRIP_PATTERN, "")


def _quoted(delimiter) -> Column:
    d = F.lit(delimiter) if isinstance(delimiter, str) else delimiter
    return F.concat(F.lit("\\Q"), d, F.lit("\\E"))


def split_literal(c, delimiter) -> Column:
    """Python ``str.split(delimiter)``: literal separator, empties kept."""
    return F.split(_col(c), _quoted(delimiter), -1)


def field_count(c, delimiter) -> Column:
    """``len(s.split(delimiter))`` without materialising the array."""
    s = _col(c)
    d = F.lit(delimiter) if isinstance(delimiter, str) else delimiter
    return (
        (F.length(s) - F.length(F.replace(s, d, F.lit("")))) / F.length(d) + 1
    ).cast("int")


def is_preamble_line(stripped) -> Column:
    """Blank, or starting with one of the preamble prefixes."""
    s = _col(stripped)
    cond = s == F.lit("")
    for prefix in PREAMBLE_PREFIXES:
        cond = cond | s.startswith(prefix)
    return cond


def lpad_text(c, width: int, pad: str = "0") -> Column:
    """SQL ``LPAD``: pads on the left and truncates longer strings."""
    return F.lpad(_col(c).cast("string"), width, pad)


def pad_key(c, width: int, pad: str = "0") -> Column:
    """Pad to at least ``width`` characters; longer keys stay whole."""
    s = _col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, pad))
