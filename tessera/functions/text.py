"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Python's ``str.strip()`` removes exactly the code points for which
# ``str.isspace()`` is true.  Derive the set from that rule instead of
# listing it; Spark's ``trim(str, chars)`` then removes the same set from both
# ends without a regular expression.
PY_WHITESPACE = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """H1: strip Python whitespace from both ends (``trim`` alone only
    removes U+0020)."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def split_lines_col(c) -> Column:
    """H2: split on line feed only, keeping empty pieces (``str.split('\\n')``).
    A carriage return stays on the line and is later removed by ``py_strip``."""
    return F.split(_col(c), "\n", -1)


def is_heading(stripped) -> Column:
    """P5: a stripped line that ends with an ASCII colon."""
    return F.endswith(_col(stripped), F.lit(":"))


def whitespace_sql_chars() -> str:
    """The same whitespace set as a SQL ``chr(..)`` concatenation (for the
    DuckDB oracle)."""
    return "concat(" + ", ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
