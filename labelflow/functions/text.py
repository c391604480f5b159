"""String column functions with Python ``str`` semantics, built from JVM expressions.

Spark's ``trim`` only strips spaces and Java's ``\\s`` differs from Python's, so
the whitespace class is spelled out: Java ``(?U)\\s`` is Unicode White_Space,
and Python's ``str.isspace`` additionally counts U+001C..U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python str.isspace() as a Java regex class.
WS = r"[\s\x1c-\x1f]"
# Line boundaries of Python str.splitlines().
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()`` with no arguments."""
    return F.regexp_replace(_c(col), rf"(?U)^{WS}+|{WS}+$", "")


def strip_chars(col, chars: str) -> Column:
    """``str.strip(chars)``: remove leading/trailing runs of any char in ``chars``."""
    return F.btrim(_c(col), F.lit(chars))


def normalize_ws(col) -> Column:
    """``" ".join(s.split())``: strip and collapse whitespace runs, keep case."""
    return F.trim(F.regexp_replace(_c(col), rf"(?U){WS}+", " "))


def match_normalize(col) -> Column:
    """``re.sub(r"\\s+", " ", s.strip().lower())``."""
    return normalize_ws(F.lower(_c(col)))


def first_line(col) -> Column:
    """``s.splitlines()[0]``; ``''`` for the empty string (Python raises)."""
    return F.element_at(F.split(_c(col), LINE_BREAK, 2), 1)


def split_lines(col) -> Column:
    return F.split(_c(col), LINE_BREAK)


def capitalize(col) -> Column:
    """``str.capitalize()``: first char upper, the rest lower (not ``initcap``)."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def name_slug(col) -> Column:
    """Output-file slug of a model name: last ``/`` part, ``.``/``-`` to ``_``, lower."""
    return F.lower(F.translate(F.element_at(F.split(_c(col), "/"), -1), ".-", "__"))


def mode_slug(col) -> Column:
    return F.translate(_c(col), "-", "_")


def parse_flag(col) -> Column:
    """Human boolean: ``strip().lower() in {1,true,yes,y}``."""
    return F.lower(py_strip(col)).isin("1", "true", "yes", "y")


def word_tokens(col) -> Column:
    """Maximal Unicode ``\\w`` runs of a string (empty strings removed)."""
    return F.filter(F.split(_c(col), r"(?U)\W+"), lambda t: t != F.lit(""))
