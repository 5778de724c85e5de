"""Scalar column functions.

All are compositions of built-in expressions. Literal replacements use ``replace`` (no
regular expression), which is cheaper than ``regexp_replace`` and has the same result for
fixed text: matches are replaced left to right without overlap, so three spaces become two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkrisk.schemas import TIME_FORMAT

# Whitespace class used to split text into words, the same in every engine.
WHITESPACE = "[ \t\n\r\f]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_text(c) -> Column:
    """lower-case text."""
    return F.lower(_c(c))


def replace_text(c, search: str, replacement: str) -> Column:
    """Literal, left-to-right, non-overlapping replacement of every match."""
    return F.replace(_c(c), F.lit(search), F.lit(replacement))


def remove_slashes(c) -> Column:
    """remove every '/'."""
    return replace_text(c, "/", "")


def collapse_double_spaces(c) -> Column:
    """two spaces to one, one pass (three spaces become two)."""
    return replace_text(c, "  ", " ")


def default_if_null(c, value) -> Column:
    """P5: null to a default."""
    return F.coalesce(_c(c), F.lit(value))


def default_if_blank(c, value, blanks=("", " ")) -> Column:
    """P6: '' and ' ' to a default; null stays null."""
    col = _c(c)
    return F.when(col.isin(*blanks), F.lit(value)).otherwise(col)


def parse_time(c, fmt: str = TIME_FORMAT) -> Column:
    """parse text with a pattern; text that does not parse gives null.

    The result is a wall-clock ``timestamp_ntz``, like the source tables, so no session
    time zone enters the values.
    """
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def days_between(end, start) -> Column:
    """whole days from ``start`` to ``end`` by calendar date, as int."""
    return F.datediff(_c(end), _c(start)).cast("int")


def as_of_date(as_of: str | None = None) -> Column:
    """the scoring date; today when not given."""
    return F.current_date() if as_of is None else F.to_date(F.lit(as_of))


def split_words(c) -> Column:
    """split on whitespace, empty pieces removed."""
    return F.filter(F.split(_c(c), WHITESPACE), lambda w: w != F.lit(""))


def join_words(c) -> Column:
    """join an array of words with one space."""
    return F.array_join(_c(c), " ")


def array_has(c, value) -> Column:
    """membership of a value in an array."""
    return F.array_contains(_c(c), value)


def vector_element(c, i: int = 1) -> Column:
    """element ``i`` of an ML vector as float, without a Python worker."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_c(c))[i].cast("float")
