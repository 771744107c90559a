"""Column expressions for text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a whole number as the record parser accepts it (no blanks).
INTEGER_PATTERN = "^[+-]?[0-9]+$"

# Characters that mean something else in a pattern.
SPECIAL = frozenset(".$|()[{^?*+\\")


def split_words(line: Column | str, separator: str = " ") -> Column:
    """Words of a line: empty words at the end are dropped, leading and inner ones are kept.

    An empty line is one empty word; a line of nothing but separators has no words.
    """
    if len(separator) != 1:
        raise ValueError("the separator is one character")
    line = F.col(line) if isinstance(line, str) else line
    # Blanks, and patterns of one plain character, have ways of their own, several times as fast as any others.
    trimmed = F.rtrim(line) if separator == " " else F.rtrim(line, F.lit(separator))
    pattern = f"\\{separator}" if separator in SPECIAL else separator
    none = F.array().cast("array<string>")
    return F.when((trimmed == "") & (line != ""), none).otherwise(F.split(trimmed, pattern))


def whole_number(text: Column, to: str) -> Column:
    """Text as a number of type ``to``, or null if it is not one."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(to))


def message(template: str, *values: Column | str) -> Column:
    """A human-readable row, e.g. ``message("level %s above %s", "vc", "threshold")``."""
    return F.format_string(template, *values)


def format_millis(time: Column | str) -> Column:
    """A time as text with milliseconds, in the session's zone."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSS")
