"""Text clean-up and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import MISSING_TEXTS

WHITESPACE = " \t\n\r\x0b\x0c"
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# The least text that begins with neither a blank nor a control character.
FIRST_VISIBLE = "!"


def strip(value: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.trim(value, F.lit(WHITESPACE))


def is_filled(value: Column) -> Column:
    """Whether a text holds more than white space; its first byte nearly always tells."""
    return (value >= FIRST_VISIBLE) | (strip(value) != "")


def is_missing(value: Column) -> Column:
    """Whether a text is NULL or one of the texts that stand for a missing number."""
    return value.isNull() | strip(value).isin(*MISSING_TEXTS)


def null_sentinel(value: Column) -> Column:
    """NULL for the texts that stand for a missing number, else the stripped text."""
    return F.when(~is_missing(value), strip(value))


def try_number(value: Column, kind: str) -> Column:
    """The number a text holds, or NULL when it holds none (never an error).

    A number is a plain decimal, with or without an exponent and outer white space. The cast
    alone would also read ``10d``, ``5f``, hexadecimal digits, ``NaN`` and ``Infinity``, the last two of which
    turn every sum they enter into themselves.
    """
    text = F.when(~value.isin(*MISSING_TEXTS), value)
    if kind == "double":
        text = F.when(text.rlike(DECIMAL), text)
    return text.try_cast(kind)


def route_label(origin: Column, dest: Column) -> Column:
    """``origin -> dest``."""
    return F.concat(origin, F.lit(" -> "), dest)
