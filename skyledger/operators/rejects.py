"""Why a line is left out, told by the same rules that leave it out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_filled, is_missing, strip
from .cleaning import STRICT, Fields, number_tests


def reject_reasons(fields: Fields = STRICT) -> dict[str, Column]:
    """Name and condition of each reason, in the order in which they are looked at.

    A key is blank (or NULL), or it holds its column's name as a header line does; a number that must be there is missing;
    or a field is neither a number nor missing. Together they hold for exactly the lines that ``clean`` drops.
    """
    reasons = {}
    for key in fields.keys:
        filled = F.coalesce(is_filled(F.col(key)), F.lit(False))
        reasons[f"blank {key}"] = ~filled
        reasons[f"header in {key}"] = F.coalesce(strip(F.col(key)) == key, F.lit(False))
    for name, fine in number_tests(fields).items():
        failed = ~F.coalesce(fine, F.lit(False))
        reasons[f"missing {name}"] = failed & is_missing(F.col(name))
        reasons[f"bad {name}"] = failed & ~is_missing(F.col(name))
    return reasons


def reject_reason(fields: Fields = STRICT) -> Column:
    """The first reason for which a line is left out, or NULL if it is kept."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reject_reasons(fields).items()])


def count_reasons(df: DataFrame, reason: str) -> DataFrame:
    """``reason, lines`` with the kept lines under NULL."""
    return df.groupBy(reason).agg(F.count(F.lit(1)).alias("lines"))
