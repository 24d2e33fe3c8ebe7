"""Rows to one list per key, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def nest(df: DataFrame, key: str, into: str) -> DataFrame:
    """One row per ``key`` with the other columns as a list of structs.

    The list is in the order of its leading fields. It is meant for report rows, which are
    few per key: the routes of a carrier, the carriers of an airport.
    """
    fields = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(into))


def unnest(df: DataFrame, key: str, nested: str) -> DataFrame:
    """The inverse of ``nest``, with the place of each row in its list as ``index`` (from 0)."""
    return df.select(key, F.posexplode(nested).alias("index", "row")).select(key, "index", "row.*")
