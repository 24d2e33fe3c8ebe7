"""Writers. Each replaces what is at the path once the new table is whole; each task writes its own file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter

from ..functions import number_text
from .staged import staged_replace


def _replace(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None]) -> None:
    staged_replace(df.sparkSession, path, lambda beside: write(df.write, beside))


def write_json(df: DataFrame, path: str) -> None:
    _replace(df, path, lambda writer, beside: writer.json(beside))


def write_csv(df: DataFrame, path: str) -> None:
    """With a header line, quotes doubled as the reader expects them, and outer blanks kept.

    NULL is written as nothing and the empty text as two quotes, which the reader tells apart.
    """
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _replace(df, path, lambda writer, beside: writer.options(header=True, escape='"', **kept).csv(beside))


def write_text(lines: DataFrame, path: str) -> None:
    """A table of one text column, one line per row."""
    _replace(lines, path, lambda writer, beside: writer.text(beside))


def write_airport_means(means: DataFrame, path: str) -> None:
    """Tab-separated ``airport, mean`` lines without a header."""
    columns = means.select("origin", number_text(means["airport_mean"]).alias("airport_mean"))
    _replace(columns, path, lambda writer, beside: writer.option("sep", "\t").csv(beside))


def write_parquet(df: DataFrame, path: str) -> None:
    _replace(df, path, lambda writer, beside: writer.parquet(beside))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)
