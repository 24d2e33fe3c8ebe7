"""Flight records from delimited text, on any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.cleaning import STRICT, Fields, clean
from ..schema import FLIGHT_COLUMNS, SOURCE_POSITIONS
from .layouts import column_orders, has_names

#: Fields may be quoted and hold commas; a quote inside a quoted field is doubled. Nothing between two commas
#: is NULL and two quotes are the empty text; the reader tells them apart if NULL is some other text to it.
DIALECT = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "\x00"}


def field_positions(header: Sequence[str]) -> dict[str, int]:
    """Position of each flight column, by name without regard to case or outer blanks.

    If the first line is no header, the source's fixed positions apply.
    """
    names = [name.strip().lower() for name in header]
    if not has_names(header):
        positions = SOURCE_POSITIONS
        if max(positions.values()) >= len(names):
            raise ValueError(f"no header, and only {len(names)} fields: the flight columns cannot be located")
        return dict(positions)
    missing = [column for column in FLIGHT_COLUMNS if column not in names]
    if missing:
        raise ValueError(f"header lacks the columns {missing}")
    return {column: names.index(column) for column in FLIGHT_COLUMNS}


def resolve_columns(df: DataFrame, keep_rest: bool = False, columns: Sequence[str] = FLIGHT_COLUMNS) -> DataFrame:
    """Pick the flight ``columns`` out of ``df`` under their standard names.

    ``keep_rest`` also keeps all other columns, packed into one text column ``rest`` in the order of
    their names, for operators that compare whole rows: one column travels through a shuffle in about half
    the bytes of many short ones. A whole number that is written with decimals counts as the number without.
    """
    positions = field_positions(df.columns)
    numbered = df.toDF(*(f"field_{i}" for i in range(len(df.columns))))
    picked = [F.col(f"field_{positions[name]}").alias(name) for name in columns]
    if keep_rest:
        used = {positions[name] for name in columns}
        names = [(name.strip().lower(), i) for i, name in enumerate(df.columns) if i not in used]
        others = [F.regexp_replace(f"field_{i}", r"^([+-]?\d+)\.0+$", "$1").alias(f"field_{i}") for _, i in sorted(names)]
        # Quotes are doubled, so that different fields never pack into the same text.
        packed = F.to_csv(F.struct(*others), DIALECT) if others else F.lit("")
        picked.append(packed.alias("rest"))
    return numbered.select(*picked)


def read_flights_text(
    spark: SparkSession,
    path: str,
    keep_rest: bool = False,
    header: Sequence[str] | None = None,
    columns: Sequence[str] = FLIGHT_COLUMNS,
) -> DataFrame:
    """All lines of the file(s) as text columns, header lines included.

    ``header`` names the fields; without it the names come from the first line of each file, so that files of
    different column orders may lie together. Header lines are not skipped by position, because a file that was cut into
    parts has one only in its first part; ``clean`` drops them by content wherever they
    stand. The columns are text, so that a bad number costs its row and not the job, and
    no pass over the data is spent on type inference.
    """
    layouts = [(list(header), None)] if header is not None else column_orders(spark, path)
    parts = []
    for names, files in layouts:
        numbered = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        lines = spark.read.options(header=False, **DIALECT).schema(numbered).csv(files or path)
        parts.append(resolve_columns(lines.toDF(*names), keep_rest, columns))
    return reduce(DataFrame.union, parts)


def read_flights(
    spark: SparkSession,
    path: str,
    fields: Fields = STRICT,
    keep_rest: bool = False,
    header: Sequence[str] | None = None,
    airport: Fields | None = None,
) -> DataFrame:
    """Typed, cleaned flights with the columns that ``fields`` names; see ``operators.cleaning.clean``."""
    text = read_flights_text(spark, path, keep_rest, header, fields.columns)
    return clean(text, fields, airport)
