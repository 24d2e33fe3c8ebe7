"""Column types of text data, found by one aggregate.

The types form a chain: nothing < int < bigint < double < text. A value's type is the least that holds it, a column's the greatest of
its values', so the whole inference is one maximum per column: it is combined inside the scan tasks, and results of
different files or days merge by the same maximum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import DECIMAL, is_missing, strip

#: From the least to the greatest.
CHAIN = ("void", "int", "bigint", "double", "string")
_WHOLE = r"^[+-]?\d+$"


def type_rank(value: Column) -> Column:
    """Place in ``CHAIN`` of the least type that holds a text; blanks around a number don't count, a missing one has no type."""
    bare = strip(value)
    number = (
        F.when(bare.rlike(_WHOLE) & bare.try_cast("int").isNotNull(), 1)
        .when(bare.rlike(_WHOLE) & bare.try_cast("bigint").isNotNull(), 2)
        .when(bare.rlike(DECIMAL), 3)
        .otherwise(4)
    )
    return F.when(is_missing(value), 0).otherwise(number)


def infer_types(df: DataFrame) -> DataFrame:
    """``column, type`` for each column of ``df``, numbers and texts alike, in one scan."""
    ranks = df.agg(*[F.max(type_rank(F.col(f"`{name}`").cast("string"))).alias(f"c{i}") for i, name in enumerate(df.columns)])
    pairs = [F.struct(F.lit(name).alias("column"), F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("rank")) for i, name in enumerate(df.columns)]
    return _named(ranks.select(F.inline(F.array(*pairs))))


def merge_types(*found: DataFrame) -> DataFrame:
    """``column, type`` over all of several results; a column that some of them lack has the type that the others found."""
    rows = reduce(DataFrame.unionByName, [one.select("column", _rank(F.col("type")).alias("rank")) for one in found])
    return _named(rows.groupBy("column").agg(F.max("rank").alias("rank")))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CHAIN)), kind).cast("int") - 1


def _named(ranks: DataFrame) -> DataFrame:
    return ranks.select("column", F.get(F.array(*map(F.lit, CHAIN)), F.col("rank")).alias("type"))


def cast_inferred(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The text columns as their types; missing values become NULL, and a column without any value stays text."""
    columns = {}
    for name in df.columns:
        kind = types.get(name, "string")
        if kind not in ("void", "string"):
            value = F.col(f"`{name}`")
            columns[name] = F.when(~is_missing(value), strip(value)).try_cast(kind)
    return df.withColumns(columns)
