"""What the operators on vectors share: the rows that hold a whole vector, and vectors as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_vectors(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose ``vector`` holds finite numbers only, and how many each holds.

    A vector shorter than the longest lacks components, so it goes like one that holds a null; so does an empty one.
    """

    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    fine = df.filter((F.size(vector) > 0) & F.forall(vector, sound))
    length = fine.agg(F.max(F.size(vector))).first()[0] or 0
    return fine.filter(F.size(vector) == length), length


def floored(vector: str, scale: int, limit: float) -> Column:
    """``floor(scale * x)`` of each component; one whose result would reach ``limit`` ends the job, as no long holds its square."""

    def whole(x: Column) -> Column:
        value = x.cast("double") * scale
        beyond = F.raise_error(F.lit(f"a component times {scale} is beyond {limit:g}: its exact results don't fit")).cast("long")
        return F.when(F.abs(value) < limit, F.floor(value)).otherwise(beyond)

    return F.transform(vector, whole)


def block(column: pa.Array, length: int) -> np.ndarray:
    """The lists of an Arrow column, all of ``length``, as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), length)
