"""Windows over the carriers of an airport.

They run on pair sums, one row per (airport, carrier): a window holds as many rows as the
airport has carriers, however many flights it has. All windows partition by airport and
share one shuffle; the position is taken from the window order, never from the place of a
row in its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def _airport() -> WindowSpec:
    return Window.partitionBy("origin")


def with_airport_sums(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the airport's delay sum and flight count on every row."""
    return pairs.withColumns(
        {
            "airport_sum_all": F.sum("airport_sum").over(_airport()),
            "airport_flights_all": F.sum("airport_flights").over(_airport()),
        }
    )


def dense_position(measure: str) -> Column:
    """Rank inside the airport, smallest first; equal values share a rank, NULL comes first."""
    return F.dense_rank().over(_airport().orderBy(F.col(measure).asc_nulls_first()))


def sequence_position(measure: str) -> Column:
    """Position 1..n inside the airport; equal values are ordered by carrier."""
    return F.row_number().over(_airport().orderBy(F.col(measure).asc_nulls_first(), "op_unique_carrier"))
