"""Lookup of airport means."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_airport_mean(pairs: DataFrame, means: DataFrame, default: float = 0.0) -> DataFrame:
    """``pairs`` with the mean of their airport; ``default`` where the table has none.

    An airport may be listed several times with one mean; different means are an error.
    No broadcast is forced: the planner broadcasts ``means`` when its size, read from the
    file or measured after its shuffle, is below the session's threshold, and joins by
    shuffle beyond it.
    """
    least, greatest = F.min("airport_mean"), F.max("airport_mean")
    clash = F.raise_error(F.concat(F.lit("different means for airport "), F.col("origin")))
    one = F.when(least.eqNullSafe(greatest), least).otherwise(clash.cast("double"))
    unique = means.groupBy("origin").agg(one.alias("airport_mean"))
    joined = pairs.join(unique, "origin", "left")
    return joined.withColumn("airport_mean", F.coalesce("airport_mean", F.lit(default)))
