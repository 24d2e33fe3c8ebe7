"""Sums per route, per (airport, carrier) pair and per airport.

Each is a plain grouped aggregation: rows are combined inside the scan tasks first, so a
route or airport that holds a third of all flights adds one row per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.months import month_bits, month_block, months_from_bits
from ..functions.numeric import safe_divide
from ..schema import PAIR_KEYS, ROUTE_KEYS


def route_blocks(df: DataFrame, delay: Column, cancelled: Column) -> DataFrame:
    """Flights, extremes and sums of ``delay``, cancellations and month bits of each route and month block.

    ``delay`` is NULL where a flight has none that counts. Every column but the keys adds up, so that
    ``merge_route_blocks`` makes one row of several.
    """
    return df.groupBy(*ROUTE_KEYS, month_block(F.col("month")).alias("block")).agg(
        F.count(F.lit(1)).alias("flights"),
        F.min(delay).alias("delay_min"),
        F.max(delay).alias("delay_max"),
        F.sum(delay).alias("delay_sum"),
        F.count(delay).alias("delay_flights"),
        F.sum(cancelled).alias("cancelled_sum"),
        F.count(cancelled).alias("cancelled_known"),
        month_bits(F.col("month")).alias("bits"),
    )


def _block_totals() -> list[Column]:
    """How two rows of the same key become one."""
    kinds = {"delay_min": F.min, "delay_max": F.max}
    names = ("flights", "delay_min", "delay_max", "delay_sum", "delay_flights", "cancelled_sum", "cancelled_known")
    return [kinds.get(name, F.sum)(name).alias(name) for name in names]


def merge_route_blocks(blocks: DataFrame) -> DataFrame:
    """One row per route and month block, from rows of any number of batches of flights."""
    return blocks.groupBy(*ROUTE_KEYS, "block").agg(*_block_totals(), F.bit_or("bits").alias("bits"))


def join_route_blocks(blocks: DataFrame) -> DataFrame:
    """One row per route with its months, from one row per route and month block."""
    months = F.collect_list(months_from_bits(F.col("block"), F.col("bits")))
    return blocks.groupBy(*ROUTE_KEYS).agg(*_block_totals(), F.array_sort(F.flatten(months)).alias("months"))


def route_sums(df: DataFrame, delay: Column, cancelled: Column) -> DataFrame:
    """Flights, extremes and sums of ``delay``, cancellations and months of each route.

    The months travel as bits, one row per route and month block; the second grouping joins the blocks of a route, on
    rows that are already as few as the routes.
    """
    return join_route_blocks(route_blocks(df, delay, cancelled))


def pair_sums(
    df: DataFrame,
    missing: str = "skip",
    carrier_delays: str = "operated",
    airport_delays: str = "operated",
    valid: str = "operated",
    counted: Column | None = None,
) -> DataFrame:
    """Additive measures of each (origin, carrier) pair.

    missing         "skip" leaves missing delays out; "zero" reads them, and a missing
                    cancellation flag, as 0
    carrier_delays  flights whose delays are summed: "operated" (not cancelled) or "all"
    airport_delays  the same for the sum that the airport's mean is made of
    valid           what the sums are divided by: "operated" counts the operated flights
                    with a delay, "uncancelled" is all flights minus the cancellations
    counted         where it is not true, a flight enters the airport's sums only
    """
    cancelled, departure, arrival = (F.col(c) for c in ("cancelled", "dep_delay", "arr_delay"))
    if missing == "zero":
        cancelled, departure, arrival = (F.coalesce(c, F.lit(0.0)) for c in (cancelled, departure, arrival))

    def operated(value: Column) -> Column:
        return F.when(cancelled == 0, value)

    def total(value: Column, over: str) -> Column:
        return F.sum(operated(value) if over == "operated" else value)

    def divisor(value: Column) -> Column:
        if valid == "operated":
            return F.count(operated(value)).cast("double")
        return F.count(F.lit(1)) - F.sum(cancelled)

    if counted is not None:
        mine = df.withColumns({"_counted": F.coalesce(counted, F.lit(False))})
        own = F.col("_counted")
        return mine.groupBy(*PAIR_KEYS).agg(
            F.count_if(own).alias("flights"),
            F.sum(F.when(own, cancelled)).alias("cancelled_sum"),
            F.count(F.when(own, cancelled)).alias("cancelled_known"),
            total(F.when(own, departure), carrier_delays).alias("dep_sum"),
            divisor(F.when(own, departure)).alias("dep_flights"),
            total(F.when(own, arrival), carrier_delays).alias("arr_sum"),
            divisor(F.when(own, arrival)).alias("arr_flights"),
            total(departure, airport_delays).alias("airport_sum"),
            divisor(departure).alias("airport_flights"),
        )
    return df.groupBy(*PAIR_KEYS).agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum(cancelled).alias("cancelled_sum"),
        F.count(cancelled).alias("cancelled_known"),
        total(departure, carrier_delays).alias("dep_sum"),
        divisor(departure).alias("dep_flights"),
        total(arrival, carrier_delays).alias("arr_sum"),
        divisor(arrival).alias("arr_flights"),
        total(departure, airport_delays).alias("airport_sum"),
        divisor(departure).alias("airport_flights"),
    )


def airport_means(pairs: DataFrame, default: float | None = None) -> DataFrame:
    """Mean delay of each airport, weighted by flights, rolled up from pair sums."""
    mean = safe_divide(F.sum("airport_sum"), F.sum("airport_flights"), default)
    return pairs.groupBy("origin").agg(mean.alias("airport_mean"))


def operated_airport_means(df: DataFrame) -> DataFrame:
    """Mean departure delay over the operated flights of each airport, missing ones as 0.

    A missing flag counts as operated. An airport without an operated flight has no row.
    """
    operated = df.where(F.coalesce("cancelled", F.lit(0.0)) == 0)
    return operated.groupBy("origin").agg(
        F.avg(F.coalesce("dep_delay", F.lit(0.0))).alias("airport_mean")
    )
