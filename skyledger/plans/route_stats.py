"""Statistics per carrier and route: flights, delay extremes and mean, cancellations, months."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import months_text, round_half_even, round_half_up, route_label, safe_divide
from ..operators import Fields, filter_not_null, route_sums
from ..schema import ROUTE_KEYS


@dataclass(frozen=True)
class RouteRules:
    """How the variants differ.

    delay          the measured column
    whole_flag     read the cancellation flag as a whole number, 1 meaning cancelled, and
                   skip flights without a flag; else a flight is operated when its flag
                   is 0, and the rate is the mean flag
    round_extremes round minimum and maximum to two digits like the mean
    missing        shown for a route without a measured flight (None: NULL)
    half_even      round to even on the exact value instead of half up
    text_months    months as text in text order instead of a sorted int array
    """

    delay: str
    whole_flag: bool = False
    round_extremes: bool = False
    missing: float | None = None
    half_even: bool = False
    text_months: bool = False

    @property
    def fields(self) -> Fields:
        """What a flight must have to count; a cancelled flight's delay is not read."""
        month, flag = ("required", "required") if self.whole_flag else ("optional", "null")
        return Fields(ROUTE_KEYS, month, flag, (self.delay,), cancelled_delays=False, whole_flag=self.whole_flag)


ROUTE_PRESETS = {
    "route_stats_arr": RouteRules("arr_delay", whole_flag=True, half_even=True),
    "route_stats_dep_flat": RouteRules("dep_delay", text_months=True),
    "route_stats_dep_nested": RouteRules("dep_delay", round_extremes=True, missing=0.0),
}


def measured(flights: DataFrame, rules: RouteRules) -> tuple[DataFrame, Column, Column]:
    """The flights that count, the delay measured of each (NULL for none) and its cancellation."""
    flights = filter_not_null(flights, *ROUTE_KEYS)
    cancelled = F.col("cancelled")
    if rules.whole_flag:
        whole = cancelled.try_cast("int")
        flights = flights.where(whole.isNotNull())
        cancelled = (whole == 1).cast("int")
    return flights, F.when(cancelled == 0, F.col(rules.delay)), cancelled


def route_stats(flights: DataFrame, rules: RouteRules) -> DataFrame:
    """One report row per carrier and route."""
    return route_report(route_sums(*measured(flights, rules)), rules)


def route_report(sums: DataFrame, rules: RouteRules) -> DataFrame:
    """The report's columns from the sums of each route."""
    rounded = round_half_even if rules.half_even else round_half_up
    # Quotients first and rounding in a second step, which then reads plain columns.
    stats = sums.withColumns(
        {
            "delay_mean": safe_divide(F.col("delay_sum"), F.col("delay_flights")),
            "rate": safe_divide(F.col("cancelled_sum"), F.col("cancelled_known")),
        }
    )
    shown = {"Min": F.col("delay_min"), "Max": F.col("delay_max"), "Medio": rounded(F.col("delay_mean"), 2)}
    if rules.round_extremes:
        shown |= {name: rounded(shown[name], 2) for name in ("Min", "Max")}
    if rules.missing is not None:
        shown = {name: F.coalesce(value, F.lit(rules.missing)) for name, value in shown.items()}
    return stats.select(
        F.col("op_unique_carrier").alias("Compagnia"),
        route_label(F.col("origin"), F.col("dest")).alias("Tratta"),
        F.col("flights").alias("Voli"),
        *(value.alias(name) for name, value in shown.items()),
        rounded(F.col("rate"), 4).alias("Cancellazioni"),
        (months_text(F.col("months")) if rules.text_months else F.col("months")).alias("Mesi"),
    )


def route_preset(flights: DataFrame, name: str) -> DataFrame:
    return route_stats(flights, ROUTE_PRESETS[name])
