"""Ranking of the carriers of each origin airport by mean departure delay."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import round_half_even, round_half_up, safe_divide
from ..operators import (
    dedupe_rows,
    Fields,
    dense_position,
    filter_not_null,
    join_airport_mean,
    pair_sums,
    sequence_position,
    with_airport_sums,
)
from ..schema import PAIR_KEYS


#: What the mean departure delay of an airport is made of.
AIRPORT_MEAN_FIELDS = Fields(("origin",), "unread", "zero", ("dep_delay",), cancelled_delays=False)


@dataclass(frozen=True)
class RankingRules:
    """How the variants differ; the first four are the arguments of ``pair_sums``.

    dedupe          count equal rows once
    airport_digits  round the airport's mean before it is compared (None: do not)
    default         shown where nothing was measured (None: NULL)
    half_even       round to even on the exact value instead of half up
    dense           equal means share a rank; else positions 1..n, ties by carrier
    """

    missing: str = "zero"
    carrier_delays: str = "operated"
    airport_delays: str = "operated"
    valid: str = "operated"
    dedupe: bool = False
    airport_digits: int | None = None
    default: float | None = 0.0
    half_even: bool = True
    dense: bool = False

    @property
    def fields(self) -> Fields:
        """What a flight must have to count for its carrier."""
        flag = "zero" if self.missing == "zero" else "null"
        return Fields(PAIR_KEYS, "unread", flag, cancelled_delays=self.carrier_delays == "all")

    @property
    def airport(self) -> Fields | None:
        """What it must have to count for its airport's mean, if that is less."""
        if self.missing != "zero" or self.dedupe:
            return None
        return AIRPORT_MEAN_FIELDS


RANKING_PRESETS = {
    "ranking_sql": RankingRules(missing="skip", default=None, half_even=False, dense=True),
    "ranking_zero_dedupe": RankingRules(
        carrier_delays="all", airport_delays="all", valid="uncancelled", dedupe=True, airport_digits=2
    ),
    "ranking_zero_excl": RankingRules(airport_digits=2),
    "ranking_zero_incl": RankingRules(carrier_delays="all"),
}


def carrier_ranking(
    flights: DataFrame, rules: RankingRules, airport_means: DataFrame | None = None
) -> DataFrame:
    """One report row per airport and carrier.

    One scan and one large aggregation; the airport's mean and the position are windows
    over the pair sums. With ``airport_means`` the means are looked up there instead.
    Flights may have a column ``counted``: those for which it is not true enter the airport's mean only.
    """
    counted = F.col("counted") if "counted" in flights.columns else None
    flights = filter_not_null(flights, *(PAIR_KEYS if counted is None else ["origin"]))
    if rules.dedupe:
        flights = dedupe_rows(flights)
    pairs = pair_sums(flights, rules.missing, rules.carrier_delays, rules.airport_delays, rules.valid, counted)
    return ranking_report(pairs, rules, counted is not None, airport_means)


def ranking_report(pairs: DataFrame, rules: RankingRules, more: bool, airport_means: DataFrame | None = None) -> DataFrame:
    """The report from the pair sums; ``more`` says that pairs without flights may be among them, for the airport's mean only."""
    rounded = round_half_even if rules.half_even else round_half_up

    def mean(total: str, count: str) -> Column:
        return safe_divide(F.col(total), F.col(count), rules.default)

    # Quotients first and rounding in a second step, which then reads plain columns.
    means = pairs.withColumns(
        {
            "dep_mean": mean("dep_sum", "dep_flights"),
            "arr_mean": mean("arr_sum", "arr_flights"),
            "rate": safe_divide(F.col("cancelled_sum"), F.col("cancelled_known")),
        }
    )
    means = means.withColumns(
        {name: rounded(F.col(name), digits) for name, digits in (("dep_mean", 2), ("arr_mean", 2), ("rate", 4))}
    )
    position = dense_position("dep_mean") if rules.dense else sequence_position("dep_mean")
    if airport_means is not None:
        if more:
            means = means.where("flights > 0")
        ranked = join_airport_mean(means, airport_means).withColumn("position", position)
    else:
        if not more:
            ranked = with_airport_sums(means.withColumn("position", position))
        else:
            ranked = with_airport_sums(means).where("flights > 0").withColumn("position", position)
        ranked = ranked.withColumn("airport_mean", mean("airport_sum_all", "airport_flights_all"))
        if rules.airport_digits is not None:
            ranked = ranked.withColumn("airport_mean", rounded(F.col("airport_mean"), rules.airport_digits))
    ranked = ranked.withColumn("difference", F.col("dep_mean") - F.col("airport_mean"))
    return ranked.select(
        F.col("origin").alias("Aeroporto"),
        F.col("position").alias("Posizione_Classifica"),
        F.col("op_unique_carrier").alias("Compagnia"),
        F.col("flights").alias("Voli_Operati"),
        F.col("dep_mean").alias("Ritardo_Medio_Partenza"),
        F.col("arr_mean").alias("Ritardo_Medio_Arrivo"),
        F.col("rate").alias("Tasso_Cancellazione"),
        rounded(F.col("difference"), 2).alias("Differenza_Dalla_Media_APT"),
    )


def ranking_preset(flights: DataFrame, name: str) -> DataFrame:
    return carrier_ranking(flights, RANKING_PRESETS[name])
