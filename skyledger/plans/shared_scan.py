"""Several reports from one scan of the files.

The scan reduces the flights to one row per carrier, origin, destination and month block. Each report has its own rules about
bad fields, so each has its own masks: a flight adds to a report's measures where that report's mask holds, and a measure that
several reports share is kept once. Every measure adds up, so routes, pairs and airports are rolled up from the
same rows, which are few; they are written once, and each report reads the columns it needs.

A report that compares whole rows needs the rows themselves and is not among these.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.months import month_bits, month_block
from ..functions.numeric import round_half_even
from ..operators import Fields, join_route_blocks
from ..operators.cleaning import keys_fine, number_tests, typed_fields
from ..schema import PAIR_KEYS, ROUTE_KEYS
from ..session import write_and_reread
from ..sources.flights import read_flights_text
from .carrier_ranking import AIRPORT_MEAN_FIELDS, RANKING_PRESETS, RankingRules, ranking_report
from .jobs import JOBS
from .route_stats import ROUTE_PRESETS, RouteRules, route_report

#: The analyses that can share a scan.
SHARED = tuple(name for name, job in JOBS.items() if not job.whole_rows)


def _mask(fields: Fields) -> Column:
    """Whether ``clean`` keeps a line for a report that reads these fields."""
    return keys_fine(fields.keys) & reduce(and_, number_tests(fields).values())


def _route_measures(rules: RouteRules) -> dict[str, Column]:
    typed, mask = typed_fields(rules.fields), _mask(rules.fields)
    cancelled = typed["cancelled"]
    if rules.whole_flag:
        whole = cancelled.try_cast("int")
        mask, cancelled = mask & whole.isNotNull(), (whole == 1).cast("int")
    own, delay = F.when(mask, cancelled), F.when(mask & (cancelled == 0), typed[rules.delay])
    return {
        "flights": F.count_if(mask),
        "delay_min": F.min(delay),
        "delay_max": F.max(delay),
        "delay_sum": F.sum(delay),
        "delay_flights": F.count(delay),
        "cancelled_sum": F.sum(own),
        "cancelled_known": F.count(own),
        "bits": month_bits(F.when(mask, typed["month"])),
    }


def _pair_measures(rules: RankingRules) -> dict[str, Column]:
    typed, own = typed_fields(rules.fields), _mask(rules.fields)
    airport = _mask(rules.airport) if rules.airport else own
    values = [typed[name] for name in ("cancelled", "dep_delay", "arr_delay")]
    if rules.missing == "zero":
        values = [F.coalesce(value, F.lit(0.0)) for value in values]
    cancelled, departure, arrival = values

    def total(value: Column, over: str, mask: Column) -> Column:
        return F.sum(F.when(mask & (cancelled == 0) if over == "operated" else mask, value))

    def operated(value: Column, mask: Column) -> Column:
        return F.count(F.when(mask & (cancelled == 0), value)).cast("double")

    mine = own & airport  # a carrier's flights are among its airport's
    return {
        "flights": F.count_if(mine),
        "cancelled_sum": F.sum(F.when(mine, cancelled)),
        "cancelled_known": F.count(F.when(mine, cancelled)),
        "dep_sum": total(departure, rules.carrier_delays, mine),
        "dep_flights": operated(departure, mine),
        "arr_sum": total(arrival, rules.carrier_delays, mine),
        "arr_flights": operated(arrival, mine),
        "airport_sum": total(departure, rules.airport_delays, airport),
        "airport_flights": operated(departure, airport),
    }


def _airport_measures() -> dict[str, Column]:
    typed, mask = typed_fields(AIRPORT_MEAN_FIELDS), _mask(AIRPORT_MEAN_FIELDS)
    operated = mask & (F.coalesce(typed["cancelled"], F.lit(0.0)) == 0)
    return {"delay_sum": F.sum(F.when(operated, F.coalesce(typed["dep_delay"], F.lit(0.0)))), "flights": F.count_if(operated)}


def _measures(name: str) -> tuple[str, dict[str, Column]]:
    """What a report's measures are called in the state, and how they are taken; reports that measure alike share a name."""
    if name in ROUTE_PRESETS:
        rules = ROUTE_PRESETS[name]
        return f"route_{rules.delay}_{rules.whole_flag}", _route_measures(rules)
    if name in RANKING_PRESETS:
        return name, _pair_measures(RANKING_PRESETS[name])
    return "airport", _airport_measures()


def shared_state(spark: SparkSession, path: str, names: Sequence[str] = SHARED) -> DataFrame:
    """One row per carrier, origin, destination and month block with the measures of the named reports.

    Keys that are blank or hold their column's name are NULL: such a flight can count for its airport only.
    """
    unknown = [name for name in names if name not in SHARED]
    if unknown:
        raise ValueError(f"{unknown} can't share a scan; these can: {', '.join(SHARED)}")
    measures = {f"{kind}_{measure}": column for kind, taken in map(_measures, names) for measure, column in taken.items()}
    columns = _columns(names)
    text = read_flights_text(spark, path, columns=columns)
    typed = typed_fields(Fields())
    keys = [(F.when(keys_fine([key]), typed[key]) if key in columns else F.lit(None).cast("string")).alias(key) for key in ROUTE_KEYS]
    block = month_block(typed["month"]) if "month" in columns else F.lit(0)
    return text.groupBy(*keys, block.alias("block")).agg(*[column.alias(name) for name, column in measures.items()])


def _columns(names: Sequence[str]) -> list[str]:
    """The columns that any of the reports reads, in the order of the flight schema."""
    read = {c for name in names for c in JOBS[name].fields.columns}
    return [c for c in Fields().columns if c in read]


def _report(name: str) -> Callable[[DataFrame], DataFrame]:
    """From a report's own measures under their plain names to its rows."""
    if name in ROUTE_PRESETS:
        return lambda own: route_report(join_route_blocks(own.where("flights > 0")), ROUTE_PRESETS[name])
    if name in RANKING_PRESETS:
        rules = RANKING_PRESETS[name]

        def ranking(own: DataFrame) -> DataFrame:
            own = own.where(F.col("origin").isNotNull())
            sums = [F.sum(c).alias(c) for c in own.columns if c not in (*ROUTE_KEYS, "block")]
            pairs = own.groupBy(*PAIR_KEYS).agg(*sums)
            return ranking_report(pairs if rules.airport else pairs.where("flights > 0"), rules, rules.airport is not None)

        return ranking

    def airport_mean(own: DataFrame) -> DataFrame:
        sums = own.where("flights > 0").groupBy("origin").agg(F.sum("delay_sum").alias("s"), F.sum("flights").alias("n"))
        mean = F.col("s") / F.col("n")
        return sums.select("origin", (mean if name == "airport_mean_unrounded" else round_half_even(mean, 2)).alias("airport_mean"))

    return airport_mean


def shared_reports(spark: SparkSession, path: str, names: Sequence[str] = SHARED) -> dict[str, DataFrame]:
    """The named reports over the flights at ``path``, which are scanned once, when this is called."""
    state = write_and_reread(shared_state(spark, path, names), "shared")
    reports = {}
    for name in names:
        kind, measures = _measures(name)
        own = state.select(*ROUTE_KEYS, "block", *[F.col(f"{kind}_{measure}").alias(measure) for measure in measures])
        reports[name] = _report(name)(own)
    return reports


def run_jobs(spark: SparkSession, input_path: str, outputs: dict[str, str], formats: dict[str, str] | None = None) -> None:
    """Write several reports, ``{analysis: folder}``, after one scan; analyses that compare whole rows are refused."""
    for name, report in shared_reports(spark, input_path, list(outputs)).items():
        writers = JOBS[name].formats
        writers[(formats or {}).get(name) or next(iter(writers))](report, outputs[name])
