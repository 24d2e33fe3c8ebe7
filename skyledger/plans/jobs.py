"""File-to-file jobs: read flights, run one analysis, write its report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import round_half_even
from ..operators import Fields, distinct_by_digest, nest, operated_airport_means
from ..schema import RANKING_LIST, ROUTE_LIST
from ..sinks import (
    ranking_lines,
    route_json_lines,
    route_lines,
    write_airport_means,
    write_csv,
    write_json,
    write_text,
)
from ..sources import read_accounted, read_airport_means, read_flights
from .carrier_ranking import AIRPORT_MEAN_FIELDS, RANKING_PRESETS, RankingRules, carrier_ranking
from .route_state import merge_batch, state_report
from .route_stats import ROUTE_PRESETS, route_stats

Writer = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class Job:
    """``report`` makes rows from flights; ``formats`` are its writers, the first by default.

    ``fields`` are those it reads of a flight, ``airport`` those it reads for the airport's mean if they are
    fewer; ``whole_rows`` reads every column of the file, for a report that compares whole rows;
    ``takes_means`` says that the report can look airport means up in a saved table.
    """

    report: Callable[..., DataFrame]
    formats: dict[str, Writer]
    fields: Fields
    airport: Fields | None = None
    whole_rows: bool = False
    takes_means: bool = False


def _routes_nested(stats: DataFrame, path: str) -> None:
    write_json(nest(stats, "Compagnia", ROUTE_LIST), path)


def _routes_as_text(stats: DataFrame, path: str) -> None:
    write_text(route_lines(stats), path)


def _routes_as_json_text(stats: DataFrame, path: str) -> None:
    write_text(route_json_lines(stats), path)


def _ranking_nested(ranking: DataFrame, path: str) -> None:
    write_json(nest(ranking, "Aeroporto", RANKING_LIST), path)


def _ranking_as_text(ranking: DataFrame, path: str) -> None:
    write_text(ranking_lines(ranking.orderBy("Aeroporto", "Posizione_Classifica")), path)


def _airport_mean(flights: DataFrame, digits: int | None) -> DataFrame:
    means = operated_airport_means(flights)
    if digits is None:
        return means
    return means.withColumn("airport_mean", round_half_even(F.col("airport_mean"), digits))


def _ranking_of_distinct(flights: DataFrame, rules: RankingRules, **options: DataFrame) -> DataFrame:
    """A ranking of a file's flights that counts equal rows once; the file is read once."""
    return carrier_ranking(distinct_by_digest(flights), replace(rules, dedupe=False), **options)


def _jobs() -> dict[str, Job]:
    routes = {"nested": _routes_nested, "text": _routes_as_text, "json_text": _routes_as_json_text}
    jobs = {}
    for name, rules in ROUTE_PRESETS.items():
        formats = {"csv": write_csv} if rules.text_months else routes
        jobs[name] = Job(partial(route_stats, rules=rules), formats, rules.fields)
    for name, rules in RANKING_PRESETS.items():
        formats = {"text": _ranking_as_text, "nested": _ranking_nested}
        if rules.dense:
            formats = dict(reversed(formats.items()))
        jobs[name] = Job(
            partial(_ranking_of_distinct if rules.dedupe else carrier_ranking, rules=rules),
            formats,
            rules.fields,
            rules.airport,
            whole_rows=rules.dedupe,
            takes_means=True,
        )
    means = {"tsv": write_airport_means}
    jobs["airport_mean"] = Job(partial(_airport_mean, digits=2), means, AIRPORT_MEAN_FIELDS)
    jobs["airport_mean_unrounded"] = Job(partial(_airport_mean, digits=None), means, AIRPORT_MEAN_FIELDS)
    return jobs


JOBS = _jobs()


def run_job(
    spark: SparkSession,
    name: str,
    input_path: str,
    output_path: str,
    fmt: str | None = None,
    means_path: str | None = None,
    rejects_path: str | None = None,
) -> dict[str, int] | None:
    """Run the analysis ``name`` over the flights at ``input_path`` into ``output_path``.

    ``means_path`` names a table written by an ``airport_mean`` job; a ranking then takes
    the airport means from it instead of working them out. With ``rejects_path``, the lines that the
    report leaves out are written there as CSV with the reason and the file, and the numbers of lines are returned:
    ``lines``, ``kept`` and each reason's.
    """
    job = JOBS[name]
    write = job.formats[fmt or next(iter(job.formats))]
    options = {}
    if means_path:
        if not job.takes_means:
            raise ValueError(f"{name} takes no airport means")
        options["airport_means"] = read_airport_means(spark, means_path)
    if not rejects_path:
        write(job.report(read_for(spark, job, input_path, with_airport=not means_path), **options), output_path)
        return None
    airport = None if means_path else job.airport
    account = read_accounted(spark, input_path, job.fields, job.whole_rows, airport=airport)
    write(job.report(account.flights, **options), output_path)
    write_csv(account.rejects, rejects_path)
    return {"lines": account.lines, "kept": account.lines - sum(account.reasons.values())} | account.reasons


def merge_job(spark: SparkSession, name: str, input_path: str, state: str, batch: str) -> None:
    """Merge the flights at ``input_path`` as one batch into the state of a route analysis."""
    merge_batch(read_for(spark, JOBS[name], input_path), ROUTE_PRESETS[name], state, batch)


def state_job(spark: SparkSession, name: str, state: str, output_path: str, fmt: str | None = None) -> None:
    """Write the report of a route analysis over all batches of its state."""
    job = JOBS[name]
    job.formats[fmt or next(iter(job.formats))](state_report(spark, ROUTE_PRESETS[name], state), output_path)


def read_for(spark: SparkSession, job: Job, path: str, with_airport: bool = True) -> DataFrame:
    """The flights that a job's report needs, with the columns it reads and no others."""
    airport = job.airport if with_airport else None
    return read_flights(spark, path, job.fields, keep_rest=job.whole_rows, airport=airport)
