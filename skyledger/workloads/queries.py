"""Every operator and analysis as a query: ``(spark, folder) -> DataFrame``.

All of them run over whole tables. Lists are shown as rows or as text, so that a result
can be compared column by column.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import functions as fn, operators as ops, sinks, sources
from ..plans import JOBS, ROUTE_PRESETS, merge_batch, ranking_preset, read_for, route_preset, shared_reports, state_report
from ..schema import RANKING_LIST, RANKING_REPORT, ROUTE_KEYS, ROUTE_LIST
from ..session import scratch_folder, write_and_reread
from .voli import voli, voli_raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _columns(df: DataFrame, **renamed: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in renamed.items()))


def _mesi_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("Mesi", F.array_join(F.col("Mesi").cast("array<string>"), ","))


# ---- analyses


@_query
def route_stats_arr(spark: SparkSession, folder: str) -> DataFrame:
    return _mesi_as_text(route_preset(voli(spark, folder), "route_stats_arr"))


@_query
def route_stats_dep_flat(spark: SparkSession, folder: str) -> DataFrame:
    return route_preset(voli(spark, folder), "route_stats_dep_flat")


@_query
def route_stats_dep_nested(spark: SparkSession, folder: str) -> DataFrame:
    return _mesi_as_text(route_preset(voli(spark, folder), "route_stats_dep_nested"))


@_query
def ranking_sql(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_preset(voli(spark, folder), "ranking_sql")


@_query
def ranking_zero_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_preset(voli(spark, folder), "ranking_zero_dedupe")


@_query
def ranking_zero_excl(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_preset(voli(spark, folder), "ranking_zero_excl")


@_query
def ranking_zero_incl(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_preset(voli(spark, folder), "ranking_zero_incl")


# ---- sources and sinks


@_query
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "scan_csv")
    sinks.write_csv(voli(spark, folder), path)
    return sources.read_flights(spark, path)


@_query
def resolve_columns(spark: SparkSession, folder: str) -> DataFrame:
    raw = voli_raw(spark, folder)
    shuffled = raw.select(
        F.lit("2024").alias("YEAR"),
        *(F.col(name).alias(f" {name.upper()} ") for name in reversed(raw.columns)),
    )
    return sources.resolve_columns(shuffled)


def _raw_file(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "raw")
    sinks.write_csv(voli_raw(spark, folder), path)
    return path


@_query
def clean_flights(spark: SparkSession, folder: str) -> DataFrame:
    return sources.read_flights(spark, _raw_file(spark, folder))


@_query
def resolve_mixed_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "mixed")
    flights = voli(spark, folder)
    sinks.write_csv(flights.where("cancelled = 0"), f"{path}/part=a")
    sinks.write_csv(flights.where("cancelled <> 0").select(*reversed(flights.columns)), f"{path}/part=b")
    return sources.read_flights(spark, f"{path}/*")


@_query
def resolve_by_layout(spark: SparkSession, folder: str) -> DataFrame:
    """About a thousand files in three column orders."""
    path = scratch_folder(spark, "layouts")
    flights = write_and_reread(voli(spark, folder), "flights")
    part = F.pmod(F.xxhash64(*flights.columns), F.lit(3))
    names = flights.columns
    for i, columns in enumerate((names, names[::-1], names[3:] + names[:3])):
        sinks.write_csv(flights.where(part == i).select(*columns).repartition(334), f"{path}/part={i}")
    return sources.read_flights(spark, f"{path}/*")


@_query
def scan_quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Notes with line breaks, quotes and commas in quotes, in files that are cut every 64 kB.

    A task reads many of these cuts, as many tasks as would read the files uncut: a task of its own for each costs more than
    its lines do.
    """
    path = scratch_folder(spark, "quoted")
    raw = voli_raw(spark, folder)
    breaks = F.when(F.col("month") == "7", F.lit("\n")).when(F.col("month") == "3", F.lit('"\n\n, "')).otherwise(F.lit(" to "))
    note = F.concat_ws("", F.lit("from "), "origin", breaks, "dest", F.when(F.col("month") == "5", F.lit('\n"')))
    sinks.write_csv(raw.select("op_unique_carrier", note.alias("note"), "dep_delay"), path)
    cut = spark.newSession()
    cut.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 16))
    cut.conf.set("spark.sql.files.openCostInBytes", "0")
    cut.conf.set("spark.sql.files.maxPartitionNum", str(max(1, spark.read.text(path).rdd.getNumPartitions())))
    found = scratch_folder(spark, "records")
    schema = "op_unique_carrier string, note string, dep_delay string"
    sources.read_quoted_csv(cut, path, schema).write.parquet(found)
    return spark.read.schema(schema).parquet(found)


@_query
def infer_types(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"raw": voli_raw, "clean": voli}
    found = {name: write_and_reread(sources.infer_types(table(spark, folder)), "types") for name, table in tables.items()}
    found["both"] = sources.merge_types(*found.values())
    rows = [types.select(F.lit(name).alias("source"), "column", "type") for name, types in found.items()]
    return reduce(DataFrame.unionByName, rows)


@_query
def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Over lines without headers, whose number would be that of the files."""
    path, raw = scratch_folder(spark, "lines"), voli_raw(spark, folder)
    raw.write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    account = sources.read_accounted(spark, path, header=raw.columns)
    left_out = account.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    return left_out.unionByName(account.flights.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("lines")))


@_query
def sink_csv_raw_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    schema = voli_raw(spark, folder).schema
    return spark.read.options(header=True, **sources.DIALECT).schema(schema).csv(_raw_file(spark, folder))


@_query
def sink_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "sink_overwrite")
    means = ops.operated_airport_means(voli(spark, folder))
    sinks.write_csv(voli(spark, folder), path)
    sinks.write_csv(means, path)
    return spark.read.options(header=True, **sources.DIALECT).schema(means.schema).csv(path)


# ---- jobs from a file with every kind of bad field


def _job(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return JOBS[name].report(read_for(spark, JOBS[name], _raw_file(spark, folder)))


@_query
def job_ranking_sql(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, "ranking_sql")


@_query
def job_ranking_zero_excl(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, "ranking_zero_excl")


@_query
def job_ranking_zero_incl(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, "ranking_zero_incl")


@_query
def job_route_stats_arr(spark: SparkSession, folder: str) -> DataFrame:
    return _mesi_as_text(_job(spark, folder, "route_stats_arr"))


@_query
def job_route_stats_dep_flat(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, "route_stats_dep_flat")


@_query
def job_ranking_zero_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, "ranking_zero_dedupe")


@_query
def job_route_stats_dep_nested(spark: SparkSession, folder: str) -> DataFrame:
    return _mesi_as_text(_job(spark, folder, "route_stats_dep_nested"))


@_query
def route_state_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, one of which came incomplete at first and is sent again."""
    state = scratch_folder(spark, "state")
    rules = ROUTE_PRESETS["route_stats_arr"]
    flights = write_and_reread(voli(spark, folder), "flights")
    batch = F.pmod(F.xxhash64(*flights.columns), F.lit(3))
    merge_batch(flights.where((batch == 1) & (F.col("month") < 7)), rules, state, "b1")
    for i in range(3):
        merge_batch(flights.where(batch == i), rules, state, f"b{i}")
    return _mesi_as_text(state_report(spark, rules, state))


def _one_shape(name: str, report: DataFrame) -> DataFrame:
    """Routes, rankings and means under common columns."""
    if "Tratta" in report.columns:
        picked = ["Compagnia", "Tratta", "Voli", "Min", "Max", "Medio", "Cancellazioni", None]
        months = report["Mesi"] if dict(report.dtypes)["Mesi"] == "string" else F.array_join(report["Mesi"].cast("array<string>"), ",")
    elif "Aeroporto" in report.columns:
        delays = ["Ritardo_Medio_Partenza", "Ritardo_Medio_Arrivo", "Differenza_Dalla_Media_APT"]
        picked = ["Compagnia", "Aeroporto", "Voli_Operati", *delays, "Tasso_Cancellazione", "Posizione_Classifica"]
        months = F.lit(None).cast("string")
    else:
        picked = [None, "origin", None, "airport_mean", None, None, None, None]
        months = F.lit(None).cast("string")
    kinds = {"carrier": "string", "place": "string", "flights": "bigint", "x1": "double", "x2": "double", "x3": "double", "rate": "double", "position": "int"}
    columns = [(F.lit(None) if old is None else F.col(old)).cast(kind).alias(new) for (new, kind), old in zip(kinds.items(), picked)]
    return report.select(F.lit(name).alias("job"), *columns, months.alias("months"))


@_query
def job_all_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All reports that can share a scan, from one."""
    reports = shared_reports(spark, _raw_file(spark, folder))
    return reduce(DataFrame.unionByName, [_one_shape(name, report) for name, report in reports.items()])


@_query
def job_airport_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, "airport_mean")


@_query
def sink_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "sink_json")
    nested = ops.nest(ranking_preset(voli(spark, folder), "ranking_sql"), "Aeroporto", RANKING_LIST)
    sinks.write_json(nested, path)
    written = spark.read.schema(nested.schema).json(path)
    return ops.unnest(written, "Aeroporto", RANKING_LIST).select(*RANKING_REPORT)


@_query
def sink_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "sink_csv")
    stats = route_preset(voli(spark, folder), "route_stats_dep_flat")
    sinks.write_csv(stats, path)
    return spark.read.options(header=True, escape='"').schema(stats.schema).csv(path)


@_query
def sink_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "sink_text")
    sinks.write_text(sinks.ranking_lines(ranking_preset(voli(spark, folder), "ranking_zero_dedupe")), path)
    return _columns(spark.read.text(path), line="value")


@_query
def sink_means_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "sink_means")
    sinks.write_airport_means(ops.operated_airport_means(voli(spark, folder)), path)
    return sources.read_airport_means(spark, path)


@_query
def report_line_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return _columns(sinks.ranking_lines(ranking_preset(voli(spark, folder), "ranking_zero_incl")), line="value")


@_query
def report_line_route(spark: SparkSession, folder: str) -> DataFrame:
    return _columns(sinks.route_lines(route_preset(voli(spark, folder), "route_stats_arr")), line="value")


@_query
def report_line_json(spark: SparkSession, folder: str) -> DataFrame:
    stats = route_preset(voli(spark, folder), "route_stats_arr")
    parts = F.split("value", "\t", 2)
    record = F.from_json(parts[1], stats.drop("Compagnia").schema)
    parsed = sinks.route_json_lines(stats).select(parts[0].alias("Compagnia"), record.alias("record"))
    return _mesi_as_text(parsed.select("Compagnia", "record.*"))


@_query
def preview_top10(spark: SparkSession, folder: str) -> DataFrame:
    stats = route_preset(voli(spark, folder), "route_stats_dep_flat")
    return sinks.preview(stats, 10, "Compagnia", "Tratta")


@_query
def temp_view_sql(spark: SparkSession, folder: str) -> DataFrame:
    voli(spark, folder).createOrReplaceTempView("voli")
    return spark.sql(
        """
        SELECT origin, month, count(*) AS flights, count_if(cancelled = 1) AS cancelled_flights,
               max(dep_delay) FILTER (WHERE cancelled = 0) AS worst_departure
        FROM voli GROUP BY origin, month
        """
    )


# ---- projections and filters


@_query
def project_flights(spark: SparkSession, folder: str) -> DataFrame:
    return ops.project_flights(voli(spark, folder))


@_query
def drop_malformed(spark: SparkSession, folder: str) -> DataFrame:
    return ops.drop_malformed(sources.read_flights_text(spark, _raw_file(spark, folder)))


@_query
def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return ops.filter_not_null(voli_raw(spark, folder), *ROUTE_KEYS)


@_query
def filter_blank_keys(spark: SparkSession, folder: str) -> DataFrame:
    return ops.filter_blank_keys(voli_raw(spark, folder), *ROUTE_KEYS)


@_query
def filter_embedded_header(spark: SparkSession, folder: str) -> DataFrame:
    return ops.filter_embedded_header(voli_raw(spark, folder))


@_query
def filter_contains_ci(spark: SparkSession, folder: str) -> DataFrame:
    needles = {"month": "month", "op_unique_carrier": "op_unique_carrier"}
    return ops.filter_contains_ci(voli_raw(spark, folder), needles)


@_query
def filter_operated(spark: SparkSession, folder: str) -> DataFrame:
    return ops.filter_operated(voli(spark, folder))


# ---- lookups


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return ops.pair_sums(voli(spark, folder), missing="zero")


def _rounded_means(pairs: DataFrame) -> DataFrame:
    means = ops.airport_means(pairs, default=0.0)
    return means.withColumn("airport_mean", fn.round_half_even(F.col("airport_mean"), 2))


def _with_difference(joined: DataFrame) -> DataFrame:
    mean = fn.round_half_even(fn.safe_divide(F.col("dep_sum"), F.col("dep_flights"), 0.0), 2)
    return joined.select(
        "origin",
        F.col("op_unique_carrier").alias("carrier"),
        mean.alias("dep_mean"),
        "airport_mean",
        fn.round_half_even(mean - F.col("airport_mean"), 2).alias("difference"),
    )


@_query
def join_airport_mean(spark: SparkSession, folder: str) -> DataFrame:
    pairs = write_and_reread(_pairs(spark, folder), "pairs")
    return _with_difference(ops.join_airport_mean(pairs, _rounded_means(pairs)))


@_query
def join_side_table(spark: SparkSession, folder: str) -> DataFrame:
    pairs = write_and_reread(_pairs(spark, folder), "pairs")
    path = scratch_folder(spark, "airport_means")
    sinks.write_airport_means(_rounded_means(pairs), path)
    return _with_difference(ops.join_airport_mean(pairs, sources.read_airport_means(spark, path)))


# ---- aggregates


_ROUTE = ("carrier", "origin", "dest")


def _operated_delay() -> Column:
    return F.when(F.col("cancelled") == 0, F.col("dep_delay"))


def _by_route(spark: SparkSession, folder: str, *aggregates: Column) -> DataFrame:
    flights = voli(spark, folder).withColumnRenamed("op_unique_carrier", "carrier")
    return flights.groupBy(*_ROUTE).agg(*aggregates)


@_query
def agg_count(spark: SparkSession, folder: str) -> DataFrame:
    return _by_route(spark, folder, F.count(F.lit(1)).alias("flights"))


@_query
def agg_min_max(spark: SparkSession, folder: str) -> DataFrame:
    delay = _operated_delay()
    return _by_route(spark, folder, F.min(delay).alias("delay_min"), F.max(delay).alias("delay_max"))


@_query
def agg_cond_avg(spark: SparkSession, folder: str) -> DataFrame:
    return _by_route(spark, folder, F.avg(_operated_delay()).alias("delay_mean"))


@_query
def agg_cond_sum_count(spark: SparkSession, folder: str) -> DataFrame:
    delay = _operated_delay()
    return _by_route(spark, folder, F.sum(delay).alias("delay_sum"), F.count(delay).alias("delay_flights"))


@_query
def agg_cancel_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _by_route(spark, folder, fn.round_half_up(F.avg("cancelled"), 4).alias("rate"))


def _months_by_route(spark: SparkSession, folder: str) -> DataFrame:
    sums = ops.route_sums(voli(spark, folder), _operated_delay(), F.col("cancelled"))
    return sums.withColumnRenamed("op_unique_carrier", "carrier").select(*_ROUTE, "months")


@_query
def agg_months_set(spark: SparkSession, folder: str) -> DataFrame:
    return _months_by_route(spark, folder).withColumn("month", F.explode("months")).drop("months")


@_query
def months_text(spark: SparkSession, folder: str) -> DataFrame:
    return _months_by_route(spark, folder).withColumn("months", fn.months_text(F.col("months")))


@_query
def pair_sums(spark: SparkSession, folder: str) -> DataFrame:
    pairs = ops.pair_sums(voli(spark, folder), "zero", "all", "all", "uncancelled")
    return pairs.select(
        "origin",
        F.col("op_unique_carrier").alias("carrier"),
        "flights",
        "cancelled_sum",
        "dep_sum",
        "arr_sum",
        F.col("dep_flights").alias("valid_flights"),
    )


@_query
def airport_mean(spark: SparkSession, folder: str) -> DataFrame:
    return ops.airport_means(_pairs(spark, folder), default=0.0)


@_query
def airport_mean_operated(spark: SparkSession, folder: str) -> DataFrame:
    means = ops.operated_airport_means(voli(spark, folder))
    return means.withColumn("airport_mean", fn.round_half_even(F.col("airport_mean"), 2))


@_query
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dedupe_rows(voli(spark, folder))


@_query
def dedupe_by_digest(spark: SparkSession, folder: str) -> DataFrame:
    return ops.distinct_by_digest(voli(spark, folder))


@_query
def nest_routes(spark: SparkSession, folder: str) -> DataFrame:
    stats = route_preset(voli(spark, folder), "route_stats_dep_nested")
    return _mesi_as_text(ops.unnest(ops.nest(stats, "Compagnia", ROUTE_LIST), "Compagnia", ROUTE_LIST))


@_query
def nest_ranking(spark: SparkSession, folder: str) -> DataFrame:
    nested = ops.nest(ranking_preset(voli(spark, folder), "ranking_sql"), "Aeroporto", RANKING_LIST)
    return ops.unnest(nested, "Aeroporto", RANKING_LIST)


# ---- windows and order


def _pair_means(spark: SparkSession, folder: str) -> DataFrame:
    pairs = ops.pair_sums(voli(spark, folder))
    return pairs.withColumn("dep_mean", fn.round_half_up(fn.safe_divide(F.col("dep_sum"), F.col("dep_flights")), 2))


@_query
def win_airport_sum(spark: SparkSession, folder: str) -> DataFrame:
    return ops.with_airport_sums(_pair_means(spark, folder)).select(
        "origin",
        F.col("op_unique_carrier").alias("carrier"),
        F.col("airport_sum_all").alias("airport_sum"),
        F.col("airport_flights_all").alias("airport_flights"),
    )


def _ranked(spark: SparkSession, folder: str, position: Callable[[str], Column]) -> DataFrame:
    return _pair_means(spark, folder).select(
        "origin", F.col("op_unique_carrier").alias("carrier"), "dep_mean", position("dep_mean").alias("position")
    )


@_query
def rank_dense(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked(spark, folder, ops.dense_position)


@_query
def rank_row_number(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked(spark, folder, ops.sequence_position)


@_query
def diff_from_airport(spark: SparkSession, folder: str) -> DataFrame:
    airport_mean = fn.safe_divide(F.col("airport_sum_all"), F.col("airport_flights_all"))
    return ops.with_airport_sums(_pair_means(spark, folder)).select(
        "origin",
        F.col("op_unique_carrier").alias("carrier"),
        fn.round_half_up(F.col("dep_mean") - airport_mean, 2).alias("difference"),
    )


@_query
def sort_airport_mean(spark: SparkSession, folder: str) -> DataFrame:
    means = _columns(_pair_means(spark, folder), origin="origin", carrier="op_unique_carrier", dep_mean="dep_mean")
    return means.orderBy("origin", F.col("dep_mean").asc_nulls_first(), "carrier")


# ---- scalar functions


@_query
def route_label(spark: SparkSession, folder: str) -> DataFrame:
    return voli(spark, folder).select(fn.route_label(F.col("origin"), F.col("dest")).alias("route"))


@_query
def round_half_up(spark: SparkSession, folder: str) -> DataFrame:
    return agg_cond_avg(spark, folder).withColumn("delay_mean", fn.round_half_up(F.col("delay_mean"), 2))


@_query
def round_half_even(spark: SparkSession, folder: str) -> DataFrame:
    return agg_cond_avg(spark, folder).withColumn("delay_mean", fn.round_half_even(F.col("delay_mean"), 2))


@_query
def coalesce_zero(spark: SparkSession, folder: str) -> DataFrame:
    return voli(spark, folder).select(
        "origin",
        F.coalesce("dep_delay", F.lit(0.0)).alias("dep_delay"),
        F.coalesce("arr_delay", F.lit(0.0)).alias("arr_delay"),
    )


@_query
def null_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    return voli_raw(spark, folder).select(
        fn.null_sentinel(F.col("dep_delay")).alias("dep_delay"), fn.null_sentinel(F.col("arr_delay")).alias("arr_delay")
    )


@_query
def try_cast_numeric(spark: SparkSession, folder: str) -> DataFrame:
    raw = voli_raw(spark, folder)
    month = fn.try_number(F.col("month"), "int")
    return raw.select(
        F.coalesce(month, F.lit(-1)).alias("month_or_minus_one"),
        fn.try_number(F.col("dep_delay"), "double").alias("dep_delay"),
        fn.try_number(F.col("cancelled"), "double").alias("cancelled"),
    )


@_query
def trim_lower(spark: SparkSession, folder: str) -> DataFrame:
    carrier = F.lower(fn.strip(F.col("op_unique_carrier")))
    return voli_raw(spark, folder).select(
        carrier.alias("carrier"),
        F.coalesce(carrier.contains("unique"), F.lit(False)).alias("is_header"),
        fn.strip(F.col("origin")).alias("origin"),
    )


@_query
def json_struct_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    flights = voli(spark, folder)
    record = F.to_json(F.struct(*flights.columns))
    return flights.select(F.from_json(record, flights.schema).alias("flight")).select("flight.*")


@_query
def split_delimited(spark: SparkSession, folder: str) -> DataFrame:
    delays = (F.coalesce(c, F.lit(0.0)) for c in ("dep_delay", "arr_delay"))
    line = F.concat(F.col("origin"), F.lit("\t"), F.concat_ws(";", "op_unique_carrier", *delays, "cancelled"))
    lines = voli(spark, folder).select(F.split(line, "\t").alias("parts"))
    values = lines.select(F.col("parts")[0].alias("origin"), F.split(F.col("parts")[1], ";").alias("v"))
    return values.select(
        "origin",
        F.col("v")[0].alias("carrier"),
        F.col("v")[1].cast("double").alias("dep_delay"),
        F.col("v")[2].cast("double").alias("arr_delay"),
        F.col("v")[3].cast("double").alias("cancelled"),
    )


@_query
def safe_divide(spark: SparkSession, folder: str) -> DataFrame:
    sums = agg_cond_sum_count(spark, folder)
    return sums.select(
        *_ROUTE,
        fn.safe_divide(F.col("delay_sum"), F.col("delay_flights"), 0.0).alias("mean_or_zero"),
        fn.safe_divide(F.col("delay_sum"), F.col("delay_flights")).alias("mean_or_null"),
    )
