"""The analyses on a small hand-made file with every special case, and their general properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger import RANKING_PRESETS, ROUTE_PRESETS, ranking_preset, read_flights, route_preset
from skyledger.schema import PAIR_KEYS, RANKING_REPORT, ROUTE_REPORT
from skyledger.workloads.voli import voli

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hand(spark, hand_csv):
    return read_flights(spark, hand_csv).cache()


def rows(df, columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_cleaning_keeps_the_ten_good_rows(hand):
    assert hand.count() == 10
    assert dict(hand.dtypes) == {
        "month": "int",
        "op_unique_carrier": "string",
        "origin": "string",
        "dest": "string",
        "dep_delay": "double",
        "arr_delay": "double",
        "cancelled": "double",
    }
    assert hand.where("op_unique_carrier = 'EE, Inc'").count() == 1


ROUTES_ARR = {
    ("AA", "JFK -> LAX", 4, -10.0, 5.0, 0.0, 0.25, (1, 2, 10)),
    ("BB", "JFK -> LAX", 2, None, None, None, 0.5, (3,)),
    ("BB", "JFK -> SFO", 1, None, None, None, 0.0, (4,)),
    ("CC", "JFK -> SFO", 1, None, None, None, 1.0, (5,)),
    ("DD", "BOS -> JFK", 1, 1.0, 1.0, 1.0, 0.0, (5,)),
    ("EE, Inc", "BOS -> JFK", 1, 2.0, 2.0, 2.0, 0.0, (6,)),
}
ROUTES_DEP = {
    ("AA", "JFK -> LAX", 4, -4.0, 10.0, 5.33, 0.25, "1,10,2"),
    ("BB", "JFK -> LAX", 2, 6.0, 6.0, 6.0, 0.5, "3"),
    ("BB", "JFK -> SFO", 1, None, None, None, 0.0, "4"),
    ("CC", "JFK -> SFO", 1, None, None, None, 1.0, "5"),
    ("DD", "BOS -> JFK", 1, 7.0, 7.0, 7.0, 0.0, "5"),
    ("EE, Inc", "BOS -> JFK", 1, 7.0, 7.0, 7.0, 0.0, "6"),
}


def test_route_stats_arr(hand):
    stats = route_preset(hand, "route_stats_arr")
    assert stats.columns == list(ROUTE_REPORT)
    got = {(*t[:-1], tuple(t[-1])) for t in map(tuple, stats.collect())}
    assert got == ROUTES_ARR


def test_route_stats_dep_flat(hand):
    assert rows(route_preset(hand, "route_stats_dep_flat"), ROUTE_REPORT) == ROUTES_DEP


def test_route_stats_dep_nested_shows_zero_for_missing(hand):
    stats = route_preset(hand, "route_stats_dep_nested")
    got = rows(stats, ROUTE_REPORT[:-1])
    assert got == {tuple(0.0 if v is None else v for v in t[:-1]) for t in ROUTES_DEP}
    assert dict(stats.dtypes)["Mesi"] == "array<int>"


BOS = {("BOS", 1, "DD", 1, 7.0, 1.0, 0.0, 0.0), ("BOS", 2, "EE, Inc", 1, 7.0, 2.0, 0.0, 0.0)}
RANKINGS = {
    "ranking_sql": {
        ("JFK", 1, "CC", 1, None, None, 1.0, None),
        ("JFK", 2, "AA", 4, 5.33, 0.0, 0.25, -0.17),
        ("JFK", 3, "BB", 3, 6.0, None, 0.3333, 0.5),
        ("BOS", 1, "DD", 1, 7.0, 1.0, 0.0, 0.0),
        ("BOS", 1, "EE, Inc", 1, 7.0, 2.0, 0.0, 0.0),
    },
    "ranking_zero_dedupe": BOS
    | {
        ("JFK", 1, "CC", 1, 0.0, 0.0, 1.0, -8.0),
        ("JFK", 2, "AA", 3, 3.0, -2.5, 0.3333, -5.0),
        ("JFK", 3, "BB", 3, 13.0, 0.0, 0.3333, 5.0),
    },
    "ranking_zero_excl": BOS
    | {
        ("JFK", 1, "CC", 1, 0.0, 0.0, 1.0, -4.4),
        ("JFK", 2, "BB", 3, 3.0, 0.0, 0.3333, -1.4),
        ("JFK", 3, "AA", 4, 5.33, 0.0, 0.25, 0.93),
    },
    "ranking_zero_incl": BOS
    | {
        ("JFK", 1, "CC", 1, 0.0, 0.0, 1.0, -4.4),
        ("JFK", 2, "AA", 4, 5.33, 0.0, 0.25, 0.93),
        ("JFK", 3, "BB", 3, 13.0, 0.0, 0.3333, 8.6),
    },
}


@pytest.mark.parametrize("name", RANKING_PRESETS)
def test_rankings(hand, name):
    ranking = ranking_preset(hand, name)
    assert ranking.columns == list(RANKING_REPORT)
    assert rows(ranking, RANKING_REPORT) == RANKINGS[name]


@pytest.fixture(scope="module")
def flights(spark):
    return voli(spark, SMALL).cache()


@pytest.mark.parametrize("name", [n for n, r in RANKING_PRESETS.items() if not r.dedupe])
def test_ranking_counts_every_flight(flights, name):
    total = ranking_preset(flights, name).agg(F.sum("Voli_Operati")).first()[0]
    assert total == flights.count()


@pytest.mark.parametrize("name", ROUTE_PRESETS)
def test_route_stats_count_every_flight(flights, name):
    assert route_preset(flights, name).agg(F.sum("Voli")).first()[0] == flights.count()


@pytest.mark.parametrize("name", RANKING_PRESETS)
def test_doubled_input_doubles_counts_only(flights, name):
    once = rows(ranking_preset(flights, name), RANKING_REPORT)
    twice = rows(ranking_preset(flights.unionAll(flights), name), RANKING_REPORT)
    factor = 1 if RANKING_PRESETS[name].dedupe else 2
    assert twice == {(*t[:3], t[3] * factor, *t[4:]) for t in once}


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_positions_run_from_one_without_gaps(spark, flights, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranking = ranking_preset(flights, "ranking_zero_dedupe").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    airports = {}
    for row in ranking:
        airports.setdefault(row.Aeroporto, []).append(row)
    for carriers in airports.values():
        carriers.sort(key=lambda r: r.Posizione_Classifica)
        assert [r.Posizione_Classifica for r in carriers] == list(range(1, len(carriers) + 1))
        means = [r.Ritardo_Medio_Partenza for r in carriers]
        assert means == sorted(means)


def test_one_hot_airport_gives_the_same_result(spark, flights):
    """A third of all flights in one route changes no other airport's rows."""
    hot = spark.range(flights.count() // 2).selectExpr(
        "1 AS month",
        "'HOT' AS op_unique_carrier",
        "'HUB' AS origin",
        "'END' AS dest",
        "CAST(id % 7 AS DOUBLE) AS dep_delay",
        "CAST(NULL AS DOUBLE) AS arr_delay",
        "0.0D AS cancelled",
    )
    skewed = ranking_preset(flights.unionByName(hot), "ranking_sql")
    assert rows(skewed.where("Aeroporto <> 'HUB'"), RANKING_REPORT) == rows(
        ranking_preset(flights, "ranking_sql"), RANKING_REPORT
    )
    (hub,) = skewed.where("Aeroporto = 'HUB'").collect()
    assert hub.Voli_Operati == hot.count() and hub.Ritardo_Medio_Arrivo is None


def test_a_row_copied_very_often_counts_once(spark, flights):
    copies = spark.range(200_000).select(F.lit(None).alias("id")).crossJoin(F.broadcast(flights.limit(1))).drop("id")
    assert rows(ranking_preset(flights.unionAll(copies), "ranking_zero_dedupe"), RANKING_REPORT) == rows(
        ranking_preset(flights, "ranking_zero_dedupe"), RANKING_REPORT
    )


def test_missing_flag(spark):
    """Each variant has its own reading of a flight without a cancellation flag."""
    flights = spark.createDataFrame(
        [(1, "AA", "JFK", "LAX", 4.0, 2.0, None), (1, "AA", "JFK", "LAX", 8.0, 6.0, 0.0)],
        "month int, op_unique_carrier string, origin string, dest string, "
        "dep_delay double, arr_delay double, cancelled double",
    )
    assert route_preset(flights, "route_stats_arr").first().Voli == 1
    flat = route_preset(flights, "route_stats_dep_flat").first()
    assert (flat.Voli, flat.Medio, flat.Cancellazioni) == (2, 8.0, 0.0)
    assert ranking_preset(flights, "ranking_sql").first().Ritardo_Medio_Partenza == 8.0
    assert ranking_preset(flights, "ranking_zero_excl").first().Ritardo_Medio_Partenza == 6.0


def test_flag_that_is_no_whole_number(spark):
    flights = spark.createDataFrame(
        [(1, "AA", "JFK", "LAX", 4.0, 2.0, flag) for flag in (float("nan"), float("inf"), 1.9, 0.5, 2.0)],
        "month int, op_unique_carrier string, origin string, dest string, "
        "dep_delay double, arr_delay double, cancelled double",
    )
    (row,) = route_preset(flights, "route_stats_arr").collect()
    assert (row.Voli, row.Medio, row.Cancellazioni) == (3, 2.0, 0.3333)


def test_null_keys_belong_to_no_group(spark, flights):
    nulls = flights.limit(5).withColumns({key: F.lit(None).cast("string") for key in PAIR_KEYS})
    for name in RANKING_PRESETS:
        assert rows(ranking_preset(flights.unionAll(nulls), name), RANKING_REPORT) == rows(
            ranking_preset(flights, name), RANKING_REPORT
        )
