"""The analyses against plain Python over random flights with every kind of gap."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from skyledger import RANKING_PRESETS, ROUTE_PRESETS, ranking_preset, route_preset

FLIGHT = (
    "month int, op_unique_carrier string, origin string, dest string, "
    "dep_delay double, arr_delay double, cancelled double"
)


def half_up(value, digits):
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0


def half_even(value, digits):
    return round(value, digits) + 0.0


def mean(values):
    return sum(values) / len(values) if values else None


def maybe(function, value, *rest):
    return None if value is None else function(value, *rest)


@pytest.fixture(scope="module")
def flights():
    generator = random.Random(20)
    rows = [
        (
            generator.randint(1, 12),
            generator.choice("ABCDE"),
            generator.choice(["JFK", "LAX", "BOS"]),
            generator.choice(["JFK", "SFO"]),
            generator.choice([None, *map(float, range(-8, 9))]),
            generator.choice([None, *map(float, range(-8, 9))]),
            generator.choice([0.0, 0.0, 0.0, 1.0, None]),
        )
        for _ in range(1500)
    ]
    return rows + rows[:200] + [(3, "Z", "LAX", "SFO", 4.0, None, 1.0), (3, "Z", "SFO", "SFO", None, None, 1.0)]


@pytest.fixture(scope="module")
def table(spark, flights):
    return spark.createDataFrame(flights, FLIGHT).repartition(7).cache()


def expected_routes(flights, name):
    rules = ROUTE_PRESETS[name]
    groups = defaultdict(list)
    for month, carrier, origin, dest, dep, arr, flag in flights:
        if name != "route_stats_arr" or flag is not None:
            groups[carrier, f"{origin} -> {dest}"].append((month, arr if name == "route_stats_arr" else dep, flag))
    rounded = half_even if name == "route_stats_arr" else half_up
    result = set()
    for (carrier, route), rows in groups.items():
        delays = [delay for _, delay, flag in rows if flag == 0 and delay is not None]
        shown = [min(delays, default=None), max(delays, default=None), maybe(rounded, mean(delays), 2)]
        if rules.missing is not None:
            shown = [rules.missing if v is None else v for v in shown]
        rate = maybe(rounded, mean([flag for _, _, flag in rows if flag is not None]), 4)
        months = {month for month, _, _ in rows}
        listed = ",".join(sorted(map(str, months))) if rules.text_months else tuple(sorted(months))
        result.add((carrier, route, len(rows), *shown, rate, listed))
    return result


@pytest.mark.parametrize("name", ROUTE_PRESETS)
def test_route_stats(table, flights, name):
    got = {tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in route_preset(table, name).collect()}
    assert got == expected_routes(flights, name)


def expected_ranking(flights, name):
    if name == "ranking_zero_dedupe":
        flights = set(flights)
    zero = name != "ranking_sql"
    airports = defaultdict(lambda: defaultdict(list))
    for _, carrier, origin, _, dep, arr, flag in flights:
        airports[origin][carrier].append(tuple(v or 0.0 for v in (dep, arr, flag)) if zero else (dep, arr, flag))

    def quotient(values, count):
        return sum(values) / count if count > 0 else 0.0

    def numbers(rows):
        """Departure and arrival mean, and the sum and count that make the airport's mean."""
        operated = [row for row in rows if row[2] == 0]
        if name == "ranking_sql":
            deps, arrs = ([row[i] for row in operated if row[i] is not None] for i in (0, 1))
            return maybe(half_up, mean(deps), 2), maybe(half_up, mean(arrs), 2), sum(deps), len(deps)
        counted = operated if name == "ranking_zero_excl" else rows
        valid = len(rows) - sum(row[2] for row in rows)
        dep, arr = (half_even(quotient([row[i] for row in counted], valid), 2) for i in (0, 1))
        summed = counted if name == "ranking_zero_dedupe" else operated
        return dep, arr, sum(row[0] for row in summed), valid

    result = set()
    for airport, carriers in airports.items():
        found = {carrier: numbers(rows) for carrier, rows in carriers.items()}
        total, count = (sum(values[i] for values in found.values()) for i in (2, 3))
        average = total / count if count > 0 else (0.0 if zero else None)
        if name in ("ranking_zero_dedupe", "ranking_zero_excl"):
            average = half_even(average, 2)
        rounded = half_even if zero else half_up

        def place(carrier):
            return (found[carrier][0] is not None, found[carrier][0] or 0.0)

        order = sorted(found, key=lambda carrier: (place(carrier), carrier))
        ranks = sorted({place(carrier) for carrier in found})
        for position, carrier in enumerate(order, 1):
            dep, arr, _, _ = found[carrier]
            rows = carriers[carrier]
            flags = [row[2] for row in rows if row[2] is not None]
            difference = None if dep is None or average is None else rounded(dep - average, 2)
            rank = ranks.index(place(carrier)) + 1 if name == "ranking_sql" else position
            result.add((airport, rank, carrier, len(rows), dep, arr, maybe(rounded, mean(flags), 4), difference))
    return result


@pytest.mark.parametrize("name", RANKING_PRESETS)
def test_ranking(table, flights, name):
    assert {tuple(row) for row in ranking_preset(table, name).collect()} == expected_ranking(flights, name)
