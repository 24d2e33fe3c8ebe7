"""One text line per report row. The layouts are fixed: tab after the key, then ``;``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import number_text
from ..schema import NULL_TEXT, RANKING_REPORT, ROUTE_REPORT


def _number(name: str) -> Column:
    return F.coalesce(number_text(F.col(name)), F.lit(NULL_TEXT))


def _lines(report: DataFrame, key: str, rest: Column) -> DataFrame:
    return report.select(F.concat(F.col(key), F.lit("\t"), rest).alias("value"))


def ranking_lines(ranking: DataFrame) -> DataFrame:
    """``airport TAB position;carrier;flights;departure;arrival;rate;difference``."""
    airport, position, carrier, flights, *numbers = RANKING_REPORT
    return _lines(ranking, airport, F.concat_ws(";", position, carrier, flights, *map(_number, numbers)))


def route_lines(stats: DataFrame) -> DataFrame:
    """``carrier TAB route;flights;min;max;mean;rate;[months]``, from months as an int array."""
    carrier, route, flights, *numbers, months = ROUTE_REPORT
    listed = F.concat(F.lit("["), F.array_join(F.col(months).cast("array<string>"), ","), F.lit("]"))
    return _lines(stats, carrier, F.concat_ws(";", route, flights, *map(_number, numbers), listed))


def route_json_lines(stats: DataFrame) -> DataFrame:
    """``carrier TAB {json}``; a missing number is JSON null."""
    carrier, *fields = ROUTE_REPORT
    return _lines(stats, carrier, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
