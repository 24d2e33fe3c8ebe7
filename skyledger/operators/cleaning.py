"""Projections and filters that turn raw text rows into typed flights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_filled, is_missing, strip, try_number
from ..schema import FLIGHT_FIELDS, ROUTE_KEYS

# Fixed value: what stands in the carrier column of a header line.
HEADER_CARRIER = "op_unique_carrier"
DELAYS = ("dep_delay", "arr_delay")


def project_flights(df: DataFrame) -> DataFrame:
    """The five columns that the ranking reads, under short names."""
    return df.select(
        "origin", F.col("op_unique_carrier").alias("carrier"), "dep_delay", "arr_delay", "cancelled"
    )


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def filter_blank_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which every column holds more than white space."""
    return df.where(reduce(and_, (is_filled(F.col(c)) for c in columns)))


def filter_embedded_header(df: DataFrame) -> DataFrame:
    """Drop header lines repeated among the data; a NULL carrier is dropped as well."""
    return df.where(F.col("op_unique_carrier") != HEADER_CARRIER)


def filter_contains_ci(df: DataFrame, needles: dict[str, str]) -> DataFrame:
    """Drop rows in which some column contains its needle, whatever the case."""
    hits = (F.coalesce(F.lower(F.col(c)).contains(n.lower()), F.lit(False)) for c, n in needles.items())
    return df.where(~reduce(or_, hits))


def filter_operated(df: DataFrame) -> DataFrame:
    return df.where(F.col("cancelled") == 0)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows, over all columns.

    Equal rows meet in the map-side half of the aggregation, so a row copied very often
    reaches its reducer once per task, not once per copy.
    """
    return df.dropDuplicates()


@dataclass(frozen=True)
class Fields:
    """The fields of a flight that a report reads, and what it does with a bad one.

    keys       must hold more than white space
    month      "required" (a number), "optional" (a number or missing) or "unread"
    flag       what a missing cancellation flag means: "required" drops the flight, "zero" makes it an
               operated one, "null" counts the flight but neither its delays nor its flag
    delays     the delays read; each must be a number or missing
    cancelled_delays  whether the delays of cancelled flights are read too
    whole_flag a flight is cancelled if its flag, as a whole number, is 1; else if it isn't 0
    """

    keys: tuple[str, ...] = ROUTE_KEYS
    month: str = "required"
    flag: str = "required"
    delays: tuple[str, ...] = DELAYS
    cancelled_delays: bool = True
    whole_flag: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        """The columns read, in the order of the flight schema."""
        read = {*self.keys, *self.delays, "cancelled"} | ({"month"} if self.month != "unread" else set())
        return tuple(name for name, _, _ in FLIGHT_FIELDS if name in read)


#: Every field is read, and only delays may be missing.
STRICT = Fields()


def _number(name: str, kind: str) -> Column:
    return try_number(F.col(name), kind)


def number_tests(fields: Fields) -> dict[str, Column]:
    """For each number among ``fields``, whether it is good enough for the report: a number, missing where it may be, or not read."""
    flag = _number("cancelled", "double")
    tests = {"cancelled": flag.isNotNull() if fields.flag == "required" else flag.isNotNull() | is_missing(F.col("cancelled"))}
    if fields.month != "unread":
        month = _number("month", "int").isNotNull()
        tests["month"] = month if fields.month == "required" else month | is_missing(F.col("month"))
    unused = F.lit(False)
    if not fields.cancelled_delays:
        unused = flag.cast("int") == 1 if fields.whole_flag else flag != 0
        unused = F.coalesce(unused, F.lit(fields.flag == "null"))
    return tests | {c: _number(c, "double").isNotNull() | is_missing(F.col(c)) | unused for c in fields.delays}


def _numbers_fine(fields: Fields) -> Column:
    return reduce(and_, number_tests(fields).values())


def typed_fields(fields: Fields) -> dict[str, Column]:
    """The columns read, as numbers and stripped keys."""
    return {
        name: strip(F.col(name)) if kind == "string" else _number(name, kind)
        for name, _, kind in FLIGHT_FIELDS
        if name in fields.columns
    }


def drop_malformed(df: DataFrame, fields: Fields = STRICT) -> DataFrame:
    """Typed flights from text columns, without the rows that have a bad field among ``fields``.

    A bad field is one that is neither a number nor missing (empty or ``None``), or is missing where
    it is required; a line cut off before the flag therefore goes where a flag is required. Fields that the
    report doesn't read are not looked at; columns that are no flight columns pass through unchanged.
    """
    return df.where(_numbers_fine(fields)).withColumns(typed_fields(fields))


def keys_fine(keys: Sequence[str]) -> Column:
    """Keys that are filled and don't hold their own column's name, as a header line's do."""
    return reduce(and_, (F.coalesce(is_filled(F.col(c)) & (strip(F.col(c)) != c), F.lit(False)) for c in keys))


def clean(df: DataFrame, fields: Fields = STRICT, airport: Fields | None = None) -> DataFrame:
    """Typed flights with usable keys: no header lines, malformed rows or blank keys.

    With ``airport``, the rows that are good by those fields stay, and the column ``counted``
    tells which are good by ``fields``: a carrier's numbers may need more fields than
    its airport's mean does.
    """
    read = airport or fields
    typed = typed_fields(fields)
    if airport:
        typed |= {"counted": keys_fine(fields.keys) & _numbers_fine(fields)}
    return df.where(keys_fine(read.keys) & _numbers_fine(read)).withColumns(typed)
