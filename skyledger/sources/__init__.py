"""Readers."""

from .accounted import Accounted, read_accounted
from .flights import DIALECT, read_flights, read_flights_text, resolve_columns
from .layouts import column_orders, file_heads
from .records import read_quoted_csv, read_records
from .side_table import read_airport_means
from .types import cast_inferred, infer_types, merge_types

__all__ = [
    "Accounted",
    "DIALECT",
    "cast_inferred",
    "column_orders",
    "file_heads",
    "infer_types",
    "merge_types",
    "read_accounted",
    "read_airport_means",
    "read_flights",
    "read_flights_text",
    "read_quoted_csv",
    "read_records",
    "resolve_columns",
]
