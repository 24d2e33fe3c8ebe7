"""Report lines and writers."""

from .lines import ranking_lines, route_json_lines, route_lines
from .staged import staged_replace
from .writers import preview, write_airport_means, write_csv, write_json, write_parquet, write_text

__all__ = [
    "preview",
    "ranking_lines",
    "route_json_lines",
    "route_lines",
    "staged_replace",
    "write_airport_means",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_text",
]
