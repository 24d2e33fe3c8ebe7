"""DataFrame-to-DataFrame steps; use them with ``DataFrame.transform``."""

from .aggregates import (
    airport_means,
    join_route_blocks,
    merge_route_blocks,
    operated_airport_means,
    pair_sums,
    route_blocks,
    route_sums,
)
from .cleaning import (
    STRICT,
    Fields,
    clean,
    dedupe_rows,
    drop_malformed,
    filter_blank_keys,
    filter_contains_ci,
    filter_embedded_header,
    filter_not_null,
    filter_operated,
    project_flights,
)
from .distinct import distinct_by_digest
from .lookup import join_airport_mean
from .nesting import nest, unnest
from .ranking import dense_position, sequence_position, with_airport_sums
from .rejects import reject_reason, reject_reasons

__all__ = [
    "STRICT",
    "Fields",
    "airport_means",
    "clean",
    "dedupe_rows",
    "dense_position",
    "distinct_by_digest",
    "drop_malformed",
    "filter_blank_keys",
    "filter_contains_ci",
    "filter_embedded_header",
    "filter_not_null",
    "filter_operated",
    "join_airport_mean",
    "join_route_blocks",
    "merge_route_blocks",
    "nest",
    "operated_airport_means",
    "pair_sums",
    "project_flights",
    "reject_reason",
    "reject_reasons",
    "route_blocks",
    "route_sums",
    "sequence_position",
    "unnest",
    "with_airport_sums",
]
