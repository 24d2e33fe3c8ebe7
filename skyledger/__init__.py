"""Route statistics and carrier rankings over flight records, on Spark DataFrames."""

from .plans import (
    JOBS,
    RANKING_PRESETS,
    ROUTE_PRESETS,
    RankingRules,
    RouteRules,
    carrier_ranking,
    ranking_preset,
    route_preset,
    route_stats,
    run_job,
)
from .session import build_session
from .sources import read_airport_means, read_flights

__all__ = [
    "JOBS",
    "RANKING_PRESETS",
    "ROUTE_PRESETS",
    "RankingRules",
    "RouteRules",
    "build_session",
    "carrier_ranking",
    "ranking_preset",
    "read_airport_means",
    "read_flights",
    "route_preset",
    "route_stats",
    "run_job",
]
