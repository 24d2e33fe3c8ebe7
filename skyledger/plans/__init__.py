"""The analyses: route statistics and carrier rankings, in all their variants."""

from .carrier_ranking import RANKING_PRESETS, RankingRules, carrier_ranking, ranking_preset
from .jobs import JOBS, merge_job, read_for, run_job, state_job
from .route_state import merge_batch, read_state, state_report
from .route_stats import ROUTE_PRESETS, RouteRules, route_preset, route_stats
from .shared_scan import SHARED, run_jobs, shared_reports, shared_state

__all__ = [
    "JOBS",
    "RANKING_PRESETS",
    "ROUTE_PRESETS",
    "RankingRules",
    "RouteRules",
    "SHARED",
    "carrier_ranking",
    "merge_batch",
    "merge_job",
    "ranking_preset",
    "read_for",
    "read_state",
    "route_preset",
    "route_stats",
    "run_job",
    "run_jobs",
    "shared_reports",
    "shared_state",
    "state_job",
    "state_report",
]
