"""Route statistics kept as a table that batches of flights are merged into.

Each batch is reduced to one row per route and month block, in which every measure adds up, and lies in a folder of its own:
``<state>/delay=<column>/whole_flag=<bool>/batch=<name>``. A batch that comes again takes the place of its former rows and of
nothing else, whole or not at all. A report reads a few rows per route and batch instead of all flights; what is not in a
batch is never read again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators import join_route_blocks, merge_route_blocks, route_blocks
from ..schema import ROUTE_KEYS
from ..sinks import write_parquet
from .route_stats import RouteRules, measured, route_report

BATCH_NAME = re.compile(r"[A-Za-z0-9_.-]+")
BLOCKS = ", ".join(
    [
        *(f"{key} string" for key in ROUTE_KEYS),
        "block int, flights bigint, delay_min double, delay_max double, delay_sum double, delay_flights bigint",
        "cancelled_sum double, cancelled_known bigint, bits bigint",
    ]
)


def _place(state: str, rules: RouteRules) -> str:
    """Presets that measure alike share their rows; what they differ in is the report."""
    return f"{state.rstrip('/')}/delay={rules.delay}/whole_flag={str(rules.whole_flag).lower()}"


def merge_batch(flights: DataFrame, rules: RouteRules, state: str, batch: str) -> None:
    """Put the flights of one batch into the state, in the place of the batch's former flights if it had any.

    An empty batch leaves no rows. Batches must not share flights: a flight that two batches hold counts twice.
    """
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits and _ . - only, not {batch!r}")
    blocks = route_blocks(*measured(flights, rules))
    blocks = blocks.withColumn("cancelled_sum", blocks["cancelled_sum"].cast("double"))
    write_parquet(blocks, f"{_place(state, rules)}/batch={batch}")


def read_state(spark: SparkSession, rules: RouteRules, state: str) -> DataFrame:
    """All batches' rows, with the column ``batch``."""
    return spark.read.schema(f"{BLOCKS}, batch string").parquet(_place(state, rules))


def state_report(spark: SparkSession, rules: RouteRules, state: str) -> DataFrame:
    """The report over all batches, as ``route_stats`` over all their flights gives it."""
    return route_report(join_route_blocks(merge_route_blocks(read_state(spark, rules, state))), rules)
