"""Structured Streaming jobs over a stream of messages."""

from trolley.streaming.fanout import Targets, fan_out
from trolley.streaming.jobs import (
    EVERY_20_SECONDS,
    await_query,
    backfill,
    start_all,
    start_curation,
    start_facts,
    start_users,
)
from trolley.streaming.landing import land_json, land_parquet, land_rejects, land_variant
from trolley.streaming.state import (
    committed_offsets,
    export_state,
    overdue,
    remembered,
    state_rows,
    state_sizes,
)

__all__ = [
    "EVERY_20_SECONDS",
    "Targets",
    "await_query",
    "backfill",
    "committed_offsets",
    "export_state",
    "fan_out",
    "land_json",
    "land_parquet",
    "land_rejects",
    "land_variant",
    "overdue",
    "remembered",
    "start_all",
    "start_curation",
    "start_facts",
    "start_users",
    "state_rows",
    "state_sizes",
]
