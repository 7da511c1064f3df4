"""DataFrame -> DataFrame steps; all but the batch-only ones also take streaming frames."""

from trolley.operators.curate import feedback, interactions, users
from trolley.operators.decode import accepted, decode, drop_empty, partials, rejected
from trolley.operators.dedup import (
    distinct_rows,
    drop_replays,
    earliest_per_key,
    recent_keys,
)
from trolley.operators.keys import broadcast_if_small, new_rows
from trolley.operators.quality import (
    activity_rules,
    missing_reference_counts,
    missing_references,
    rule_violations,
)
from trolley.operators.sample import bottom_k, count_rows, sample_rows

__all__ = [
    "accepted",
    "activity_rules",
    "bottom_k",
    "broadcast_if_small",
    "count_rows",
    "decode",
    "distinct_rows",
    "drop_empty",
    "drop_replays",
    "earliest_per_key",
    "feedback",
    "interactions",
    "missing_reference_counts",
    "missing_references",
    "new_rows",
    "partials",
    "recent_keys",
    "rejected",
    "rule_violations",
    "sample_rows",
    "users",
]
