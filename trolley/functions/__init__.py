"""Column functions: wire format, message ids."""

from trolley.functions.ids import record_id
from trolley.functions.wire import (
    WIRE_TIMESTAMP,
    compact_line,
    is_object,
    is_one_json,
    record_json,
    wire_timestamp,
)

__all__ = [
    "WIRE_TIMESTAMP",
    "compact_line",
    "is_object",
    "is_one_json",
    "record_id",
    "record_json",
    "wire_timestamp",
]
