"""Where messages and stored tables are read from."""

from trolley.sources.jdbc import Jdbc, column_bounds, even_starts, key_ranges, read_query, read_table
from trolley.sources.messages import KafkaTopic, message_files, read_topic, stream_topic

__all__ = [
    "Jdbc",
    "KafkaTopic",
    "column_bounds",
    "even_starts",
    "key_ranges",
    "message_files",
    "read_query",
    "read_table",
    "read_topic",
    "stream_topic",
]
