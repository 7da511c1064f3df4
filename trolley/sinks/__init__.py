"""Where curated rows are written to."""

from trolley.sinks.compaction import LandedFiles
from trolley.sinks.coverage import OffsetCoverage
from trolley.sinks.files import Commits
from trolley.sinks.kafka import publish, to_messages
from trolley.sinks.keyed import KeyedTable
from trolley.sinks.ledger import LedgerTable
from trolley.sinks.publication import Publication
from trolley.sinks.tables import BatchFolders, JdbcTable, ParquetTable, Table, write_bucketed

__all__ = [
    "BatchFolders",
    "Commits",
    "JdbcTable",
    "KeyedTable",
    "LandedFiles",
    "LedgerTable",
    "OffsetCoverage",
    "ParquetTable",
    "Publication",
    "Table",
    "publish",
    "to_messages",
    "write_bucketed",
]
