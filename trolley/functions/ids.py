"""Row ids derived from where a record was read, not from when or by whom."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_id(kind: str) -> Column:
    """``md5(topic|partition|offset[|item]|kind)`` over a decoded record.

    The same message gives the same id in every run, so a replay can be recognised, and two
    messages never share one. ``concat_ws`` leaves the item out where it is null; topic names
    cannot contain ``|``.
    """
    return F.md5(
        F.concat_ws(
            "|",
            F.col("ingest_topic"),
            F.col("ingest_partition").cast("string"),
            F.col("ingest_offset").cast("string"),
            F.col("ingest_item").cast("string"),
            F.lit(kind),
        )
    )
