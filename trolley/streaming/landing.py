"""Messages -> files, as they are or with the fixed schema."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trolley.functions import WIRE_TIMESTAMP, compact_line, is_object, is_one_json
from trolley.operators.decode import decode, rejected, unreadable
from trolley.operators.drift import record
from trolley.schemas import ACTIVITY
from trolley.streaming.jobs import Trigger


def _is_record() -> Column:
    """Any JSON object; landing does not ask for a key."""
    keyless_object = (F.col("reject_reason") == "no key") & is_object(F.col("raw_value"))
    return F.col("reject_reason").isNull() | F.coalesce(keyless_object, F.lit(False))


def _start(
    rows: DataFrame, kind: str, path: str, checkpoint: str, trigger: Trigger, by: list[str], **options
) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    writer = rows.writeStream.format(kind).outputMode("append").options(**options)
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    if by:
        writer = writer.partitionBy(*by)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def landed(messages: DataFrame, *, batched: bool = False, by_day: bool = False) -> DataFrame:
    """All fields of every record that is a JSON object."""
    records = decode(messages, batched=batched).where(_is_record())
    day = [F.to_date("ingest_ts").alias("ingest_day")] if by_day else []
    return records.select(*ACTIVITY.fieldNames(), *day)


def land_parquet(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: Trigger = None,
    batched: bool = False,
    by_day: bool = False,
) -> StreamingQuery:
    """Records as Parquet, optionally in a folder per day received."""
    rows = landed(messages, batched=batched, by_day=by_day)
    by = ["ingest_day"] if by_day else []
    return _start(rows, "parquet", path, checkpoint, trigger, by)


def land_json(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: Trigger = None,
    keep: Literal["payload", "fields"] = "payload",
    batched: bool = False,
    compression: str = "none",
) -> StreamingQuery:
    """JSON lines: the ``payload`` as sent, unknown keys included, or the known ``fields``.

    Every line repeats the names of its fields, which ``compression="gzip"`` takes off the disk;
    such a file is read back by one task.
    """
    if keep == "fields":
        rows = landed(messages, batched=batched)
        options = {
            "timestampFormat": WIRE_TIMESTAMP,
            "timeZone": "UTC",
            "ignoreNullFields": "false",
            "compression": compression,
        }
        return _start(rows, "json", path, checkpoint, trigger, [], **options)
    lines = messages.where(_is_payload()).select(compact_line(_text()).alias("value"))
    return _start(lines, "text", path, checkpoint, trigger, [], compression=compression)


def land_variant(
    messages: DataFrame, path: str, checkpoint: str, *, trigger: Trigger = None
) -> StreamingQuery:
    """Whatever is JSON as a variant, ``record``, with the offset: unknown keys and the types that
    values were sent with survive (see ``trolley.operators.drift``)."""
    rows = messages.where(_is_payload()).select(
        F.col("topic").alias("ingest_topic"),
        F.col("partition").alias("ingest_partition"),
        F.col("offset").alias("ingest_offset"),
        F.col("timestamp").alias("ingest_ts"),
        record(_text()).alias("record"),
    )
    return _start(rows, "parquet", path, checkpoint, trigger, [])


def _text() -> Column:
    return F.col("value").cast("string")


def _is_payload() -> Column:
    """One JSON value of any type in valid UTF-8."""
    return F.coalesce(F.is_valid_utf8(_text()), F.lit(False)) & is_one_json(_text())


def land_rejects(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: Trigger = None,
    keep: Literal["payload", "fields"] = "fields",
    batched: bool = False,
) -> StreamingQuery:
    """What landing with the same ``keep`` leaves out, with the reason, as quarantine rows."""
    if keep == "payload":
        rows = rejected(unreadable(messages.where(~_is_payload())))
    else:
        rows = rejected(decode(messages, batched=batched).where(~_is_record()))
    return _start(rows, "parquet", path, checkpoint, trigger, [])
