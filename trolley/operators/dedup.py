"""Distinct rows, replays and first-seen rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Order of arrival, the tie-breaker between two records of one user.
ARRIVAL = ("ingest_ts", "ingest_topic", "ingest_partition", "ingest_offset", "ingest_item")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct.

    On a batch this is a partial and a final hash aggregate around one exchange, so copies
    of a hot row already collapse before the shuffle. On a stream it is exact for the life
    of the query and its state grows with the number of distinct rows; see ``recent_keys``
    for a bounded form.
    """
    return df.distinct()


def drop_replays(df: DataFrame, id_column: str) -> DataFrame:
    """One row per id. Rows sharing an id are copies of one message, so any of them will do."""
    return df.dropDuplicates([id_column])


def earliest_per_key(
    df: DataFrame, key: str, order: Sequence[str] = ARRIVAL, *, keep_order: bool = False
) -> DataFrame:
    """The first row of every key by ``order``; batch only.

    Spark plans ``row_number = 1`` with a group limit below the exchange: each task ships at
    most one row per key, however many rows the key has. The result stays partitioned and
    sorted by ``key``, which a following join on it reuses.
    """
    first = Window.partitionBy(key).orderBy(*order)
    picked = df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
    return picked if keep_order else picked.drop(*order)


def recent_keys(
    stream: DataFrame, key: str | Sequence[str], delay: str, *, clock: str | None = None
) -> DataFrame:
    """Streaming dedup whose state is bounded: a key is forgotten ``delay`` after it was seen.

    By default the watermark follows the time of the micro-batch. Its rows are never behind
    that watermark, so nothing is dropped as late. With ``clock`` (a timestamp column such as
    ``ingest_ts``) Spark drops rows more than ``delay`` behind the newest one; only choose it
    when ``delay`` exceeds the lag between partitions. A key that returns later passes again,
    hence exactness over all history takes ``new_rows`` behind this.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if clock is not None:
        return stream.withWatermark(clock, delay).dropDuplicatesWithinWatermark(keys)
    arriving = stream.withColumn("_arrived_at", F.current_timestamp())
    return (
        arriving.withWatermark("_arrived_at", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_arrived_at")
    )


def earliest_in_interval(
    stream: DataFrame,
    keys: Sequence[str],
    interval: str,
    order: Sequence[str] = ARRIVAL,
    *,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Streaming: of every key the earliest row by ``order`` of the batch in which the key, or a
    still earlier row of it, first arrives within an interval; for output mode ``update``.

    Intervals follow the time of the micro-batch, so no row is late, and are forgotten when they
    end. The minimum is taken before the exchange as well: a hot key ships one row per task.
    A key returns once per interval, hence exactness over all history takes ``new_rows``
    behind this. ``kept`` is a stream of rows that another query remembered, with the
    ``_arrived_at`` they had there: they are remembered, and not returned again.
    """
    columns = stream.columns
    arriving = stream.withColumn("_arrived_at", F.current_timestamp())
    if kept is not None:
        arriving = arriving.unionByName(kept.select(*arriving.columns))
    earliest = (
        arriving.withWatermark("_arrived_at", interval)
        .groupBy(F.window("_arrived_at", interval), *keys)
        .agg(F.min_by(F.struct("_arrived_at", *columns), F.struct(*order)).alias("_row"))
    )
    return earliest.where(F.col("_row._arrived_at") == F.current_timestamp()).select(
        *(F.col(f"_row.{name}").alias(name) for name in columns)
    )
