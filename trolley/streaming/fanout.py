"""One micro-batch of decoded records -> the curated tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trolley.operators.curate import Clock, feedback, interactions, users
from trolley.operators.decode import accepted, partials, rejected
from trolley.operators.dedup import ARRIVAL, drop_replays, earliest_per_key
from trolley.operators.keys import BROADCAST_BYTES, key_bytes, measured_bytes, new_rows
from trolley.operators.sample import sample_rows
from trolley.schemas import METRICS
from trolley.sinks.coverage import OffsetCoverage
from trolley.sinks.keyed import KeyedTable
from trolley.sinks.ledger import LedgerTable
from trolley.sinks.publication import Publication
from trolley.sinks.tables import BatchFolders, JdbcTable, Table

log = logging.getLogger(__name__)

# An md5 in hex and what a hash relation adds per entry.
_ID_BYTES = 32 + 64


@dataclass(frozen=True)
class Targets:
    """The tables a job fills; those left out are not computed.

    ``coverage`` keeps which offsets came, ``publication`` the last batch that is in all tables.
    """

    users: Table | None = None
    interactions: Table | None = None
    feedback: Table | None = None
    quarantine: Table | None = None
    metrics: Table | None = None
    partial: Table | None = None
    coverage: OffsetCoverage | None = None
    publication: Publication | None = None

    def __post_init__(self) -> None:
        if isinstance(self.users, BatchFolders) or isinstance(self.users, LedgerTable) and not self.users.lookup:
            raise ValueError("users are looked up over all batches; use a table to append to, or lookup=True")

    def names(self) -> list[str]:
        """The tables a batch is counted for, as named in the metrics."""
        tables = {
            "quarantine": self.quarantine,
            "users": self.users,
            "user_product_interactions": self.interactions,
            "user_feedback": self.feedback,
            "partial": self.partial,
        }
        return [name for name, table in tables.items() if table is not None]

    def create(self, spark: SparkSession) -> None:
        """Make every table that is not there yet."""
        for target in vars(self).values():
            if target is not None:
                target.create(spark)


def fan_out(
    decoded: DataFrame,
    batch_id: int,
    targets: Targets,
    *,
    clock: Clock = "event",
    repeats: bool = True,
    staging: str | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    samples: int = 0,
) -> dict[str, int]:
    """Write one batch and return the number of rows each table got.

    The batch is parsed once: it is persisted, or, with ``staging`` (a folder shared by all
    executors), written there and read back column by column, which suits batches beyond the
    memory of the cluster. Errors of a sink propagate, so the batch is not committed and runs
    again; ids do not depend on the run, so the tables that got it already do not change.

    The count of a table is what this attempt wrote. Metrics of an attempt that failed stay, under
    ``-(batch_id + 1)``, so that their sum is what the tables hold. Records that lost a field are
    accepted, and named with their text in ``targets.partial``.

    ``repeats=False`` promises that no offset occurs twice within the batch, as with Kafka
    itself, and saves facts a shuffle. ``samples`` rows per table are logged first.
    """
    counts: dict[str, int] = {}
    try:
        _fan_out(
            decoded, batch_id, targets, counts, clock=clock, repeats=repeats, staging=staging,
            max_broadcast_bytes=max_broadcast_bytes, samples=samples,
        )
    except Exception:
        if targets.metrics is not None and any(counts.values()):
            _keep_failed(decoded.sparkSession, targets.metrics, -(batch_id + 1), counts)
        raise
    if targets.metrics is not None and counts:
        measured = [(batch_id, name, n) for name, n in counts.items()]
        targets.metrics.write(decoded.sparkSession.createDataFrame(measured, METRICS), batch_id)
    if targets.publication is not None:
        targets.publication.mark(decoded.sparkSession, batch_id)
    return counts


def _keep_failed(spark: SparkSession, metrics: Table, failed_id: int, counts: dict[str, int]) -> None:
    """Add what a failed attempt has written to what attempts before it had."""
    total = dict(counts)
    if isinstance(metrics, BatchFolders):  # which overwrite what they hold for an id
        for row in metrics.read(spark).where(F.col("batch_id") == failed_id).collect():
            total[row.table_name] = total.get(row.table_name, 0) + row.n_rows
    measured = [(failed_id, name, n) for name, n in total.items()]
    metrics.write(spark.createDataFrame(measured, METRICS), failed_id)


def _fan_out(
    decoded: DataFrame,
    batch_id: int,
    targets: Targets,
    counts: dict[str, int],
    *,
    clock: Clock,
    repeats: bool,
    staging: str | None,
    max_broadcast_bytes: int,
    samples: int,
) -> None:
    with _held(decoded, staging, batch_id) as batch:
        received = F.to_date("ingest_ts")
        extent = batch.agg(
            F.count(F.lit(1)).alias("n"),
            F.count("reject_reason").alias("n_rejected"),
            F.count_if("partial").alias("n_partial"),
            F.array_sort(F.collect_set(received)).alias("days"),  # as many as the calendar has
            key_bytes("user_id").alias("user_bytes"),
        ).first()
        if extent.n == 0:
            log.info("batch %s is empty", batch_id)
            return
        days = tuple(extent.days) or None
        good = accepted(batch)
        n_good = extent.n - extent.n_rejected

        def store(
            name: str,
            target: Table,
            key: str,
            rows: DataFrame,
            *,
            once: Callable[[DataFrame], DataFrame],
            keys: DataFrame,
            n_bytes: int,
            keys_repeat: bool,
        ) -> None:
            """Write the rows of ``rows`` that are new, after ``once`` made them one per key."""
            stored = target.stored(batch.sparkSession, key, days)
            if stored is None:
                counts[name] = _write(once(rows), target, batch_id, samples)
            else:
                small = n_bytes <= max_broadcast_bytes
                if not small and keys_repeat:
                    keys = keys.select(key).distinct()
                    small = measured_bytes(keys) <= max_broadcast_bytes
                if small:
                    # Known rows leave without a shuffle, so the others go through ``once``.
                    fresh = once(
                        new_rows(
                            rows,
                            stored,
                            key,
                            strategy="semi_first",
                            keys=keys,
                            bytes_bound=max_broadcast_bytes,
                            max_broadcast_bytes=max_broadcast_bytes,
                        )
                    )
                else:
                    # ``once`` shuffles by key and evens out hot keys for the join behind it.
                    fresh = new_rows(once(rows), stored, key)
                counts[name] = _write_if_any(fresh, target, batch_id, samples)
            log.info("batch %s: %s rows into %s", batch_id, counts[name], name)

        def store_by_id(name: str, target: Table, key: str, rows: DataFrame, n: int) -> None:
            store(
                name,
                target,
                key,
                rows,
                once=lambda df: drop_replays(df, key) if repeats else df,
                keys=rows,
                n_bytes=n * _ID_BYTES,
                keys_repeat=False,
            )

        counts.update({name: 0 for name in targets.names()})
        if targets.quarantine is not None and extent.n_rejected > 0:
            store_by_id(
                "quarantine", targets.quarantine, "quarantine_id", rejected(batch), extent.n_rejected
            )
        if targets.partial is not None and extent.n_partial > 0:
            store_by_id("partial", targets.partial, "quarantine_id", partials(batch), extent.n_partial)
        if n_good > 0:
            if isinstance(targets.users, KeyedTable):
                counts["users"] = _improve(good, targets.users, batch_id, samples)
            elif targets.users is not None:
                store(
                    "users",
                    targets.users,
                    "user_id",
                    users(good, *ARRIVAL),
                    once=lambda df: earliest_per_key(df, "user_id"),
                    keys=good,
                    n_bytes=extent.user_bytes,
                    keys_repeat=True,
                )
            if targets.interactions is not None:
                facts = interactions(good, "ingest_ts", clock=clock)
                store_by_id(
                    "user_product_interactions",
                    targets.interactions,
                    "interaction_id",
                    facts,
                    n_good,
                )
            if targets.feedback is not None:
                facts = feedback(good, "ingest_ts", clock=clock)
                store_by_id("user_feedback", targets.feedback, "feedback_id", facts, n_good)
        if targets.coverage is not None:
            targets.coverage.add_decoded(batch, batch_id)


@contextmanager
def _held(decoded: DataFrame, staging: str | None, batch_id: int) -> Iterator[DataFrame]:
    if staging is None:
        batch = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield batch
        finally:
            batch.unpersist()
    else:
        # Two folders in turn, each overwritten by the batch after the next.
        folder = f"{staging}/turn={batch_id % 2}"
        decoded.write.mode("overwrite").parquet(folder)
        yield decoded.sparkSession.read.schema(decoded.schema).parquet(folder)


def _improve(good: DataFrame, target: KeyedTable, batch_id: int, samples: int) -> int:
    """Add the users of a batch that are new to ``target`` or earlier than what it has of them."""
    rows = target.improved(users(good, *target.order), keys=good)
    first = earliest_per_key(rows, target.key, target.order, keep_order=True)
    n = _write_if_any(first, target, batch_id, samples)
    if n and target.due(good.sparkSession):
        target.fold(good.sparkSession)
    return n


def _write_if_any(rows: DataFrame, target: Table, batch_id: int, samples: int) -> int:
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return 0 if rows.isEmpty() else _write(rows, target, batch_id, samples)
    finally:
        rows.unpersist()


def _write(rows: DataFrame, target: Table, batch_id: int, samples: int) -> int:
    """Write rows, of which there are some, and count them on the way."""
    if samples:
        for row in sample_rows(rows, samples).collect():
            log.info("sample %s", row)
    if isinstance(target, LedgerTable):
        return target.write(rows, batch_id)
    if isinstance(target, JdbcTable):  # whose writer does not report what it observes; rows are persisted
        n = rows.count()
        target.write(rows, batch_id)
        return n
    counted = Observation()
    target.write(rows.observe(counted, F.count(F.lit(1)).alias("n")), batch_id)
    return counted.get["n"]
