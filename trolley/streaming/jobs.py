"""The curation jobs: new users, facts, or all tables at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trolley.functions import record_id
from trolley.operators.decode import decode
from trolley.operators.dedup import earliest_in_interval
from trolley.schemas import CURATED_PAYLOAD, FACTS_PAYLOAD, USERS_PAYLOAD
from trolley.session import state_partitions
from trolley.sinks.coverage import OffsetCoverage
from trolley.sinks.publication import Publication
from trolley.sinks.tables import Table
from trolley.streaming.fanout import Targets, fan_out

# Arguments of ``trigger``. None starts a batch as soon as the one before it is done.
Trigger = Mapping[str, object] | None
EVERY_20_SECONDS: Trigger = {"processingTime": "20 seconds"}


def start_curation(
    messages: DataFrame,
    targets: Targets,
    checkpoint: str,
    *,
    payload: T.StructType = CURATED_PAYLOAD,
    trigger: Trigger = None,
    batched: bool = False,
    remember_users: str | None = None,
    n_state_partitions: int | None = None,
    kept_state: str | None = None,
    name: str | None = None,
    **fan_out_options,
) -> StreamingQuery:
    """Start filling ``targets`` from a stream of messages.

    ``checkpoint`` holds the progress of the query and belongs on storage that outlives it.
    ``remember_users`` (an interval, for jobs that fill ``users`` only) lets the query drop
    users seen in the current interval before they reach a batch. Of several records of a user
    the earliest stays, and a task ships one per user at most, however hot the user is. Its
    state has one partition per core unless ``n_state_partitions`` says otherwise, from the
    first run on; say so where executors come and go. ``kept_state`` is a folder with the state
    of an earlier query (see ``trolley.streaming.state``), to be read before anything else.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    decoded = decode(messages, payload, batched=batched)
    if remember_users is not None:
        if targets.interactions is not None or targets.feedback is not None:
            raise ValueError("remember_users would drop facts of users seen before")
        if targets.coverage is not None:
            raise ValueError("remember_users drops messages before their offsets are counted")
        # Rejected records have no user; they are told apart by their own id.
        rejected_id = F.when(F.col("reject_reason").isNotNull(), record_id("quarantine"))
        decoded = decoded.withColumn("_rejected", rejected_id)
        kept = None
        if kept_state is not None:
            arrived = T.StructField("_arrived_at", T.TimestampType())
            layout = T.StructType([*decoded.schema.fields, arrived])
            kept = messages.sparkSession.readStream.schema(layout).parquet(kept_state)
        keys = ["user_id", "_rejected"]
        decoded = earliest_in_interval(decoded, keys, remember_users, kept=kept).drop("_rejected")
    elif kept_state is not None:
        raise ValueError("kept_state is that of a query with remember_users")

    targets.create(messages.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        if remember_users is not None:  # a stateful query switches it off for its callback too
            batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        fan_out(batch, batch_id, targets, **fan_out_options)

    mode = "append" if remember_users is None else "update"
    writer = decoded.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    writer = writer.foreachBatch(write)
    if remember_users is None:
        return writer.start()
    with state_partitions(messages.sparkSession, n_state_partitions):
        return writer.start()


def backfill(
    messages: DataFrame,
    targets: Targets,
    *,
    payload: T.StructType = CURATED_PAYLOAD,
    batched: bool = False,
    batch_id: int = 0,
    **fan_out_options,
) -> dict[str, int]:
    """Curate a bounded frame of messages in one go and return the rows each table got.

    Tables may already hold part of it. For more than fits the memory of the cluster give
    ``staging``, or drain a stream with ``availableNow``, which works in batches.
    """
    targets.create(messages.sparkSession)
    decoded = decode(messages, payload, batched=batched)
    return fan_out(decoded, batch_id, targets, **fan_out_options)


def start_users(
    messages: DataFrame,
    users: Table,
    checkpoint: str,
    *,
    quarantine: Table | None = None,
    partial: Table | None = None,
    metrics: Table | None = None,
    coverage: OffsetCoverage | None = None,
    publication: Publication | None = None,
    trigger: Trigger = EVERY_20_SECONDS,
    **options,
) -> StreamingQuery:
    """One row per user not stored yet, the earliest one received.

    Keep a single query writing to ``users``: two of them can miss each other's rows.
    """
    targets = Targets(
        users=users,
        quarantine=quarantine,
        metrics=metrics,
        partial=partial,
        coverage=coverage,
        publication=publication,
    )
    return start_curation(
        messages, targets, checkpoint, payload=USERS_PAYLOAD, trigger=trigger, **options
    )


def start_facts(
    messages: DataFrame,
    interactions: Table | None,
    feedback: Table | None,
    checkpoint: str,
    *,
    quarantine: Table | None = None,
    partial: Table | None = None,
    metrics: Table | None = None,
    coverage: OffsetCoverage | None = None,
    publication: Publication | None = None,
    trigger: Trigger = EVERY_20_SECONDS,
    **options,
) -> StreamingQuery:
    """Interactions and feedback."""
    targets = Targets(
        interactions=interactions,
        feedback=feedback,
        quarantine=quarantine,
        metrics=metrics,
        partial=partial,
        coverage=coverage,
        publication=publication,
    )
    return start_curation(
        messages, targets, checkpoint, payload=FACTS_PAYLOAD, trigger=trigger, **options
    )


def start_all(
    messages: DataFrame,
    users: Table,
    interactions: Table,
    feedback: Table,
    checkpoint: str,
    *,
    quarantine: Table | None = None,
    partial: Table | None = None,
    metrics: Table | None = None,
    coverage: OffsetCoverage | None = None,
    publication: Publication | None = None,
    trigger: Trigger = None,
    **options,
) -> StreamingQuery:
    """Users, interactions and feedback from one pass over the messages."""
    targets = Targets(users, interactions, feedback, quarantine, metrics, partial, coverage, publication)
    return start_curation(messages, targets, checkpoint, trigger=trigger, **options)


def await_query(query: StreamingQuery) -> None:
    """Wait until the query ends; an interrupt stops it, an error of the query is raised."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()
