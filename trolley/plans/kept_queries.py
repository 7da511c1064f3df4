"""Queries over tables that are kept up to date: users by key, coverage of offsets, landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators import accepted, bottom_k, decode, earliest_per_key, users
from trolley.operators.dedup import ARRIVAL
from trolley.operators.drift import type_counts
from trolley.operators.sample import lot
from trolley.operators.sketches import DISTINCT_ERROR, RANK_ERROR, estimates, merged, sketched
from trolley.plans.batch_queries import _FIRST_USERS, _STORED, stored_users
from trolley.plans.inputs import TOPIC, envelope, events_of, field_sql, messages, table, zoneless
from trolley.plans.registry import Registry
from trolley.schemas import (
    ACTIVITY,
    COORDINATES,
    FACTS_PAYLOAD,
    FEEDBACK,
    INTERACTIONS,
    USERS,
    USERS_PAYLOAD,
    narrowed,
)
from trolley.session import scratch_dir
from trolley.sinks import BatchFolders, KeyedTable, LandedFiles, OffsetCoverage, ParquetTable, Publication
from trolley.sources import message_files
from trolley.streaming import (
    Targets,
    await_query,
    export_state,
    land_parquet,
    land_variant,
    start_curation,
    start_users,
    state_rows,
)

QUERIES = Registry()

_NEW_USERS = f"""
SELECT * FROM ({_FIRST_USERS}) AS f
WHERE NOT EXISTS (SELECT 1 FROM ({_STORED}) AS s WHERE s.user_id = f.user_id)"""


# --- users by key ---------------------------------------------------------------------------


def _known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users stored before: all they have is a key."""
    known = stored_users(spark, sf_dir)
    columns = [field for field in [*USERS.fields, *COORDINATES.fields] if field.name not in known.columns]
    return known.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in columns))


@QUERIES.add(_NEW_USERS)
def new_users_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that are not stored yet, by a table whose bitmaps say where one may be."""
    stored = KeyedTable(scratch_dir(spark, "keyed_users"), USERS, bucket_rows=256)
    stored.create(spark)
    stored.write(_known_users(spark, sf_dir))
    stored.fold(spark)
    records = accepted(decode(messages(spark, sf_dir, bounded=True), USERS_PAYLOAD))
    fresh = stored.unseen(users(records, *ARRIVAL), keys=_event_users(spark, sf_dir))
    return zoneless(earliest_per_key(fresh, "user_id"))


def _event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("user_id"))


@QUERIES.add(_FIRST_USERS)
def users_late_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in an order that has nothing to do with that of the messages: a record that comes
    late and is earlier than the stored one replaces it, before a fold and after it."""
    stored = KeyedTable(scratch_dir(spark, "late_users"), USERS, bucket_rows=256)
    stored.create(spark)
    for batch in range(4):
        part = f"pmod(xxhash64(event_id), 4) = {batch}"
        mine = messages(spark, sf_dir, *USERS_PAYLOAD.fieldNames(), where=part, bounded=True)
        rows = users(accepted(decode(mine, USERS_PAYLOAD)), *ARRIVAL)
        stored.write(earliest_per_key(stored.improved(rows), "user_id", keep_order=True), batch)
        if batch % 2:
            stored.fold(spark)
    return zoneless(stored.read(spark))


# --- offsets --------------------------------------------------------------------------------

# Two partitions lose a span of every thousand offsets; some offsets come with another batch again,
# some twice in one batch.
_KEPT = "(event_id % 3 = 1 OR event_id // 3 % 1000 NOT BETWEEN 100 AND 137)"
_AGAIN, _TWICE = "event_id // 3 % 700 < 5", "event_id // 3 % 901 = 0"


def _coverage(spark: SparkSession, sf_dir: str) -> OffsetCoverage:
    """Offsets as three batches bring them, each with some of all offsets."""

    def spark_sql(condition: str) -> str:
        return condition.replace("//", "div")

    events = table(spark, sf_dir, "events").where(spark_sql(_KEPT))
    at = F.expr("pmod(xxhash64(event_id), 3)")
    rows = events.select("event_id", at.alias("batch"))
    rows = rows.unionByName(events.where(spark_sql(_AGAIN)).select("event_id", ((at + 1) % 3).alias("batch")))
    rows = rows.unionByName(events.where(spark_sql(_TWICE)).select("event_id", at.alias("batch")))
    offsets = rows.select(
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        "batch",
    )
    coverage = OffsetCoverage(scratch_dir(spark, "coverage"))
    for batch in (0, 1, 2, 2):  # the last one runs again
        coverage.add(offsets.where(F.col("batch") == batch), batch)
    return coverage


_READ = f"SELECT event_id % 3 AS p, event_id // 3 AS o, event_id FROM events WHERE {_KEPT}"


@QUERIES.add(
    f"""
SELECT '{TOPIC}' AS topic, CAST(p AS INTEGER) AS "partition", before + 1 AS first, o - 1 AS last
FROM (SELECT p, o, lag(o) OVER (PARTITION BY p ORDER BY o) AS before FROM ({_READ}) AS r) AS s
WHERE o - before > 1"""
)
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets that never came."""
    return _coverage(spark, sf_dir).gaps(spark)


@QUERIES.add(
    f"""
SELECT '{TOPIC}' AS topic, CAST(p AS INTEGER) AS "partition", min(o) AS first, max(o) AS last, times
FROM (SELECT p, o, times, o - row_number() OVER (PARTITION BY p, times ORDER BY o) AS island
      FROM (SELECT p, o, CAST(1 + CASE WHEN {_AGAIN} THEN 1 ELSE 0 END + CASE WHEN {_TWICE} THEN 1 ELSE 0 END
            AS BIGINT) AS times FROM ({_READ}) AS r) AS t) AS s
WHERE times > 1 GROUP BY p, times, island"""
)
def offset_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets that came more than once."""
    return _coverage(spark, sf_dir).overlaps(spark)


# --- landed files, batches ------------------------------------------------------------------


@QUERIES.add(f"SELECT {field_sql()} FROM events")
def landing_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of every message, after the files were gathered half-way and at the end."""
    root = scratch_dir(spark, "landing_compacted")
    landed = LandedFiles(f"{root}/out", ACTIVITY, target_bytes=1 << 20)
    for half in (0, 1):
        path = f"{root}/messages"
        messages(spark, sf_dir, waves=2, where=f"event_id % 2 = {half}").write.mode("append").parquet(path)
        stream = message_files(spark, path, max_files=4)
        await_query(land_parquet(stream, landed.path, f"{root}/checkpoint", trigger={"availableNow": True}))
        landed.compact(spark)
    return zoneless(landed.read(spark))


@QUERIES.add(
    """
SELECT 'user_product_interactions' AS table_name, count(*) AS n_rows FROM events
UNION ALL SELECT 'user_feedback', count(*) FROM events"""
)
def stream_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both fact tables as of the last batch that is in both."""
    root = scratch_dir(spark, "stream_published")
    targets = Targets(
        interactions=BatchFolders(f"{root}/interactions", INTERACTIONS),
        feedback=BatchFolders(f"{root}/feedback", FEEDBACK),
        coverage=OffsetCoverage(f"{root}/coverage"),
        publication=Publication(f"{root}/published"),
    )
    path = f"{root}/messages"
    messages(spark, sf_dir, *FACTS_PAYLOAD.fieldNames(), waves=2).write.parquet(path)
    stream = message_files(spark, path, max_files=spark.sparkContext.defaultParallelism)
    query = start_curation(stream, targets, f"{root}/checkpoint", payload=FACTS_PAYLOAD, trigger={"availableNow": True})
    await_query(query)
    facts = targets.publication.read(spark, targets.interactions, targets.feedback)
    names = ("user_product_interactions", "user_feedback")
    counted = [rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, rows in zip(names, facts)]
    return counted[0].unionByName(counted[1])


@QUERIES.add(_FIRST_USERS)
def stream_users_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users kept by a stream whose messages come in no order, folded every few batches."""
    root = scratch_dir(spark, "stream_users_keyed")
    path = f"{root}/messages"
    messages(spark, sf_dir, *USERS_PAYLOAD.fieldNames(), waves=2).orderBy(F.xxhash64("offset")).write.parquet(path)
    stored = KeyedTable(f"{root}/users", USERS, bucket_rows=256, fold_rows=400)
    stream = message_files(spark, path, max_files=spark.sparkContext.defaultParallelism)
    await_query(start_users(stream, stored, f"{root}/checkpoint", trigger={"availableNow": True}))
    return zoneless(stored.read(spark))


# --- metrics, samples, types ----------------------------------------------------------------


@QUERIES.add(
    """
SELECT 'distinct users' AS name, count(*) AS n_rows, true AS within FROM events
UNION ALL SELECT unnest(['session quantile 0.5', 'session quantile 0.9', 'session quantile 0.99']), count(*), true
FROM events"""
)
def sketched_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether distinct users and session quantiles, merged from a sketch per batch, are within the
    stated error of the exact ones."""
    records = accepted(decode(messages(spark, sf_dir, "user_id", "session_duration"), narrowed("session_duration")))
    batches = records.withColumn("batch_id", F.col("ingest_offset") % 7)
    sketches = sketched(batches, distinct="user_id", measured="session_duration", by=["batch_id"])
    asked = (0.5, 0.9, 0.99)
    said = estimates(merged(sketches), asked).first()
    duration, slack = F.col("session_duration"), 2 * RANK_ERROR
    within = {
        "distinct users": F.abs(F.count_distinct("user_id") - said.n_distinct)
        <= 4 * DISTINCT_ERROR * F.count_distinct("user_id") + 1
    }
    for q, value in zip(asked, said.quantiles):  # where the ranks of the value begin and end
        below, upto = F.count_if(duration < value), F.count_if(duration <= value)
        n = F.count("*")
        within[f"session quantile {q}"] = (below <= (q + slack) * n) & (upto >= (q - slack) * n)
    rows = F.array(*(F.struct(F.lit(name).alias("name"), ok.alias("within")) for name, ok in within.items()))
    judged = records.agg(rows.alias("rows"))
    return judged.select(F.inline("rows")).withColumn("n_rows", F.lit(said.n_rows).cast("long"))


@QUERIES.add(
    """
SELECT event_id, event_type, lot FROM (
  SELECT event_id, event_type, md5(concat('7|', event_id)) AS lot,
    row_number() OVER (PARTITION BY event_type ORDER BY md5(concat('7|', event_id)), event_id) AS n FROM events) AS r
WHERE n <= 25"""
)
def sample_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty-five events of each type, the same ones in every run."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return bottom_k(events, 25, ["event_id"], by=["event_type"], seed=7).withColumn("lot", lot(["event_id"], 7))


# Messages whose amount is a number, a text, null or missing, some with a key nobody knows.
def _drifting(spark: SparkSession, sf_dir: str, waves: int = 1) -> DataFrame:
    value = F.expr(
        """concat('{"id":', event_id,
            CASE event_id % 5 WHEN 0 THEN concat(',"amount":', event_id) WHEN 1 THEN concat(',"amount":"', event_id, '"')
                 WHEN 2 THEN ',"amount":null' ELSE '' END,
            CASE WHEN event_id % 7 = 0 THEN concat(',"coupon":{"code":"c', event_id, '","used":[true,1]}') ELSE '' END, '}')"""
    )
    return envelope(events_of(spark, sf_dir, waves), value)


@QUERIES.add(
    """
SELECT * FROM (
  SELECT '$' AS path, 'OBJECT' AS type, count(*) AS n FROM events
  UNION ALL SELECT '$.id', 'BIGINT', count(*) FROM events
  UNION ALL SELECT '$.amount', CASE event_id % 5 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' ELSE 'VOID' END, count(*)
    FROM events WHERE event_id % 5 < 3 GROUP BY 2
  UNION ALL SELECT unnest(['$.coupon', '$.coupon.code', '$.coupon.used', '$.coupon.used[*]', '$.coupon.used[*]']),
    unnest(['OBJECT', 'STRING', 'ARRAY', 'BOOLEAN', 'BIGINT']), count(*) FROM events WHERE event_id % 7 = 0) AS t
WHERE n > 0"""
)
def type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path, type and count of everything that landed, known or not."""
    root = scratch_dir(spark, "type_drift")
    _drifting(spark, sf_dir, waves=2).write.parquet(f"{root}/messages")
    stream = message_files(spark, f"{root}/messages", max_files=spark.sparkContext.defaultParallelism)
    await_query(land_variant(stream, f"{root}/out", f"{root}/checkpoint", trigger={"availableNow": True}))
    return type_counts(spark.read.parquet(f"{root}/out"))


@QUERIES.add(
    """
SELECT event_id AS ingest_offset, concat('c', event_id) AS coupon FROM events WHERE event_id % 7 = 0"""
)
def landing_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that no schema has, read from what landed."""
    root = scratch_dir(spark, "landing_unknown_keys")
    _drifting(spark, sf_dir, waves=2).write.parquet(f"{root}/messages")
    stream = message_files(spark, f"{root}/messages", max_files=spark.sparkContext.defaultParallelism)
    await_query(land_variant(stream, f"{root}/out", f"{root}/checkpoint", trigger={"availableNow": True}))
    landed = spark.read.parquet(f"{root}/out")
    return landed.select("ingest_offset", F.try_variant_get("record", "$.coupon.code", "string").alias("coupon")).where("coupon IS NOT NULL")


# --- state ----------------------------------------------------------------------------------


@QUERIES.add(
    f"""
SELECT *, 7 AS state_partitions, (SELECT count(DISTINCT user_id) FROM events) AS remembered FROM ({_FIRST_USERS}) AS f"""
)
def stream_users_redealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from a query that goes from four to seven state partitions half-way; what it remembers
    in the end is every user."""
    root = scratch_dir(spark, "stream_users_redealt")
    stored = ParquetTable(f"{root}/users", USERS)
    middle = table(spark, sf_dir, "events").agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    span = f"TIMESTAMP_NTZ '{middle:%Y-%m-%d %H:%M:%S.%f}'"
    kept = None
    for half, n, compared in (("first", 4, "<"), ("second", 7, ">=")):
        path = f"{root}/{half}"
        messages(spark, sf_dir, *USERS_PAYLOAD.fieldNames(), where=f"ts {compared} {span}").write.parquet(path)
        query = start_users(
            message_files(spark, path),
            stored,
            f"{root}/{half}-checkpoint",
            trigger={"availableNow": True},
            remember_users="365 days",
            n_state_partitions=n,
            kept_state=kept,
        )
        await_query(query)
        kept = f"{root}/{half}-state"
        remembered = export_state(spark, f"{root}/{half}-checkpoint", kept)
    held = state_rows(spark, f"{root}/second-checkpoint")
    n = spark.read.format("state-metadata").load(f"{root}/second-checkpoint").first().numPartitions
    widths = {row.partition_id for row in held.select("partition_id").distinct().collect()}
    if not widths <= set(range(n)):
        raise ValueError(f"state of partitions {sorted(widths)}, of {n}")
    return zoneless(stored.read(spark)).withColumns(
        {"state_partitions": F.lit(n), "remembered": F.lit(remembered).cast("long")}
    )
