"""Start a job: ``spark-submit ... launch.py JOB`` or ``python -m trolley JOB``.

``users``, ``facts`` and ``all`` fill tables, ``land-*`` files; ``publish`` sends records. The others
look after what those keep: ``compact`` gathers landed files, ``fold`` takes added users into the
buckets, ``offsets`` prints what was lost or read twice, ``export-state`` writes what a stopped
``users`` job remembers.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trolley import session
from trolley.operators import drop_empty
from trolley.schemas import ACTIVITY, FEEDBACK, INTERACTIONS, METRICS, QUARANTINE, USERS
from trolley.sinks import (
    BatchFolders,
    JdbcTable,
    KeyedTable,
    LandedFiles,
    LedgerTable,
    OffsetCoverage,
    ParquetTable,
    Table,
)
from trolley.sources import Jdbc, KafkaTopic, message_files, stream_topic
from trolley.streaming import (
    await_query,
    export_state,
    land_json,
    land_parquet,
    land_rejects,
    land_variant,
    start_all,
    start_facts,
    start_users,
)

_CARE = ("compact", "fold", "offsets", "export-state")
_LANDING = ("land-json", "land-parquet", "land-rejects", "land-variant")
_JOBS = ("users", "facts", "all", *_LANDING, "publish", *_CARE)
_DAY = T.StructField("ingest_day", T.DateType())


def parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="trolley", description=__doc__)
    cli.add_argument("job", choices=_JOBS)
    source = cli.add_argument_group("messages")
    source.add_argument("--bootstrap-servers")
    source.add_argument("--topic", default="user-activity")
    source.add_argument("--starting-offsets", default="earliest")
    source.add_argument("--group-id")
    source.add_argument(
        "--max-offsets",
        type=int,
        default=5_000_000,
        help="messages per batch at most; only paces the job, all are processed",
    )
    source.add_argument("--min-partitions", type=int, help="tasks per batch at least")
    source.add_argument(
        "--max-files",
        type=int,
        default=200,
        help="files of --messages per batch at most; only paces the job, all are processed",
    )
    source.add_argument("--kafka-properties", help="file of further kafka.* options")
    source.add_argument("--messages", help="folder of Kafka-shaped Parquet files instead of a topic")
    source.add_argument("--batched", action="store_true", help="a message may hold a JSON array")
    source.add_argument("--records", help="publish: folder with one JSON record per line")
    target = cli.add_argument_group("targets")
    target.add_argument("--tables", help="folder for tables kept as Parquet, or landed files")
    target.add_argument("--jdbc-url", help="database for users and facts")
    target.add_argument("--jdbc-driver")
    target.add_argument("--jdbc-properties", help="file with user, password and the like")
    target.add_argument(
        "--jdbc-types", help="types of columns if tables are created, e.g. 'email varchar(255)'"
    )
    target.add_argument("--jdbc-connections", type=int, default=8)
    target.add_argument(
        "--jdbc-by-day", action="store_true", help="facts have a column ingest_day for lookups"
    )
    target.add_argument(
        "--keyed-users",
        action="store_true",
        help="keep users in buckets by key, with bitmaps: lookups read little, and a record that "
        "comes late replaces a later one",
    )
    target.add_argument(
        "--exactly-once",
        metavar="NAME",
        help="take every batch into the database once, by a ledger; NAME stands for the checkpoint",
    )
    target.add_argument("--coverage", action="store_true", help="keep which offsets were read")
    target.add_argument("--target-bytes", type=int, default=128 << 20, help="compact: size of the files")
    run = cli.add_argument_group("run")
    run.add_argument("--remember-users", metavar="INTERVAL", help="users: drop those seen lately by state")
    run.add_argument("--state-partitions", type=int)
    run.add_argument("--kept-state", help="folder that export-state writes, or an earlier one wrote")
    run.add_argument("--of", help="offsets: the job whose coverage is meant", default="all")
    run.add_argument("--checkpoint", help="folder for the progress of the query")
    run.add_argument(
        "--trigger",
        help="interval such as '20 seconds', 'asap', or 'available' to drain and stop",
    )
    run.add_argument(
        "--keep",
        choices=("payload", "fields"),
        default="payload",
        help="land-json: messages as sent or their known fields; land-rejects: what that leaves out",
    )
    run.add_argument("--clock", choices=("event", "ingest"), default="event")
    run.add_argument("--staging", help="folder to stage batches in instead of memory")
    run.add_argument("--samples", type=int, default=0, help="rows to log before each write")
    return cli


def properties(path: str | None) -> dict[str, str]:
    """``key=value`` lines; blank lines and lines starting with ``#`` are skipped."""
    if path is None:
        return {}
    lines = [line.strip() for line in Path(path).read_text().splitlines()]
    pairs = [line.partition("=") for line in lines if line and not line.startswith("#")]
    return {key.strip(): value.strip() for key, _, value in pairs}


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.messages:
        return message_files(spark, args.messages, max_files=args.max_files)
    if not args.bootstrap_servers:
        raise SystemExit("give --bootstrap-servers or --messages")
    topic = KafkaTopic(
        args.bootstrap_servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        group_id=args.group_id,
        max_offsets=args.max_offsets,
        min_partitions=args.min_partitions,
        options=properties(args.kafka_properties),
    )
    return stream_topic(spark, topic)


def _table(args: argparse.Namespace, name: str, schema: T.StructType, *, by_day: bool) -> Table:
    if args.jdbc_url:
        db = Jdbc(args.jdbc_url, args.jdbc_driver, properties(args.jdbc_properties))
        named = {field.name.lower() for field in schema}
        types = [
            part.strip()
            for part in (args.jdbc_types or "").split(",")
            if part.strip() and part.split()[0].lower() in named
        ]
        table = JdbcTable(
            db,
            name,
            schema,
            column_types=", ".join(types) or None,
            connections=args.jdbc_connections,
            by_day=by_day and args.jdbc_by_day,
        )
        if args.exactly_once:
            key = schema.fieldNames()[-1] if by_day else schema.fieldNames()[0]
            return LedgerTable(table, f"{args.exactly_once} {name}", key, lookup=not by_day)
        return table
    if name == "users" and args.keyed_users:
        return KeyedTable(f"{args.tables}/{name}", schema)
    return ParquetTable(f"{args.tables}/{name}", schema, by_day=by_day, rebalance=True)


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """Start the job named in ``args``."""
    if not args.checkpoint:
        raise SystemExit("give --checkpoint")
    if not args.tables:
        raise SystemExit("give --tables")
    messages = _messages(spark, args)
    given = {}
    if args.trigger == "asap":
        given["trigger"] = None
    elif args.trigger == "available":
        given["trigger"] = {"availableNow": True}
    elif args.trigger:
        given["trigger"] = {"processingTime": args.trigger}
    given["batched"] = args.batched
    if args.job == "land-parquet":
        return land_parquet(messages, args.tables, args.checkpoint, by_day=True, **given)
    if args.job == "land-json":
        return land_json(messages, args.tables, args.checkpoint, keep=args.keep, **given)
    if args.job == "land-variant":
        given.pop("batched")
        return land_variant(messages, args.tables, args.checkpoint, **given)
    if args.job == "land-rejects":
        return land_rejects(messages, args.tables, args.checkpoint, keep=args.keep, **given)
    given.update(
        quarantine=ParquetTable(f"{args.tables}/quarantine_{args.job}", QUARANTINE, by_day=True),
        partial=ParquetTable(f"{args.tables}/partial_{args.job}", QUARANTINE, by_day=True),
        metrics=BatchFolders(f"{args.tables}/metrics_{args.job}", METRICS),
        samples=args.samples,
        staging=args.staging and f"{args.staging}/{args.job}",
        # Kafka hands out an offset once per batch; archived files may overlap.
        repeats=bool(args.messages),
    )
    if args.coverage:
        given["coverage"] = OffsetCoverage(f"{args.tables}/coverage_{args.job}")
    users = _table(args, "users", USERS, by_day=False)
    interactions = _table(args, "user_product_interactions", INTERACTIONS, by_day=True)
    feedback = _table(args, "user_feedback", FEEDBACK, by_day=True)
    if args.job == "users":
        given["remember_users"] = args.remember_users
        given["n_state_partitions"], given["kept_state"] = args.state_partitions, args.kept_state
        return start_users(messages, users, args.checkpoint, **given)
    given["clock"] = args.clock
    if args.job == "facts":
        return start_facts(messages, interactions, feedback, args.checkpoint, **given)
    return start_all(messages, users, interactions, feedback, args.checkpoint, **given)


def publish_lines(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send every line of the record files as one message."""
    if not (args.records and args.bootstrap_servers):
        raise SystemExit("give --records and --bootstrap-servers")
    lines = drop_empty(spark.read.text(args.records))
    (
        lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"))
        .write.format("kafka")
        .options(**properties(args.kafka_properties))
        .option("kafka.bootstrap.servers", args.bootstrap_servers)
        .option("topic", args.topic)
        .save()
    )


def care(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Look after what a job keeps; the lines say what was done or found."""
    if args.job == "export-state":
        if not (args.checkpoint and args.kept_state):
            raise SystemExit("give --checkpoint and --kept-state")
        return [f"{export_state(spark, args.checkpoint, args.kept_state)} records"]
    if not args.tables:
        raise SystemExit("give --tables")
    if args.job == "compact":
        schema = T.StructType([*ACTIVITY.fields, _DAY])
        landed = LandedFiles(args.tables, schema, by=(_DAY.name,), target_bytes=args.target_bytes)
        return [f"{landed.compact(spark)} files replaced, {len(landed.files(spark))} now"]
    if args.job == "fold":
        done = KeyedTable(f"{args.tables}/users", USERS).fold(spark)
        return ["folded" if done else "nothing to fold"]
    coverage = OffsetCoverage(f"{args.tables}/coverage_{args.of}")
    found = [("missing", coverage.gaps(spark)), ("again", coverage.overlaps(spark))]
    return [  # as many as there are spans to report
        f"{kind} {row.topic} {row.partition} {row.first}-{row.last}"
        for kind, spans in found
        for row in spans.orderBy("topic", "partition", "first").toLocalIterator()
    ]


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session.build(f"trolley {args.job}")
    if args.job == "publish":
        publish_lines(spark, args)
    elif args.job in _CARE:
        print("\n".join(care(spark, args)))
    else:
        await_query(start(spark, args))


if __name__ == "__main__":
    main()
