"""Targets of a batch: Parquet folders and JDBC tables.

There are two ways to make the retry of a batch harmless. ``ParquetTable`` and ``JdbcTable``
are appended to after rows with a stored key were taken out. ``BatchFolders`` gives every
batch a folder of its own and overwrites it, which reads nothing but holds only as long as
the checkpoint that numbers the batches is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.sources.jdbc import Jdbc, key_ranges, read_table

Days = tuple[date, ...]


class Table(Protocol):
    """What a job needs of a target.

    ``create`` makes an empty table unless there is one already. ``stored`` is None where writing a batch again replaces what it wrote before; otherwise it
    gives the key column of the rows that may repeat rows received on ``days``.
    """

    def create(self, spark: SparkSession) -> None: ...

    def read(self, spark: SparkSession) -> DataFrame: ...

    def stored(self, spark: SparkSession, key: str, days: Days | None) -> DataFrame | None: ...

    def write(self, rows: DataFrame, batch_id: int) -> None: ...


@dataclass(frozen=True)
class ParquetTable:
    """A folder of Parquet files.

    ``by_day`` lays rows out by ``ingest_day``, so that a batch looks for its replays only in
    the days it was received on. That suits facts, whose id fixes the day; users are looked up
    over all history and stay unpartitioned. ``rebalance`` shuffles rows before they are
    written so that files are few and even, worth it when a backfill spans many days.
    """

    path: str
    schema: T.StructType
    by_day: bool = False
    rebalance: bool = False

    def create(self, spark: SparkSession) -> None:
        spark.createDataFrame([], self._layout()).write.mode("ignore").partitionBy(
            *self._day()
        ).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._layout()).parquet(self.path)

    def stored(self, spark: SparkSession, key: str, days: Days | None) -> DataFrame:
        rows = self.read(spark)
        if self.by_day and days is not None:
            day = F.col("ingest_day")
            rows = rows.where(day.isin(*days) | day.isNull())
        return rows.select(key)

    def write(self, rows: DataFrame, batch_id: int = 0) -> None:
        columns = self.schema.fieldNames()
        if not self.by_day:
            rows = rows.select(*columns)
            rows = rows.hint("rebalance") if self.rebalance else rows
            rows.write.mode("append").parquet(self.path)
            return
        rows = rows.select(*columns, F.to_date("ingest_ts").alias("ingest_day"))
        rows = rows.hint("rebalance", "ingest_day") if self.rebalance else rows
        rows.write.mode("append").partitionBy("ingest_day").parquet(self.path)

    def _day(self) -> list[str]:
        return ["ingest_day"] if self.by_day else []

    def _layout(self) -> T.StructType:
        days = [T.StructField(name, T.DateType()) for name in self._day()]
        return T.StructType([*self.schema.fields, *days])


@dataclass(frozen=True)
class BatchFolders:
    """A folder with one ``batch_id=`` folder per batch."""

    path: str
    schema: T.StructType

    def create(self, spark: SparkSession) -> None:
        empty = spark.createDataFrame([], self._layout())
        empty.write.mode("ignore").partitionBy("batch_id").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._layout()).parquet(self.path)

    def stored(self, spark: SparkSession, key: str, days: Days | None) -> None:
        return None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        columns = [name for name in self.schema.fieldNames() if name != "batch_id"]
        folder = f"{self.path}/batch_id={batch_id}"
        rows.select(*columns).write.mode("overwrite").parquet(folder)

    def _layout(self) -> T.StructType:
        named = "batch_id" in self.schema.fieldNames()
        batch = [] if named else [T.StructField("batch_id", T.LongType())]
        return T.StructType([*self.schema.fields, *batch])


@dataclass(frozen=True)
class JdbcTable:
    """A database table that is appended to.

    Spark commits a JDBC append per partition, and a task whose commit was not acknowledged
    runs again. A unique key on the target closes that gap; the anti-join alone does not.
    Stored keys are looked up over one connection per predicate; by default ranges of the
    key's first hex digit, which fits UUIDs and md5 ids and covers any other key unevenly.
    ``column_types`` is used if the table has to be created, e.g. ``user_id varchar(64)``; names
    in it replace the default, which makes the ``key`` (the last text column called ``..._id``
    unless given) ``varchar(64)`` so that it can be compared and indexed. ``by_day`` adds the column ``ingest_day``, by which the
    database narrows the lookup to the days of a batch.
    """

    db: Jdbc
    name: str
    schema: T.StructType
    predicates: Sequence[str] | None = None
    column_types: str | None = None
    connections: int = 8
    by_day: bool = False
    key: str | None = None

    def written(self) -> T.StructType:
        """The columns of the table."""
        day = [T.StructField("ingest_day", T.DateType())] if self.by_day else []
        return T.StructType([*self.schema.fields, *day])

    def create(self, spark: SparkSession) -> None:
        self._writer(spark.createDataFrame([], self.written())).mode("ignore").save()

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark, self._key()).select(*self.schema.fieldNames())

    def stored(self, spark: SparkSession, key: str, days: Days | None) -> DataFrame:
        rows = self._rows(spark, key)
        if self.by_day and days is not None:
            day = F.col("ingest_day")
            rows = rows.where(day.isin(*days) | day.isNull())
        return rows.select(key)

    def write(self, rows: DataFrame, batch_id: int = 0) -> None:
        self._writer(self._as_written(rows)).mode("append").save()

    def replace(self, rows: DataFrame, name: str) -> None:
        """Make another table ``name`` of the same columns that holds just ``rows``."""
        self._writer(self._as_written(rows)).option("dbtable", name).mode("overwrite").save()

    def _as_written(self, rows: DataFrame) -> DataFrame:
        day = [F.to_date("ingest_ts").alias("ingest_day")] if self.by_day else []
        return rows.select(*self.schema.fieldNames(), *day)

    def _rows(self, spark: SparkSession, key: str | None) -> DataFrame:
        """The table over one connection per predicate, or range of ``key``."""
        ranges = self.predicates
        if ranges is None and key is not None:
            ranges = key_ranges(self.db, key)
        return read_table(spark, self.db, self.name, predicates=ranges)

    def _key(self) -> str | None:
        texts = [f.name for f in self.schema if isinstance(f.dataType, T.StringType)]
        return self.key or next((name for name in reversed(texts) if name.endswith("_id")), None)

    def _column_types(self) -> str:
        given = self.column_types or ""
        named = {part.split()[0].lower() for part in given.split(",") if part.strip()}
        key = self._key()
        default = f"{key} varchar(64)" if key and key.lower() not in named else None
        return ", ".join(filter(None, [given, default]))

    def _writer(self, rows: DataFrame):
        writer = rows.write.format("jdbc").options(**self.db.all_options())
        writer = writer.option("dbtable", self.name).option("numPartitions", self.connections)
        types = self._column_types()
        return writer.option("createTableColumnTypes", types) if types else writer


def write_bucketed(
    rows: DataFrame, table: str, key: str, buckets: int, *, path: str | None = None
) -> None:
    """Save a catalog table hashed and sorted by ``key``, at ``path`` if given.

    Joins on ``key`` then read it bucket by bucket without shuffling it, which is how a
    large ``users`` table is best kept for batch jobs.
    """
    writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
