"""A table with the earliest row of every key, which finds keys without scanning all of them.

Rows are added in plain files and folded from time to time into buckets by the hash of the key. Each
bucket has a bitmap of its keys. Looking up the keys of a batch reads what was added since the last
fold, the bitmaps of their buckets, and the buckets in which a bitmap says there may be one. The
number of buckets grows with the table so that a bucket stays small, hence what a lookup reads
follows from the batch and not from the table.

An earlier row may arrive after a later one was stored. It is added like a new one, and whoever
reads sees the earliest row of a key; a fold writes the buckets anew that get rows, and only those.

Adding rows twice, or adding rows that a fold took in already, changes nothing. A fold is published
by one commit (``Commits``); a fold that dies before has changed nothing, and files that are no
longer referred to are removed two folds later, after the last reader that may know them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions.bitmaps import bitmaps, bucket_of, chunk_of, chunks_for, may_hold
from trolley.operators.dedup import ARRIVAL, earliest_per_key
from trolley.operators.keys import broadcast_if_small
from trolley.schemas import COORDINATES
from trolley.sinks.files import Commits, remove

_STATE = T.StructType(
    [
        T.StructField("buckets", T.IntegerType()),
        T.StructField("versions", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ]
)
_MOST_BUCKETS = 1 << 20


@dataclass(frozen=True)
class _State:
    """Number of the last fold; by bucket the fold that wrote it (-1: nothing did) and its rows."""

    number: int
    buckets: int
    versions: list[int]
    counts: list[int]


@dataclass(frozen=True)
class KeyedTable:
    """Rows of ``schema`` by ``key``, with the columns of ``order`` that say which row is earliest.

    A bucket has ``bucket_rows`` rows on average, or up to twice as many. ``due`` says when
    ``fold_rows`` rows were added, or ``fold_files`` files. One writer at a time; readers may come and go.
    """

    path: str
    schema: T.StructType
    key: str = "user_id"
    order: tuple[str, ...] = ARRIVAL
    bucket_rows: int = 1 << 15
    fold_rows: int = 1 << 22
    fold_files: int = 512

    # --- as any other table ---------------------------------------------------------------

    def create(self, spark: SparkSession) -> None:
        spark.createDataFrame([], self._layout()).write.mode("ignore").parquet(self._at("added"))

    def read(self, spark: SparkSession) -> DataFrame:
        """The earliest row of every key."""
        return self._merged(spark).select(*self.schema.fieldNames())

    def stored(self, spark: SparkSession, key: str, days: object = None) -> DataFrame:
        """All keys; see ``unseen`` and ``improved`` for a few."""
        return self._merged(spark).select(key)

    def write(self, rows: DataFrame, batch_id: int = 0) -> None:
        """Add rows; those without a key cannot be found again and are refused."""
        key = F.col(self.key)
        sound = F.when(key.isNull(), F.raise_error(F.lit(f"{self.key} is null"))).otherwise(key)
        rows = rows.select(*self._layout().fieldNames()).withColumn(self.key, sound)
        rows.write.mode("append").parquet(self._at("added"))

    # --- lookups --------------------------------------------------------------------------

    def found(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The key and ``_first``, the least order, of those of ``keys`` that are stored."""
        state = self._state(spark)
        keys = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        keys = broadcast_if_small(keys)
        parts = [self._added(spark)]
        hits = self._hits(spark, state, keys)
        if hits:
            parts.append(self._bucketed(spark, state, hits))
        place = F.struct(*self.order)
        held = [
            part.select(self.key, place.alias("_first")).join(keys, self.key, "left_semi") for part in parts
        ]
        stored = held[0] if len(held) == 1 else held[0].unionByName(held[1])
        return stored.groupBy(self.key).agg(F.min("_first").alias("_first"))

    def unseen(self, rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """Rows whose key is not stored. ``keys`` has the same keys where they are cheaper to get."""
        found = self.found(rows.sparkSession, rows if keys is None else keys)
        return rows.join(broadcast_if_small(found.select(self.key)), self.key, "left_anti")

    def improved(self, rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """Rows that are earlier than the stored row of their key, or the first of it."""
        found = self.found(rows.sparkSession, rows if keys is None else keys)
        joined = rows.join(broadcast_if_small(found), self.key, "left")
        earlier = F.col("_first").isNull() | (F.struct(*self.order) < F.col("_first"))
        return joined.where(earlier).select(*rows.columns)

    def _hits(self, spark: SparkSession, state: _State, keys: DataFrame) -> list[int]:
        """Buckets that may hold one of ``keys``."""
        chunks = chunks_for(2 * self.bucket_rows)
        asked = keys.select(
            self.key,
            bucket_of(self.key, state.buckets).alias("bucket"),
            chunk_of(self.key, chunks).alias("chunk"),
        )
        buckets = [row.bucket for row in asked.select("bucket").distinct().collect()]
        paths = self._paths(state, "bitmaps", buckets)
        if not paths:
            return []
        known = spark.read.schema("in_bucket long, chunk long, bits binary").parquet(*paths)
        same = (asked.bucket == known.in_bucket) & (asked.chunk == known.chunk)
        hits = known.join(asked, same).where(may_hold(known.bits, F.col(self.key)))
        return [row.bucket for row in hits.select("bucket").distinct().collect()]

    # --- folds ----------------------------------------------------------------------------

    def due(self, spark: SparkSession) -> bool:
        added = self._added(spark)
        return len(added.inputFiles()) >= self.fold_files or added.count() >= self.fold_rows

    def fold(self, spark: SparkSession) -> bool:
        """Take what was added into the buckets; False if there was nothing."""
        state = self._state(spark)
        files = self._added(spark).inputFiles()
        if not files:
            return False
        added = spark.read.schema(self._layout()).parquet(*files)
        fresh = added.select(bucket_of(self.key, state.buckets).alias("bucket"), self.key)
        counted = fresh.groupBy("bucket").agg(F.count_distinct(self.key).alias("n")).collect()
        buckets = self._wanted(state, sum(row.n for row in counted))
        anew = range(state.buckets) if buckets != state.buckets else [row.bucket for row in counted]
        old = self._bucketed(spark, state, anew)
        rows = self._earliest(added)  # a hot key ships one row per task, the others are few per key
        rows = rows if old is None else rows.unionByName(old)
        number = state.number + 1
        self._write_buckets(spark, rows, buckets, number)
        self._publish(spark, state, buckets, number)
        remove(spark, files)
        self._sweep(spark, number)
        return True

    def _wanted(self, state: _State, more: int) -> int:
        """Number of buckets that fits so many rows more; it never falls."""
        rows = sum(state.counts) + more
        fitting = 1 << max(0, -(-rows // (2 * self.bucket_rows)) - 1).bit_length()
        return min(max(state.buckets, fitting), _MOST_BUCKETS)

    def _write_buckets(self, spark: SparkSession, rows: DataFrame, buckets: int, number: int) -> None:
        bucket = bucket_of(self.key, buckets).alias("bucket")
        first = Window.partitionBy("bucket", self.key).orderBy(*self.order)
        # one exchange: what is dealt by bucket has the rows of a key together, and sorted for writing
        dealt = rows.select("*", bucket).repartition("bucket").withColumn("_rank", F.row_number().over(first))
        dealt = dealt.where("_rank = 1").drop("_rank")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._at(f"rows/{number}"))
        keys = spark.read.parquet(self._at(f"rows/{number}")).select(self.key)
        index = bitmaps(keys, self.key, buckets, chunks_for(2 * self.bucket_rows))
        index = index.select("bucket", F.col("bucket").alias("in_bucket"), "chunk", "bits")
        dealt = index.repartition("bucket").sortWithinPartitions("bucket", "chunk")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._at(f"bitmaps/{number}"))

    def _publish(self, spark: SparkSession, state: _State, buckets: int, number: int) -> None:
        grown = buckets != state.buckets
        versions = [-1] * buckets if grown else list(state.versions)
        counts = [0] * buckets if grown else list(state.counts)
        written = spark.read.parquet(self._at(f"rows/{number}")).groupBy("bucket").count()
        for bucket, n in written.collect():  # as many as there are buckets
            versions[bucket], counts[bucket] = number, n
        self._commits().publish(spark, number, (buckets, versions, counts))

    def _sweep(self, spark: SparkSession, number: int) -> None:
        """Remove what only the fold before the last one knew."""
        commits = self._commits()
        if number - 2 not in commits.numbers(spark):
            return

        def known(n: int) -> set[tuple[int, int]]:
            return {(v, b) for b, v in enumerate(commits.read(spark, n).versions) if v >= 0}

        for version, bucket in known(number - 2) - known(number - 1) - known(number):
            remove(spark, [self._at(f"{kind}/{version}/bucket={bucket}") for kind in ("rows", "bitmaps")])

    # --- parts ----------------------------------------------------------------------------

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def _commits(self) -> Commits:
        return Commits(self._at("folds"), _STATE)

    def _state(self, spark: SparkSession) -> _State:
        number, row = self._commits().latest(spark)
        return _State(number, 1, [-1], [0]) if row is None else _State(number, *row)

    def _layout(self) -> T.StructType:
        own = {field.name: field for field in COORDINATES}
        return T.StructType([*self.schema.fields, *(own[n] for n in self.order if n not in self.schema.fieldNames())])

    def _added(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._layout()).parquet(self._at("added"))

    def _paths(self, state: _State, kind: str, buckets) -> list[str]:
        held = ((b, state.versions[b]) for b in sorted(buckets))
        return [self._at(f"{kind}/{version}/bucket={b}") for b, version in held if version >= 0]

    def _bucketed(self, spark: SparkSession, state: _State, buckets) -> DataFrame | None:
        paths = self._paths(state, "rows", buckets)
        return spark.read.schema(self._layout()).parquet(*paths) if paths else None

    def _earliest(self, rows: DataFrame) -> DataFrame:
        return earliest_per_key(rows, self.key, self.order, keep_order=True)

    def _merged(self, spark: SparkSession) -> DataFrame:
        """Buckets without the keys that were added since, and those keys."""
        state = self._state(spark)
        added, base = self._added(spark), self._bucketed(spark, state, range(state.buckets))
        if base is None:
            return self._earliest(added)
        keys = broadcast_if_small(added.select(self.key).distinct())
        touched = added.unionByName(base.join(keys, self.key, "left_semi"))
        return base.join(keys, self.key, "left_anti").unionByName(self._earliest(touched))
