"""Coverage of offsets, kept over the batches of a query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.operators.coverage import SPANS, combined, gaps, observed, overlaps
from trolley.sinks.files import Commits, remove

_STATE = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("folder", T.StringType())])


@dataclass(frozen=True)
class OffsetCoverage:
    """Spans of all offsets that the batches of one query have brought.

    The state is spans, as many as there are gaps and repeats, and is written anew by each batch; it
    changes by one commit, and a batch that runs again after that is known and adds nothing. Keep
    one for each checkpoint, since it is the checkpoint that numbers batches.
    """

    path: str

    def create(self, spark: SparkSession) -> None:
        """Nothing has to be there before the first batch."""

    def read(self, spark: SparkSession) -> DataFrame:
        """``topic``, ``partition``, ``first``, ``last``, ``times``."""
        _, state = self._commits().latest(spark)
        return spark.createDataFrame([], SPANS) if state is None else self._spans(spark, state.folder)

    def gaps(self, spark: SparkSession) -> DataFrame:
        """Offsets that no batch has brought, though later ones of their partition were: lost, or
        never written by a producer's transaction."""
        return gaps(self.read(spark))

    def overlaps(self, spark: SparkSession) -> DataFrame:
        """Offsets that came more than once."""
        return overlaps(self.read(spark))

    def add(self, messages: DataFrame, batch_id: int) -> bool:
        """Add a batch of messages; False if it was added before."""
        spark = messages.sparkSession
        number, state = self._commits().latest(spark)
        if state is not None and state.batch_id >= batch_id:
            return False
        spans = observed(messages)
        if state is not None:
            spans = combined(spans.unionByName(self._spans(spark, state.folder)))
        folder = f"{self.path.rstrip('/')}/spans/{number + 1}"
        spans.write.mode("overwrite").parquet(folder)
        self._commits().publish(spark, number + 1, (batch_id, folder))
        remove(spark, [f"{self.path.rstrip('/')}/spans/{number - 1}"])  # readers may have the last one
        return True

    def add_decoded(self, decoded: DataFrame, batch_id: int) -> bool:
        """The same for decoded records, of which a message may have several."""
        one = F.col("ingest_item").isNull() | (F.col("ingest_item") == 0)
        names = ("topic", "partition", "offset")
        rows = decoded.where(one).select(*(F.col(f"ingest_{name}").alias(name) for name in names))
        return self.add(rows, batch_id)

    def _commits(self) -> Commits:
        return Commits(f"{self.path.rstrip('/')}/commits", _STATE)

    def _spans(self, spark: SparkSession, folder: str) -> DataFrame:
        return spark.read.schema(SPANS).parquet(folder)
