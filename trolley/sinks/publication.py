"""All tables of a batch appear at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.sinks.files import Commits
from trolley.sinks.tables import BatchFolders

_STATE = T.StructType([T.StructField("batch_id", T.LongType())])


@dataclass(frozen=True)
class Publication:
    """The last batch whose folders are all written, for tables kept in ``BatchFolders``.

    A job marks a batch after its last table; readers see the batches up to the one that is marked,
    in every table the same. A batch that fails half-way is in none of them until it has run again.
    """

    path: str

    def create(self, spark: SparkSession) -> None:
        """Nothing has to be there before the first batch."""

    def mark(self, spark: SparkSession, batch_id: int) -> None:
        number, state = self._commits().latest(spark)
        if state is None or state.batch_id < batch_id:
            self._commits().publish(spark, number + 1, (batch_id,))

    def through(self, spark: SparkSession) -> int:
        """The last batch that is published, -1 if none is."""
        _, state = self._commits().latest(spark)
        return -1 if state is None else state.batch_id

    def read(self, spark: SparkSession, *tables: BatchFolders) -> list[DataFrame]:
        """The tables as of one and the same batch; other folders are not even listed as input."""
        last = self.through(spark)
        # metrics of failed attempts have negative batches
        return [table.read(spark).where(F.col("batch_id") <= last) for table in tables]

    def _commits(self) -> Commits:
        return Commits(self.path, _STATE)
