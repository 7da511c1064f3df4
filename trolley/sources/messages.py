"""Kafka topics, and files holding the same rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from trolley.schemas import MESSAGE


@dataclass(frozen=True)
class KafkaTopic:
    """A subscription. Defaults replay the topic from its start and tolerate aged-out offsets.

    ``group_id`` only labels the consumer on the broker; progress is kept in the checkpoint of
    the query. ``max_offsets`` bounds a micro-batch, ``min_partitions`` splits topic partitions
    over more tasks. Further ``kafka.*`` options, credentials among them, go into ``options``.
    """

    bootstrap_servers: str
    topic: str
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    group_id: str | None = None
    min_partitions: int | None = None
    max_offsets: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self, *, streaming: bool) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.group_id is not None:
            options["kafka.group.id"] = self.group_id
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        if streaming and self.max_offsets is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets)
        return {**options, **self.options}


def stream_topic(spark: SparkSession, topic: KafkaTopic) -> DataFrame:
    """The topic as an unbounded table with the ``MESSAGE`` columns."""
    options = topic.reader_options(streaming=True)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic(spark: SparkSession, topic: KafkaTopic) -> DataFrame:
    """What the topic holds now, for a bounded backfill."""
    options = topic.reader_options(streaming=False)
    return spark.read.format("kafka").options(**options).load()


def message_files(
    spark: SparkSession, path: str, *, max_files: int | None = None, streaming: bool = True
) -> DataFrame:
    """Parquet files of Kafka-shaped rows, e.g. an archived topic."""
    if not streaming:
        return spark.read.schema(MESSAGE).parquet(path)
    reader = spark.readStream.schema(MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
