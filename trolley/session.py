"""Session settings the jobs rely on, and where they may keep intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings: wire timestamps carry no zone, so the session must not add one; a hot
# key is split by AQE; RocksDB keeps streaming state off the JVM heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session that somebody else built."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build(app_name: str, **conf: str) -> SparkSession:
    """A session for ``spark-submit``; master, memory and shuffle width stay with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[int]:
    """Start a stateful query inside this to give its state ``n`` partitions, one per core by
    default. The number cannot change while the checkpoint lives, and AQE does not adapt it."""
    width = n or spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        yield width
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def in_one_process(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's process; those of ``local-cluster`` do not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="trolley-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
