import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from trolley import session as trolley_session  # noqa: E402
from trolley.schemas import MESSAGE  # noqa: E402
from trolley.sources import Jdbc  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = trolley_session.configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return trolley_session.scratch_dir(spark, "test")


@pytest.fixture
def derby():
    return Jdbc(f"jdbc:derby:memory:test{uuid.uuid4().hex};create=true")


@pytest.fixture
def inbox(spark):
    """Kafka-shaped rows from payload texts: offsets count up, one second apart."""

    def build(payloads, first=0, topic="user-activity", partitions=1):
        rows = [(first + i, text) for i, text in enumerate(payloads)]
        df = spark.createDataFrame(rows, "offset long, text string")
        return df.select(
            F.lit(None).cast("binary").alias("key"),
            F.col("text").cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            (F.col("offset") % partitions).cast("int").alias("partition"),
            "offset",
            F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset")).alias("timestamp"),
            F.lit(0).alias("timestampType"),
        ).select(*MESSAGE.fieldNames())

    return build
