"""What landed files take on disk."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trolley import plans
from trolley.schemas import ACTIVITY
from trolley.sources import message_files
from trolley.streaming import await_query, land_json

N = 2000


@pytest.fixture
def events(spark, scratch):
    rows = spark.range(0, N, 1, 1).select(
        F.col("id").alias("event_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        (F.col("id") % 20).alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{scratch}/events.parquet")
    return scratch


def taken(files):
    return sum(path.stat().st_size for path in files)


def test_landed_json_takes_a_fraction_of_its_text(spark, events):
    landed = plans.queries()["landing_json"](spark, events)
    rows = landed.collect()
    assert sorted(row.email for row in rows) == sorted(f"u{n % 20}.{n}@example.com" for n in range(N))
    out = [Path(name.removeprefix("file:")) for name in landed.inputFiles()]
    text = taken(out) if out[0].suffix != ".gz" else sum(
        len(row.value) + 1 for row in spark.read.text([str(path) for path in out]).collect()
    )
    assert 4 * taken(out) < text


@pytest.mark.parametrize("keep", ["payload", "fields"])
def test_compression_changes_no_line(spark, scratch, inbox, keep):
    inbox(['{"user_id":"a"}', "[1]", '{"user_id":"ü","unknown":1}']).write.parquet(f"{scratch}/in")
    lines = {}
    for kind in ("none", "gzip"):
        out = f"{scratch}/{kind}"
        await_query(
            land_json(
                message_files(spark, f"{scratch}/in"), out, f"{out}-checkpoint",
                trigger={"availableNow": True}, keep=keep, compression=kind,
            )
        )
        assert all((path.suffix == ".gz") == (kind == "gzip") for path in Path(out).glob("part-*"))
        lines[kind] = sorted(row.value for row in spark.read.text(out).collect())
    assert lines["none"] == lines["gzip"] and len(lines["none"]) == (3 if keep == "payload" else 2)
    if keep == "fields":
        read = spark.read.schema(ACTIVITY).json(f"{scratch}/gzip")
        assert sorted(row.user_id for row in read.collect()) == ["a", "ü"]
