"""Compaction of landed files, and batches that appear in all tables at once."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.schemas import FEEDBACK, INTERACTIONS, METRICS
from trolley.sinks import BatchFolders, LandedFiles, Publication, files
from trolley.sinks.compaction import gathered
from trolley.streaming import Targets, backfill

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("day", T.StringType())])


def land(spark, path, first, n, pieces=5, **options):
    """Rows ``first`` to ``first + n`` through a streaming sink, as many small files."""
    source = f"{path}.in"
    rows = spark.range(first, first + n).selectExpr("id", "repeat(md5(string(id)), 4) AS text", "string(id % 2) AS day")
    rows.repartition(pieces).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", options.get("files", 100)).parquet(source)
    writer = stream.writeStream.option("checkpointLocation", f"{path}.checkpoint")
    for name in options.get("by", ()):
        writer = writer.partitionBy(name)
    writer.format(options.get("kind", "parquet")).trigger(availableNow=True).start(path).awaitTermination()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("kind, by", [("parquet", ()), ("parquet", ("day",)), ("json", ())])
def test_files_get_few_and_rows_stay(spark, scratch, kind, by):
    landed = LandedFiles(f"{scratch}/out", SCHEMA, kind=kind, by=by, target_bytes=1 << 20)
    n = 0
    for wave in range(4):
        land(spark, landed.path, n, 200, kind=kind, by=by)
        n += 200
        before = len(landed.files(spark))
        assert before >= 3 and landed.compact(spark) >= before - 1
        assert len(landed.files(spark)) <= 2 ** len(by) * 2
        assert ids(landed.read(spark)) == list(range(n))
        assert sorted(r.day for r in landed.read(spark).select("day").distinct().collect()) == ["0", "1"]
    land(spark, landed.path, n, 10, kind=kind, by=by)  # not compacted yet, read all the same
    assert ids(landed.read(spark)) == list(range(n + 10))
    # files that were replaced two compactions ago are gone, though the log of the stream has them
    existing = [name for name in files.children(spark, landed.path) if name.startswith("part-")]
    assert by or len(existing) <= 12


def test_large_files_are_left_alone(spark, scratch):
    landed = LandedFiles(f"{scratch}/out", SCHEMA, target_bytes=4000)
    land(spark, landed.path, 0, 400, pieces=3)
    names = landed.files(spark)
    assert landed.compact(spark) == 0 and landed.files(spark) == names
    assert gathered({"a": 60, "b": 50, "c": 40, "d": 100}, 100) == ["a", "c"]
    assert gathered({}, 100) == [] and gathered({"a": 1}, 100) == []


def test_tasks_write_one_file_per_bin_without_a_shuffle(spark, scratch):
    landed = LandedFiles(f"{scratch}/out", SCHEMA, target_bytes=60_000)
    land(spark, landed.path, 0, 3000, pieces=30, files=2)
    sizes = [files.size_of(spark, name) for name in landed.files(spark)]
    landed.compact(spark)
    after = [files.size_of(spark, name) for name in landed.files(spark)]
    assert len(after) <= 2 * sum(sizes) / 60_000 + 1 < len(sizes) and max(after) <= 75_000
    assert ids(landed.read(spark)) == list(range(3000))


@pytest.mark.parametrize("step", ["publish", "remove"])
def test_a_compaction_that_dies_is_not_seen(spark, scratch, monkeypatch, step):
    landed = LandedFiles(f"{scratch}/out", SCHEMA, target_bytes=1 << 20)
    land(spark, landed.path, 0, 100)
    landed.compact(spark)
    land(spark, landed.path, 100, 100)
    names = landed.files(spark)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr("trolley.sinks.files.Commits.publish" if step == "publish" else "trolley.sinks.compaction.remove", dies)
        with pytest.raises(RuntimeError):
            landed.compact(spark)
    assert ids(landed.read(spark)) == list(range(200))
    assert (landed.files(spark) == names) == (step == "publish")
    landed.compact(spark)
    land(spark, landed.path, 200, 50)
    landed.compact(spark)
    assert ids(landed.read(spark)) == list(range(250))


def test_a_reader_keeps_its_files_during_a_compaction(spark, scratch):
    landed = LandedFiles(f"{scratch}/out", SCHEMA, target_bytes=1 << 20)
    land(spark, landed.path, 0, 100)
    reading = landed.read(spark)
    landed.compact(spark)
    later = landed.read(spark)
    assert ids(reading) == ids(later) == list(range(100))


def test_nothing_landed_yet(spark, scratch):
    landed = LandedFiles(f"{scratch}/out", SCHEMA)
    spark.createDataFrame([], SCHEMA).write.parquet(landed.path)
    assert landed.compact(spark) == 0 and landed.read(spark).count() == 0


class Broken(BatchFolders):
    def write(self, rows, batch_id):
        raise RuntimeError("the database is down")


def test_readers_see_a_batch_in_all_tables_or_in_none(spark, scratch, inbox):
    facts = BatchFolders(f"{scratch}/interactions", INTERACTIONS)
    said = BatchFolders(f"{scratch}/feedback", FEEDBACK)
    metrics = BatchFolders(f"{scratch}/metrics", METRICS)
    published = Publication(f"{scratch}/published")
    sound = Targets(interactions=facts, feedback=said, metrics=metrics, publication=published)
    broken = Targets(interactions=facts, feedback=Broken(said.path, FEEDBACK), metrics=metrics, publication=published)

    def counts():
        return [rows.count() for rows in published.read(spark, facts, said)]

    for table in (facts, said):
        table.create(spark)
    assert published.through(spark) == -1 and counts() == [0, 0]
    backfill(inbox(['{"user_id":"a"}'] * 3), sound, batch_id=0)
    assert counts() == [3, 3]
    more = inbox(['{"user_id":"b"}'] * 2, first=3)
    with pytest.raises(RuntimeError):
        backfill(more, broken, batch_id=1)
    assert facts.read(spark).count() == 5 and counts() == [3, 3]
    backfill(more, sound, batch_id=1)
    assert counts() == [5, 5] and published.through(spark) == 1
    published.mark(spark, 0)  # an old batch takes nothing back
    assert published.through(spark) == 1
    assert metrics.read(spark).where(F.col("batch_id") >= 0).count() == 4
