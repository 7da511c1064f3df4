import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import types as T

from trolley import session
from trolley.__main__ import care, parser, properties, start
from trolley.schemas import ACTIVITY, FEEDBACK, INTERACTIONS, USERS
from trolley.sinks import KeyedTable, LandedFiles, ParquetTable
from trolley.sources import read_table
from trolley.streaming import await_query


@pytest.fixture
def folder(scratch, inbox):
    path = f"{scratch}/messages"
    inbox([f'{{"user_id":"u{n % 3}","product_id":"p"}}' for n in range(9)] + ["{bad"]).write.parquet(path)
    return path


def run(spark, scratch, folder, job, *more):
    argv = [job, "--messages", folder, "--tables", f"{scratch}/out", "--trigger", "available"]
    await_query(start(spark, parser().parse_args([*argv, "--checkpoint", f"{scratch}/cp_{job}", *more])))


def test_curation_jobs(spark, scratch, folder):
    run(spark, scratch, folder, "users")
    run(spark, scratch, folder, "facts", "--clock", "ingest")
    run(spark, scratch, folder, "all", "--staging", f"{scratch}/staging")
    out = f"{scratch}/out"
    assert ParquetTable(f"{out}/users", USERS).read(spark).count() == 3
    facts = ParquetTable(f"{out}/user_product_interactions", INTERACTIONS, by_day=True).read(spark)
    assert facts.count() == 9 and facts.where("interaction_date is null").count() == 0
    assert ParquetTable(f"{out}/user_feedback", FEEDBACK, by_day=True).read(spark).count() == 9
    for job in ("users", "facts", "all"):
        assert spark.read.parquet(f"{out}/quarantine_{job}").count() == 1


@pytest.mark.parametrize("job, n", [("land-json", 9), ("land-parquet", 9), ("land-rejects", 1)])
def test_landing_jobs(spark, scratch, folder, job, n):
    run(spark, scratch, folder, job)
    read = spark.read.text if job == "land-json" else spark.read.parquet
    assert read(f"{scratch}/out").count() == n


@pytest.mark.parametrize(
    "argv",
    [
        ["users", "--messages", "x", "--tables", "y"],
        ["users", "--messages", "x", "--checkpoint", "y"],
        ["users", "--tables", "x", "--checkpoint", "y"],
    ],
)
def test_missing_arguments(spark, argv):
    with pytest.raises(SystemExit):
        start(spark, parser().parse_args(argv))


def test_properties(tmp_path):
    path = tmp_path / "db.properties"
    path.write_text("# login\nuser = me\n\npassword=a=b\n")
    assert properties(str(path)) == {"user": "me", "password": "a=b"}
    assert properties(None) == {}


def test_scratch_is_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


@pytest.mark.parametrize("day", [[], ["--jdbc-by-day"]])
def test_jobs_into_a_database(spark, scratch, folder, derby, day):
    """Tables the jobs create themselves, filled twice over without doubles."""
    for turn in range(2):
        for job in ("users", "facts", "all"):
            argv = [job, "--messages", folder, "--tables", f"{scratch}/out", "--trigger", "available"]
            argv += ["--checkpoint", f"{scratch}/cp_{job}_{turn}", "--jdbc-url", derby.url, *day]
            argv += ["--jdbc-types", "user_id varchar(40)", "--jdbc-connections", "2", "--max-files", "1"]
            await_query(start(spark, parser().parse_args(argv)))
    counts = {
        name: read_table(spark, derby, name).count()
        for name in ("users", "user_product_interactions", "user_feedback")
    }
    assert counts == {"users": 3, "user_product_interactions": 9, "user_feedback": 9}


def test_archive_is_drained_in_batches(spark, scratch, inbox):
    path = f"{scratch}/many"
    for n in range(4):
        inbox([f'{{"user_id":"u{n}"}}'], first=n).coalesce(1).write.mode("append").parquet(path)
    run(spark, scratch, path, "all", "--max-files", "1")
    batches = spark.read.parquet(f"{scratch}/out/metrics_all").where("table_name = 'users'")
    assert batches.where("n_rows = 1").select("batch_id").distinct().count() == 4


def test_launcher(scratch, folder):
    """The documented command, as a process of its own."""
    root = Path(__file__).resolve().parents[1]
    out = f"{scratch}/launched"
    command = [
        str(Path(pyspark.__file__).parent / "bin" / "spark-submit"), "--master", "local[2]",
        "--conf", "spark.ui.enabled=false", str(root / "launch.py"), "land-json", "--messages", folder,
        "--tables", out, "--checkpoint", f"{scratch}/cp_launched", "--trigger", "available",
    ]
    environment = os.environ | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run(command, env=environment, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line for path in Path(out).glob("*.txt") for line in path.read_text().splitlines()]
    assert len(lines) == 9


def looked_after(spark, *argv):
    return care(spark, parser().parse_args(argv))


def test_users_by_key_offsets_and_state(spark, scratch, folder, inbox):
    out = f"{scratch}/out"
    run(spark, scratch, folder, "users", "--keyed-users", "--remember-users", "1 day", "--state-partitions", "2")
    with pytest.raises(ValueError, match="offsets"):
        run(spark, scratch, folder, "users", "--coverage", "--remember-users", "1 day")
    inbox(['{"user_id":"u9"}'] * 2, first=20).write.mode("append").parquet(folder)
    inbox(['{"user_id":"u9"}'], first=21).write.mode("append").parquet(folder)
    run(spark, scratch, folder, "all", "--keyed-users", "--coverage")
    lines = looked_after(spark, "offsets", "--tables", out)
    assert lines == ["missing user-activity 0 10-19", "again user-activity 0 21-21"]
    assert looked_after(spark, "fold", "--tables", out) == ["folded"]
    assert looked_after(spark, "fold", "--tables", out) == ["nothing to fold"]
    users = KeyedTable(f"{out}/users", USERS).read(spark)
    assert sorted(r.user_id for r in users.collect()) == ["u0", "u1", "u2", "u9"]
    said = looked_after(spark, "export-state", "--checkpoint", f"{scratch}/cp_users", "--kept-state", f"{scratch}/state")
    assert said == ["4 records"]
    for argv in (["export-state"], ["compact"], ["offsets"]):
        with pytest.raises(SystemExit):
            looked_after(spark, *argv)


def test_landed_files_are_compacted(spark, scratch, folder):
    run(spark, scratch, folder, "land-parquet", "--max-files", "1")
    (line,) = looked_after(spark, "compact", "--tables", f"{scratch}/out")
    assert line.endswith("1 now")
    day = T.StructType([*ACTIVITY.fields, T.StructField("ingest_day", T.DateType())])
    assert LandedFiles(f"{scratch}/out", day, by=("ingest_day",)).read(spark).count() == 9


def test_variants_land(spark, scratch, folder):
    run(spark, scratch, folder, "land-variant")
    assert spark.read.parquet(f"{scratch}/out").where("variant_get(record, '$.product_id', 'string') = 'p'").count() == 9


def test_facts_into_a_database_by_a_ledger(spark, scratch, folder, derby):
    for _ in range(2):
        argv = ["facts", "--messages", folder, "--tables", f"{scratch}/out", "--trigger", "available"]
        argv += ["--checkpoint", f"{scratch}/cp_once", "--jdbc-url", derby.url, "--exactly-once", "once", "--max-files", "1"]
        argv += ["--jdbc-types", "interaction_id varchar(40), feedback_id varchar(40)"]
        await_query(start(spark, parser().parse_args(argv)))
    assert read_table(spark, derby, "user_product_interactions").count() == 9
    assert read_table(spark, derby, "user_feedback").count() == 9
    assert read_table(spark, derby, "trolley_ledger").select("query_name").distinct().count() == 2
