"""Whatever arrives is landed or rejected, and no landed row is empty."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from trolley.operators import decode, partials, rejected
from trolley.schemas import METRICS, QUARANTINE, narrowed
from trolley.sinks import BatchFolders
from trolley.streaming import Targets, await_query, backfill, fan_out, land_json, land_parquet, land_rejects
from trolley.sources import message_files

OBJECTS = [
    '{"user_id":"u","product_id":"p"}',
    '{"product_id":"p"}',
    '\n{"product_id":"p"}',
    '\t\r\n {"user_id":"v"}',
    '{\n "user_id": "w"\n}',
    '{"user_id":"x"} trailing text',
]
OTHER_JSON = ["5", '"s"', "null", "true", '[{"user_id":"y"}]', "[]"]
BROKEN = [
    '{"user_id":"a\nb"}',
    '{"user_id":"a\tb"}',
    '{"user_id":"a\x01b"}',
    "{'user_id':'x'}",
    '{"user_id":"x"',
    "{bad",
    "1],[2",
    "1,2",
    "  ",
]
ALL = [*OBJECTS, *OTHER_JSON, *BROKEN, "", None]


@pytest.fixture
def folder(scratch, inbox):
    path = f"{scratch}/messages"
    inbox(ALL).write.parquet(path)
    return path


def drained(spark, folder, scratch, start, label, **options):
    out = f"{scratch}/{label}"
    await_query(
        start(message_files(spark, folder), out, f"{scratch}/cp_{label}", trigger={"availableNow": True}, **options)
    )
    return out


@pytest.mark.parametrize("batched", [False, True])
def test_fields(spark, scratch, folder, batched):
    landed = spark.read.parquet(drained(spark, folder, scratch, land_parquet, "landed", batched=batched))
    rejects = spark.read.parquet(
        drained(spark, folder, scratch, land_rejects, "rejects", keep="fields", batched=batched)
    )
    assert landed.count() + rejects.count() == len(ALL)
    assert landed.count() == len(OBJECTS) + batched  # the array's element is a record of its own
    assert landed.where(" AND ".join(f"{name} IS NULL" for name in landed.columns)).count() == 0
    reasons = {r.ingest_offset: r.reason for r in rejects.collect()}
    for i, text in enumerate(ALL):
        if text in BROKEN:
            assert reasons[i] == "malformed", text
        elif not text:
            assert reasons[i] == "empty"
        elif text in OTHER_JSON and i in reasons:
            assert reasons[i] == "no key", text


def test_payload(spark, scratch, folder):
    lines = spark.read.text(drained(spark, folder, scratch, land_json, "lines")).collect()
    rejects = spark.read.parquet(drained(spark, folder, scratch, land_rejects, "rejects", keep="payload"))
    whole = [text for text in [*OBJECTS, *OTHER_JSON] if "trailing" not in text]
    assert sorted(json.dumps(json.loads(r.value)) for r in lines) == sorted(json.dumps(json.loads(t)) for t in whole)
    assert rejects.count() == len(ALL) - len(whole)


def test_partial_texts(inbox):
    decoded = decode(inbox(['{"user_id":"a","session_duration":"x"}', '{"user_id":"b"}', "{bad"]), narrowed("session_duration"))
    (row,) = partials(decoded).collect()
    assert (row.raw_value, row.reason, row.ingest_offset) == ('{"user_id":"a","session_duration":"x"}', "partial", 0)
    assert rejected(decoded).count() == 1


def test_partial_target_and_metric(spark, scratch, inbox):
    targets = Targets(
        partial=BatchFolders(f"{scratch}/partial", QUARANTINE), metrics=BatchFolders(f"{scratch}/metrics", METRICS)
    )
    counts = backfill(inbox(['{"user_id":"a","session_duration":"x"}', '{"user_id":"b"}']), targets)
    assert counts == {"partial": 1} and targets.partial.read(spark).count() == 1


def test_metrics_of_failed_attempts_add_up(spark, scratch, inbox):
    """The second table fails twice after the first was filled."""
    failures = [2]

    def write(rows, batch_id):
        if failures[0]:
            failures[0] -= 1
            raise RuntimeError("sink is down")

    kept = BatchFolders(f"{scratch}/kept", QUARANTINE)
    metrics = BatchFolders(f"{scratch}/metrics", METRICS)
    failing = SimpleNamespace(create=lambda s: None, stored=lambda *a: None, write=write)
    seen = []
    first = SimpleNamespace(
        create=kept.create,
        # appended to: rows that are stored already are not written again
        stored=lambda spark, key, days: kept.read(spark).select(key),
        write=lambda rows, batch_id: (seen.append(1), kept.write(rows, len(seen))),
    )
    targets = Targets(quarantine=first, partial=failing, metrics=metrics)
    targets.create(spark)
    decoded = decode(inbox(["{bad", '{"user_id":"a","session_duration":"x"}']), narrowed("session_duration"))
    for _ in range(2):
        with pytest.raises(RuntimeError):
            fan_out(decoded, 7, targets)
    failing.write = lambda rows, batch_id: rows.count()
    try:
        fan_out(decoded, 7, targets)
    except KeyError:
        pass  # the stand-in does not run the observed rows to the end
    total = metrics.read(spark).where("table_name = 'quarantine'").agg(F.sum("n_rows")).first()[0]
    assert total == kept.read(spark).count() == 1
