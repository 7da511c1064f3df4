import hashlib

import pytest
from pyspark.sql import functions as F

from trolley.operators import accepted, decode, drop_replays, feedback, interactions, users
from trolley.schemas import FEEDBACK, INTERACTIONS, USERS

PAYLOAD = (
    '{"user_id":"u1","product_id":"p1","category_id":3,"session_duration":9,"feedback":"fine",'
    '"user_rating":4.5,"timestamp":"2024-01-02 03:04:05","created_at":"2023-01-01 00:00:00"}'
)


@pytest.fixture
def records(inbox):
    return accepted(decode(inbox([PAYLOAD, PAYLOAD], first=5)))


def test_columns_and_order(records):
    assert [(f.name, f.dataType) for f in users(records).schema] == [
        (f.name, f.dataType) for f in USERS
    ]
    assert [(f.name, f.dataType) for f in interactions(records).schema] == [
        (f.name, f.dataType) for f in INTERACTIONS
    ]
    assert [(f.name, f.dataType) for f in feedback(records).schema] == [
        (f.name, f.dataType) for f in FEEDBACK
    ]


def test_renames(records):
    assert str(users(records).first().registration_date) == "2023-01-01 00:00:00"
    fact = feedback(records).first()
    assert (fact.rating, fact.feedback) == (4.5, "fine")


def test_clocks(records):
    by_event = interactions(records).select(F.col("interaction_date").cast("string")).first()[0]
    by_receipt = feedback(records, clock="ingest").select(F.unix_seconds("feedback_date")).first()[0]
    assert by_event == "2024-01-02 03:04:05"
    assert by_receipt == 1_700_000_005
    with pytest.raises(ValueError):
        interactions(records, clock="wall")


def test_ids_name_the_message(records):
    ids = sorted(r.interaction_id for r in interactions(records).collect())
    expected = [
        hashlib.md5(f"user-activity|0|{offset}|interaction".encode()).hexdigest() for offset in (5, 6)
    ]
    assert ids == sorted(expected)
    assert not set(ids) & {r.feedback_id for r in feedback(records).collect()}


def test_ids_of_array_items_differ(inbox):
    sent = inbox(['[{"user_id":"a"},{"user_id":"a"}]', '{"user_id":"a"}'])
    facts = interactions(accepted(decode(sent, batched=True)))
    assert facts.select("interaction_id").distinct().count() == 3


def test_replays_collapse_but_not_the_batch(inbox):
    sent = inbox([PAYLOAD] * 10)
    facts = interactions(accepted(decode(sent.unionByName(sent))))
    kept = drop_replays(facts, "interaction_id")
    assert facts.count() == 20 and kept.count() == 10
