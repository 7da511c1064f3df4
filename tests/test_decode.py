import json

import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from trolley.functions import compact_line, is_one_json, record_json, wire_timestamp
from trolley.operators import accepted, decode, drop_empty, rejected
from trolley.schemas import ACTIVITY, CURATED_PAYLOAD, USERS, narrowed

# payload, expected reason (None: accepted), expected fields of an accepted record
SHAPES = [
    ('{"user_id":"a","category_id":7,"annual_income":5}', None, ("a", "7", 5, False)),
    ("{bad", "malformed", None),
    (None, "empty", None),
    ("", "empty", None),
    ('{"user_id":"b","annual_income":"oops","created_at":"nope"}', None, ("b", None, None, True)),
    ('[{"user_id":"c"},{"user_id":"d"}]', "no key", None),
    ('{"user_id":"e","extra":1,"annual_income":12.0,"user_rating":3}', None, ("e", None, None, True)),
    ("{}", "no key", None),
    ("null", "no key", None),
    ('{"user_id":42,"annual_income":3000000000}', None, ("42", None, None, True)),
    ('{"user_id":"f"} trailing', None, ("f", None, None, False)),
    ('{"user_id":"g"', "malformed", None),
    ("5", "no key", None),
    ('"s"', "no key", None),
    ('{"user_id":""}', "no key", None),
]


def test_payload_shapes(inbox):
    decoded = decode(inbox([text for text, _, _ in SHAPES]))
    good = {
        r.ingest_offset: (r.user_id, r.category_id, r.annual_income, r.partial)
        for r in accepted(decoded).collect()
    }
    bad = {r.ingest_offset: (r.reason, r.raw_value) for r in rejected(decoded).collect()}
    for offset, (text, reason, fields) in enumerate(SHAPES):
        if reason is None:
            assert good.pop(offset) == fields, text
        else:
            assert bad.pop(offset) == (reason, text), text
    assert not good and not bad


def test_number_widens_to_double(inbox):
    row = accepted(decode(inbox(['{"user_id":"a","user_rating":3}']))).first()
    assert row.user_rating == 3.0


def test_array_messages(inbox):
    payloads = [
        '[{"user_id":"a"},{"user_id":"b","annual_income":"oops"}]',
        '{"user_id":"c"}',
        ' [ {"user_id":"d"}, 5, {"no":"key"}, null ] ',
        '[{"user_id":"e"},{"user_id":',
        "[]",
    ]
    decoded = decode(inbox(payloads), narrowed("annual_income"), batched=True)
    good = sorted(
        (r.ingest_offset, r.ingest_item, r.user_id, r.partial) for r in accepted(decoded).collect()
    )
    assert good == [(0, 0, "a", False), (0, 1, "b", True), (1, None, "c", False), (2, 0, "d", False)]
    bad = sorted(
        (r.ingest_offset, -1 if r.ingest_item is None else r.ingest_item, r.reason, r.raw_value)
        for r in rejected(decoded).collect()
    )
    assert bad == [
        (2, 1, "no key", "5"),
        (2, 2, "no key", '{"no":"key"}'),
        (2, 3, "empty", None),
        (3, -1, "malformed", payloads[3]),
        (4, -1, "no key", "[]"),
    ]


def test_wire_timestamps_do_not_depend_on_the_session_zone(spark, inbox):
    rows = inbox(['{"user_id":"a","created_at":"2024-03-10 02:30:00"}'])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        seconds = decode(rows).select(F.unix_seconds("created_at")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seconds == 1710037800


def test_text_is_parsed_once(inbox):
    good = accepted(decode(inbox(['{"user_id":"a"}']), CURATED_PAYLOAD)).select("user_id", "email")
    assert plan_of(good).count("from_json(") == 1


def test_narrow_schema():
    assert narrowed("email").fieldNames() == ["email", "user_id"]
    with pytest.raises(ValueError):
        narrowed("shoe_size")
    assert len(ACTIVITY) == 38 and len(USERS) == 20 and len(CURATED_PAYLOAD) == 26
    assert "credit_card_number" not in CURATED_PAYLOAD.fieldNames()


def test_drop_empty(inbox):
    assert drop_empty(inbox([None, "", "{}", "x"])).count() == 2


@pytest.mark.parametrize(
    "text, single",
    [
        ('{"a":1}', True),
        ("[1,2]", True),
        ("null", True),
        ('{"a":1} trailing', False),
        ('{"a":1}{"b":2}', False),
        ('{"a":1},{"b":2}', False),
        ("1],[2", False),
        ('1},{"x":2', False),
        ("{bad", False),
        ("", False),
        (None, False),
    ],
)
def test_is_one_json(spark, text, single):
    df = spark.createDataFrame([(text,)], "t string").select(is_one_json(F.col("t")))
    assert df.first()[0] is single


def test_record_text(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, TIMESTAMP '2024-05-06 07:08:09.123' AS c")
    assert json.loads(df.select(record_json()).first()[0]) == {
        "a": 1,
        "b": None,
        "c": "2024-05-06 07:08:09",
    }
    assert df.select(wire_timestamp("c")).first()[0] == "2024-05-06 07:08:09"
    assert df.select(wire_timestamp(F.lit(None).cast("timestamp"))).first()[0] is None


def test_compact_line(spark):
    text = '{\n  "a": "x\\ny"\r\n}'
    line = spark.createDataFrame([(text,)], "t string").select(compact_line(F.col("t"))).first()[0]
    assert "\n" not in line and "\r" not in line and json.loads(line) == json.loads(text)
