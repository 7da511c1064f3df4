"""Batches that a database takes once, and ranges of its keys."""

import pytest
from pyspark.sql import types as T

from trolley.schemas import INTERACTIONS, USERS
from trolley.sinks import JdbcTable, LedgerTable
from trolley.sinks.ledger import transaction
from trolley.sources import even_starts, key_ranges, read_query, read_table
from trolley.streaming import Targets, backfill

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture
def facts(spark, derby):
    table = LedgerTable(JdbcTable(derby, "facts", SCHEMA, column_types="id varchar(64)"), "q", "id")
    table.create(spark)
    table.create(spark)  # there is one already
    return table


def batch(spark, *ids):
    return spark.createDataFrame([(i, ord(i[0])) for i in ids], SCHEMA).repartition(3)


def held(spark, facts):
    return sorted(r.id for r in facts.read(spark).collect())


def test_a_batch_is_taken_once(spark, facts):
    facts.write(batch(spark, "a", "b", "c"), 0)
    facts.write(batch(spark, "a", "b", "c"), 0)
    assert held(spark, facts) == ["a", "b", "c"] and facts.done(spark, 0) and not facts.done(spark, 1)
    facts.write(batch(spark, "d"), 1)
    other = LedgerTable(facts.table, "another's", "id")
    other.write(batch(spark, "e"), 1)
    assert held(spark, facts) == ["a", "b", "c", "d", "e"]
    facts.write(spark.createDataFrame([], SCHEMA), 2)
    assert facts.done(spark, 2)


def test_a_task_that_commits_twice_leaves_single_rows(spark, facts, monkeypatch):
    replace, times = JdbcTable.replace, []

    def doubled(table, rows, name):
        times.append(name)
        replace(table, rows.unionByName(rows) if len(times) == 1 else rows, name)

    monkeypatch.setattr(JdbcTable, "replace", doubled)
    facts.write(batch(spark, "a", "b"), 0)
    assert held(spark, facts) == ["a", "b"] and len(times) == 2
    monkeypatch.setattr(JdbcTable, "replace", lambda table, rows, name: replace(table, rows.unionByName(rows), name))
    with pytest.raises(ValueError, match="4 staged rows have 2 different id"):
        facts.write(batch(spark, "c", "d"), 1)
    assert held(spark, facts) == ["a", "b"]


def test_a_writer_that_dies_leaves_all_or_nothing(spark, facts, derby, monkeypatch):
    with pytest.raises(RuntimeError):
        with transaction(spark, derby) as run:
            run("INSERT INTO facts VALUES ('x', 1)")
            raise RuntimeError("killed")
    assert held(spark, facts) == []
    with monkeypatch.context() as patch:  # before the transaction: the staging table stays
        patch.setattr("trolley.sinks.ledger.transaction", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            facts.write(batch(spark, "a"), 0)
    assert held(spark, facts) == []
    facts.write(batch(spark, "a"), 0)
    assert held(spark, facts) == ["a"]
    with transaction(spark, derby) as run:  # of two writers of a batch the ledger takes one
        with pytest.raises(Exception, match="duplicate key"):
            run("INSERT INTO trolley_ledger VALUES ('q', 0)")


def test_a_batch_that_runs_again_after_its_commit(spark, derby, inbox):
    """Facts and users of a batch whose checkpoint was not written: nothing doubles, nothing waits."""
    facts = LedgerTable(JdbcTable(derby, "interactions", INTERACTIONS), "q", "interaction_id")
    users = LedgerTable(JdbcTable(derby, "users", USERS), "q users", "user_id", lookup=True)
    targets = Targets(users=users, interactions=facts)
    messages = inbox(['{"user_id":"a"}', '{"user_id":"b"}', '{"user_id":"a"}'])
    assert backfill(messages, targets, batch_id=3) == {"users": 2, "user_product_interactions": 3}
    assert backfill(messages, targets, batch_id=3) == {"users": 0, "user_product_interactions": 0}
    more = inbox(['{"user_id":"b"}', '{"user_id":"c"}'], first=3)
    assert backfill(more, targets, batch_id=4) == {"users": 1, "user_product_interactions": 2}
    assert (users.read(spark).count(), facts.read(spark).count()) == (3, 5)
    plain = Targets(interactions=JdbcTable(derby, "plain", INTERACTIONS))
    assert [backfill(messages, plain)["user_product_interactions"] for _ in range(2)] == [3, 0]
    with pytest.raises(ValueError, match="lookup"):
        Targets(users=LedgerTable(users.table, "q", "user_id"))


@pytest.mark.parametrize("alphabet", ["hex", "words", "few"])
def test_ranges_are_even_whatever_the_alphabet(spark, derby, alphabet):
    make = {
        "hex": lambda i: f"{i * 2654435761 % 2**32:08x}",
        "words": lambda i: ("straße-" if i % 20 else "it's ") + str(i),
        "few": lambda i: f"key{i % 3}",
    }[alphabet]
    keys = [(make(i),) for i in range(400)]
    table = JdbcTable(derby, "keys_", T.StructType([T.StructField("key_id", T.StringType())]))
    table.write(spark.createDataFrame(keys, table.schema).coalesce(2))
    with transaction(spark, derby) as run:
        for _ in range(5):
            run("INSERT INTO keys_ VALUES (NULL)")
    starts = even_starts(spark, derby, "keys_", "key_id", 8)
    ranges = key_ranges(derby, "key_id", starts)
    split = read_table(spark, derby, "keys_", predicates=ranges)
    sizes = [len(rows) for rows in split.rdd.glom().collect()]
    assert sum(sizes) == 405 and len(sizes) == len(ranges)
    if alphabet != "few":
        assert len(sizes) == 8 and max(sizes) <= 2 * 405 / 8
    else:
        assert len(sizes) <= 4 and max(sizes) <= 140
    assert even_starts(spark, derby, "(SELECT * FROM keys_ WHERE 1 = 0) AS none_", "key_id") == []
    assert read_query(spark, derby, "SELECT COUNT(*) AS n FROM keys_").first()[0] == 405
