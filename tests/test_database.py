"""Where the queries that need a database may run."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from trolley.plans import stored_queries
from trolley.plans.stored_queries import URL_SETTING, _database, jdbc_exactly_once


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: conf.get(name, default)),
        sparkContext=SimpleNamespace(master=master),
    )


@pytest.mark.parametrize("master", ["local-cluster[3,4,1024]", "spark://host:7077", "yarn"])
def test_executors_need_a_database_they_can_reach(master):
    with pytest.raises(ValueError, match=URL_SETTING):
        _database(session(master))
    assert _database(session(master, **{URL_SETTING: "jdbc:mysql://db/shop"})).url == "jdbc:mysql://db/shop"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_one_process_has_its_own(master):
    assert _database(session(master)).url.startswith("jdbc:derby:memory:")


def test_a_lasting_ledger_does_not_empty_the_next_run(spark, scratch, monkeypatch):
    entered = set()  # by the ledger of a database that outlives the query, in whose place this stands

    class Ledger:
        def __init__(self, table, query, key):
            self.schema, self.query, self.held = table.schema, query, []

        def create(self, spark):
            self.held.append(spark.createDataFrame([], self.schema))

        def write(self, rows, batch_id):
            if (self.query, batch_id) not in entered:
                entered.add((self.query, batch_id))
                self.held.append(rows.select(*self.schema.fieldNames()))

        def read(self, spark):
            empty, *batches = self.held
            for rows in batches:
                empty = empty.unionByName(rows)
            return empty

    events = spark.range(6).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 2).alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{scratch}/events.parquet")
    monkeypatch.setattr(stored_queries, "LedgerTable", Ledger)
    assert [jdbc_exactly_once(spark, scratch).count() for _ in range(2)] == [6, 6]
