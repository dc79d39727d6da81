"""Merges stated once: as clauses for a catalog's MERGE, and a whole batch through such a sink."""

from __future__ import annotations

import pytest
import test_ingest
from pyspark.sql import functions as F

from meetlake.operators import hosts
from meetlake.plans import academies, event_athletes, event_details, listings, profiles
from meetlake.plans.ingest import ingest
from meetlake.session import staged
from meetlake.sources.schemas import ENTITY_TABLES
from meetlake.sources.sinks import CatalogSink
from meetlake.sources.store import Store

MERGES = {
    "academies": academies.how,
    "events": listings.how,
    "athletes": event_athletes.how_athletes,
    "people": event_athletes.how_people,
    "registrations": event_athletes.how_registrations,
    "profiles": lambda now: profiles.HOW,
    "details": event_details.how,
    "hosts": lambda now: hosts.HOW,
}


def now():
    return F.lit("2026-03-01").cast("timestamp")


class Clause:
    def __init__(self, writer, kind):
        self.writer, self.kind = writer, kind

    def _set(self, assignments):
        self.writer.clauses[self.kind] = assignments
        return self.writer

    update = insert = _set


class Merging:
    """MERGE as a catalog would run it: matched rows, rows without a match, all others."""

    def __init__(self, given, target, same):
        self.given, self.target, self.same, self.clauses = given, target, same, {}

    def whenMatched(self):
        return Clause(self, "update")

    def whenNotMatched(self):
        return Clause(self, "insert")

    def merge(self):
        stored = self.given.sparkSession.table(self.target)
        both = stored.withColumn("_t", F.lit(True)).join(
            self.given.withColumn("_g", F.lit(True)), self.same, "full_outer"
        )
        both = both.filter("_t OR _g" if "insert" in self.clauses else "_t")
        update, insert = self.clauses["update"], self.clauses.get("insert", {})

        def value(c):
            old = F.col(f"{self.target}.{c}")
            now = F.when(F.col("_t") & F.col("_g"), update.get(c, old))
            return now.when(F.col("_g"), insert.get(c, F.lit(None))).otherwise(old).alias(c)

        rows = staged(both.select(*map(value, stored.columns)), "merged")
        rows.write.insertInto(self.target, overwrite=True)


@pytest.mark.parametrize("name", MERGES)
def test_clauses_cover_the_table(spark, name):
    how = MERGES[name](now())
    stored = spark.createDataFrame([], ENTITY_TABLES[how.table])
    given = stored.drop("created_at")
    update, insert = how.clauses(stored, given, "t", "given")
    assert set(update) == set(stored.columns) - set(how.keys)
    assert set(insert) == set(stored.columns)
    # the clauses on a stored row and on none
    joined = stored.alias("t").join(given.alias("given"), list(how.keys)[0], "full_outer")
    for clause in (update, insert):
        kinds = dict(joined.select(*[c.alias(n) for n, c in clause.items()]).dtypes)
        assert kinds == {n: k for n, k in stored.dtypes if n in clause}


def test_rules_in_clauses(spark):
    how = event_athletes.how_athletes(now())
    columns = "external_id", "full_name", "belt_rank", "total_wins", "academy_external_id", "id"
    schema = "external_id string, full_name string, belt_rank string, total_wins bigint, academy_external_id string, id bigint"
    stored = spark.createDataFrame([("1", "old", "Blue", 7, "9", 5)], schema)
    given = spark.createDataFrame([("1", "new", None, None, None, None)], schema)
    update, insert = how.clauses(stored, given, "t", "given")
    both = stored.alias("t").crossJoin(given.alias("given"))
    got = both.select(*[update[c].alias(c) for c in columns[1:]]).first()
    assert tuple(got) == ("new", "Blue", 7, "9", 5)
    got = both.select(*[insert[c].alias(c) for c in columns]).first()
    assert tuple(got) == ("1", "new", "", 0, "", None)


def test_a_batch_into_a_catalog(spark, tmp_path, monkeypatch):
    """Through the clauses of a catalog's MERGE come the tables the parquet store has."""
    batch = test_ingest.first_batch(spark)
    monkeypatch.setattr(type(batch), "mergeInto", lambda given, target, same: Merging(given, target, same))
    spark.sql(f"CREATE DATABASE lake LOCATION '{tmp_path}/lake'")
    try:
        for name in test_ingest.TABLES:
            spark.createDataFrame([], ENTITY_TABLES[name]).write.saveAsTable(f"lake.{name}")
        into = Store(spark, f"{tmp_path}/parts", sink=CatalogSink(spark, "lake"))
        assert ingest(into, batch, test_ingest.SITE, "one", test_ingest.NOW)
        plain = Store(spark, f"{tmp_path}/plain")
        ingest(plain, batch, test_ingest.SITE, "one", test_ingest.NOW)
        for name in test_ingest.TABLES:
            assert test_ingest.comparable(into, name) == test_ingest.comparable(plain, name), name
        assert into.read("runs").count() == plain.read("runs").count()
    finally:
        spark.sql("DROP DATABASE lake CASCADE")
