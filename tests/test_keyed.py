from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meetlake.operators import keyed, reads
from meetlake.operators.lookup import lookup
from meetlake.operators.hosts import host_of_event
from meetlake.plans.event_details import held_back, upsert_either
from meetlake.site import Site

SCHEMA = "id bigint, k string, v int, w string"


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame(
        [(1, "a", 1, "x"), (2, "b", None, "y"), (3, "c", 3, None)], SCHEMA
    )


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(
        [("b", 20, None), ("c", None, "z"), ("d", 40, "n"), ("e", None, None)],
        "k string, v int, w string",
    )


@pytest.mark.parametrize("small", [True, False])
def test_rules(stored, batch, small):
    merged = keyed.upsert(
        stored, batch, ["k"], {"id": keyed.keep, "v": keyed.fill}, small_batch=small
    )
    assert rows(merged, "k") == [
        (1, "a", 1, "x"), (2, "b", 20, None), (3, "c", 3, "z"), (None, "d", 40, "n"),
        (None, "e", None, None),
    ]
    only = keyed.upsert(
        stored, batch, ["k"], {}, default=keyed.keep, insert=False, small_batch=small
    )
    assert rows(only, "k") == rows(stored, "k")


def test_new_ids_are_dense_and_the_same_each_time(spark, stored):
    batch = spark.range(500).select(F.concat(F.lit("n"), "id").alias("k"))
    both = batch.unionByName(stored.select("k"))
    first = keyed.with_new_ids(both, stored, ["k"])
    ids = sorted(r.id for r in first.collect() if r.id is not None)
    assert ids == list(range(4, 504))
    again = keyed.with_new_ids(both.repartition(7), stored, ["k"])
    assert rows(first, "k") == rows(again, "k")
    assert first.filter("id is null").count() == 3


def test_last_per_key(spark):
    frame = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 1, 2, None), ("b", 5, 0, "z")], "k string, t int, p int, v string"
    )
    assert rows(keyed.last_per_key(frame, ["k"], ["t", "p"]), "k") == [
        ("a", 1, 2, None), ("b", 5, 0, "z"),
    ]


def test_either_key(spark):
    stored = spark.createDataFrame(
        [(1, "e1", "u1", "s"), (2, "e2", "u2", "s"), (3, "e3", "", "s")],
        "id bigint, key string, url string, name string",
    )
    batch = spark.createDataFrame(
        [
            ("e2", "u1", "both", 1),  # would give row 1 the key of row 2: held back
            ("x9", "u2", "by url", 2),  # the key text changes
            ("e3", "", "empty url meets no url", 3),
            ("e8", "u8", "new", 4),
            ("e9", "", "new", 5),
        ],
        "key string, url string, name string, seq int",
    )
    merged = upsert_either(stored, batch, "key", "url", ["seq"], {})
    assert [r.key for r in held_back(batch, stored, "key", "url").collect()] == ["e2"]
    got = rows(merged, "id")
    assert got[:3] == [
        (1, "e1", "u1", "s"), (2, "x9", "u2", "by url"), (3, "e3", "", "empty url meets no url"),
    ]
    assert sorted(r[1] for r in got[3:]) == ["e8", "e9"] and {r[0] for r in got[3:]} == {4, 5}


def test_lookup_of_a_hot_key_is_whole(spark):
    left = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k")
    )
    table = spark.range(3000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("found"),
    )
    for how in ("left", "inner"):
        plain = left.join(table, "k", how).select("id", "k", "found")
        salted = lookup(left, table, "k", how, hot_rows=100, table_is_small=False, rows_are_small=False)
        assert rows(salted.select("id", "k", "found"), "id") == rows(plain, "id")
    parts = (
        lookup(left, table, "k", hot_rows=100, table_is_small=False, rows_are_small=False)
        ._jdf.queryExecution().optimizedPlan().toString()
    )
    assert "_salt" in parts and "approx_top_k" in parts


def test_equal_rows_of_a_hot_key_are_spread(spark):
    rows = spark.range(20_000).select(
        F.lit("hot").alias("k"), (F.col("id") % 3).alias("v"), F.create_map(F.lit("a"), F.lit(1)).alias("m")
    )
    table = spark.createDataFrame([("hot", 1)], "k string, found int")
    joined = lookup(rows, table, "k", "left", hot_rows=100, table_is_small=False, rows_are_small=False)
    assert joined.filter("found = 1").count() == 20_000
    salts = rows.select(F.pmod(F.monotonically_increasing_id(), F.lit(64))).distinct().count()
    assert salts == 64


def test_a_page_does_not_shuffle_the_parents(spark):
    athletes = spark.range(500).select(
        "id", F.col("id").cast("string").alias("external_id"), F.lit("N").alias("country_code"),
        (F.col("id") % 50).cast("string").alias("academy_external_id"), F.col("id").alias("total_wins"),
    )
    academies = spark.range(100).select("id", F.col("id").cast("string").alias("external_id"), F.lit("n").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = reads.with_academy_of_few(athletes.limit(5), academies)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert all(r.academy.name == "n" for r in few.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bad", [(0, 20), (1, 0), (1, 101)])
def test_pages_out_of_bounds_are_refused(bad):
    with pytest.raises(ValueError):
        reads.Paging(*bad)
    with pytest.raises(ValueError):
        reads.EnrichmentBatch(201)


@pytest.mark.parametrize(("rows_left", "sample"), [(50_000, 4000), (60, 40), (300, 8)])
def test_deep_slice_equals_top_k(spark, monkeypatch, rows_left, sample):
    monkeypatch.setattr(reads, "SELECT_ROWS", rows_left)
    monkeypatch.setattr(reads, "SAMPLE_ROWS", sample)
    v = F.when(F.col("id") % 11 > 0, F.col("id") % 7)
    frame = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 3).otherwise(v).alias("v"))
    for by in (["-v", "id"], ["v", "-id"]):
        whole = [tuple(r) for r in frame.orderBy(*reads.in_order(by)).collect()]
        for offset, limit in ((0, 5), (2113, 100), (4990, 50), (6000, 10)):
            deep = [tuple(r) for r in reads.deep_slice(frame, by, offset, limit).collect()]
            assert deep == whole[offset : offset + limit]


def test_rows_after_a_row(spark):
    frame = spark.range(300).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("v"))
    for by in (["-v", "id"], ["v", "-id"]):
        whole = frame.orderBy(*reads.in_order(by)).collect()
        seen, last = whole[:7], whole[6]
        while len(page := reads.rows_after(frame, by, last.asDict(), 50).collect()):
            seen, last = seen + page, page[-1]
        assert seen == whole


def test_a_deep_slice_sorts_no_table(spark, monkeypatch):
    monkeypatch.setattr(reads, "SELECT_ROWS", 500)
    frame = spark.range(40_000).select("id", (F.col("id") % 7).alias("v"))
    page = reads.deep_slice(frame, ["-v", "id"], 30_000, 20)
    plan = page._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and page.count() == 20


def test_pages_cover_the_table(spark):
    frame = spark.range(95).select("id", (F.col("id") % 4).cast("int").alias("total_wins"))
    seen = []
    for page in range(1, 7):
        seen += [r.id for r in reads.page_of(frame, "total_wins", reads.Paging(page, 20)).collect()]
    assert len(seen) == 95 and len(set(seen)) == 95


def test_hosts(spark):
    probes = spark.createDataFrame(
        [
            ("1", "adcc.example.com", 200, None),
            ("1", "example.com", 404, None),
            ("2", "ajp.example.com", 200, None),
            ("2", "ibjjf.example.com", 302, "https://ibjjf.example.com"),
            ("3", "example.com", 301, "https://example.com/en"),  # neither first nor last
            ("4", "other.test", 200, None),
        ],
        "event_id string, host string, status int, location string",
    )
    assert rows(host_of_event(probes, Site()), "event_id") == [
        ("1", "adcc.example.com"), ("2", "ibjjf.example.com"), ("3", "example.com"),
        ("4", "example.com"),
    ]
