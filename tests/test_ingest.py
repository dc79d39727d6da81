"""Whole batches into a store: upsert rules, repeats, atomic batches, streams."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import os
import threading

import pandas as pd
import pytest
from golden import (
    ACADEMY, BASE, EVENTS, LD, PROFILE, T0, capture, captures, event_page, group, listing,
    participants, registration,
)
from pyspark.sql import functions as F
import json
import random

from meetlake import Site, session
from meetlake.operators import reads, runs
from meetlake.plans import event_athletes, event_details, listings, profiles, stamps
from meetlake.plans.ingest import ingest
from meetlake.sources import payloads
from meetlake.sources.schemas import ENTITY_TABLES
from meetlake.sources.store import APPENDED, Store
from meetlake.streaming import jobs

SITE = Site()
NOW = datetime(2026, 2, 1, tzinfo=timezone.utc)
LATER = NOW + timedelta(days=1)
GROUP = "Men / Adults / Beginner / -60 kg"
URL = f"{BASE}/en/event/7/participants"


def first_batch(spark):
    club = "Gracie / São 1"
    return captures(
        spark,
        capture("academy_list", f"{BASE}/en/club", "<a href='/en/club/9'>x</a>", country="BR"),
        capture("academy", f"{BASE}/en/club/9", ACADEMY),
        capture("event_list", f"{BASE}/en/events/upcoming", listing(EVENTS)),
        capture("event", f"{BASE}/en/event/7", event_page(json.dumps(LD))),
        capture(
            "participants",
            URL,
            participants(
                group(GROUP, registration(1, clubName=club, age=20), registration(2)),
                group(GROUP, registration(1, clubName="", age=21, seed_position=4)),
                group("Men / Masters / x / -70 kg", registration(1, clubName="", age=22)),
            ),
        ),
        capture("participants", URL + "?bad", participants(group(5))),
        capture("profile", f"{BASE}/en/profile/1", PROFILE),
        capture("profile", f"{BASE}/en/profile/99", PROFILE),
        capture(
            "profile_events",
            f"{BASE}/en/profile/1/events",
            {
                "data": [{"registrations": [{"matches": [{"is_winner": True, "outcome": "DQ"}] * 9}]}],
                "next_page_url": None,
            },
        ),
        capture("profile_events", f"{BASE}/en/profile/2/events", "oops", status=503),
        capture("event", f"{BASE}/en/event/8", "gone", status=404),
    )


def table(store, name):
    return {r.external_id: r for r in store.read(name).collect()}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    assert ingest(store, first_batch(spark), SITE, "one", NOW)
    return store


def test_first_batch(store):
    athletes = table(store, "athletes")
    one, two = athletes["1"], athletes["2"]
    assert set(athletes) == {"1", "2"}
    assert {one.id, two.id} == {1, 2}
    assert one.age == 22 and one.academy_external_id == "9"  # last row with a club
    assert two.academy_external_id == "" and two.belt_rank == "" and two.total_wins == 0
    assert one.belt_rank == "Purple belt"
    # the tally goes over the page where it is above 0
    assert (one.total_wins, one.wins_by_dq, one.wins_by_submission) == (9, 9, 3)
    regs = store.read("event_registrations").filter(F.col("athlete_id") == one.id)
    assert sorted((r.rank, r.seed) for r in regs.collect()) == [("Beginner", 4), ("x", 0)]
    assert {r.external_id for r in store.read("events").collect()} == {"11", "12"}
    assert store.read("event_details").first().location_city == "Rio"
    assert table(store, "academies")["9"].country_code == "BR"
    refused = {(r.kind, r.fault.split()[0]) for r in store.read("quarantine").collect()}
    assert refused == {
        ("participants", "payload"), ("profile_events", "status"), ("event", "status"),
        ("profile", "the"),  # of an athlete that is not stored
    }


def test_run_log_and_status(store):
    current = runs.current_runs(store.read("runs"))
    got = {r.job_type: (r.status, r.items_scraped) for r in current.collect()}
    assert got == {
        "all": ("completed", 0), "academies": ("completed", 1), "athletes": ("completed", 0),
        "events_upcoming": ("completed", 2),
    }
    row = reads.status(store.read("academies"), store.read("athletes"), current).first()
    assert (row.total_academies, row.total_athletes) == (1, 2) and row.last_run is not None


def test_reads_on_the_store(store):
    athletes, academies = store.read("athletes"), store.read("academies")
    page = reads.athletes_page(athletes, academies, country="BR")
    assert [(r.external_id, r.academy and r.academy.name) for r in page.collect()] == [
        ("1", "Gracie / São 1"), ("2", None),
    ]
    answer = json.loads(
        reads.envelope(page, reads.matching(athletes, country_code="BR"), "athletes", reads.Paging())
        .first().json
    )
    assert answer["success"] and answer["data"]["total"] == 2
    assert [a["external_id"] for a in answer["data"]["athletes"]] == ["1", "2"]
    rows = reads.academy_with_athletes(academies, athletes, "9").collect()
    assert [r.athlete.external_id for r in rows] == ["1"]
    (lone,) = reads.academy_with_athletes(academies, athletes.limit(0), "9").collect()
    assert lone.name == "Gracie / São 1" and lone.athlete is None
    assert reads.academy_with_athletes(academies, athletes, "0").collect() == []
    one = json.loads(reads.answer(reads.first_by(athletes, "external_id", "2"), "athlete").first().json)
    assert one["success"] and one["data"]["external_id"] == "2"
    none = json.loads(reads.answer(reads.first_by(athletes, "external_id", "0"), "athlete").first().json)
    assert none == {"success": False, "error": "Athlete not found"}
    assert [r.external_id for r in reads.enrichment_batch(athletes).collect()] == ["2"]


def test_a_committed_batch_is_not_merged_again(spark, store):
    before = len(store._batches())
    assert not ingest(store, first_batch(spark), SITE, "one", LATER)
    assert len(store._batches()) == before


def test_a_failed_batch_is_logged_and_changes_nothing(spark, store):
    broken = first_batch(spark).drop("body")
    with pytest.raises(Exception):
        ingest(store, broken, SITE, "bad", NOW + timedelta(hours=1))
    failed = runs.current_runs(store.read("runs")).filter("status = 'failed'").collect()
    assert len(failed) == 1 and "body" in failed[0].error_message
    assert store.read("athletes").count() == 2 and not store.is_done("bad")


def test_an_open_batch_is_not_seen(spark, store):
    batch = store.begin("broken")
    batch.write("athletes", store.read("athletes").limit(0))
    assert store.read("athletes").count() == 2
    assert store.begin("broken").name == batch.name


def test_second_batch(spark, store):
    again = captures(
        spark,
        capture(
            "participants",
            URL,
            participants(
                group(GROUP, registration(1, clubName="Unknown", age=30), registration(3)),
            ),
            at=T0 + timedelta(days=1),
        ),
        capture("profile", f"{BASE}/en/profile/2", "<p>nothing</p>"),
    )
    before, old_regs = table(store, "athletes"), store.read("event_registrations").collect()
    assert ingest(store, again, SITE, "two", LATER)
    after = table(store, "athletes")
    one, two = after["1"], after["2"]
    assert one.id == before["1"].id and one.age == 30
    assert one.academy_external_id == ""  # an unknown club clears the link
    assert (one.belt_rank, one.total_wins) == ("Purple belt", 9)
    assert one.created_at == before["1"].created_at and one.scraped_at != before["1"].scraped_at
    assert two == before["2"]  # nothing known: left as it is
    assert after["3"].id == 3
    regs = {(r.athlete_id, r.rank): r for r in store.read("event_registrations").collect()}
    old = {(r.athlete_id, r.rank): r for r in old_regs}
    changed = regs[(one.id, "Beginner")]
    assert changed.id == old[(one.id, "Beginner")].id and changed.seed == 0
    assert changed.created_at == old[(one.id, "Beginner")].created_at
    assert regs[(one.id, "x")] == old[(one.id, "x")]
    assert len(regs) == len(old) + 1


def comparable(store, name):
    frame = store.read(name)
    keep = [c for c in frame.columns if c not in ("id", "athlete_id") and not c.endswith(("_at", "_date"))]
    return sorted(map(tuple, frame.select(keep).collect()), key=repr)


def test_stream_and_batch_give_the_same_tables(spark, store, tmp_path):
    first_batch(spark).write.parquet(str(tmp_path / "in"))
    streamed = Store(spark, str(tmp_path / "store"))
    for _ in range(2):  # the second run finds nothing new
        query = jobs.ingest_stream(
            jobs.capture_stream(spark, str(tmp_path / "in")), streamed, SITE, str(tmp_path / "state")
        )
        query.awaitTermination()
    whole = Store(spark, str(tmp_path / "whole"))
    ingest(whole, first_batch(spark), SITE, "one", NOW)
    for name in ("athletes", "academies", "events", "event_details", "event_registrations"):
        assert comparable(streamed, name) == comparable(whole, name)


def test_a_batch_cut_in_two_gives_the_same_rows(spark):
    clubs = spark.createDataFrame([(1, "9", "Club")], "id bigint, external_id string, name string")
    athletes = spark.createDataFrame([], ENTITY_TABLES["athletes"])
    regs = spark.createDataFrame([], ENTITY_TABLES["event_registrations"])
    early = capture(
        "participants",
        URL,
        participants(
            group(GROUP, registration(1, clubName="Club"), registration(2, clubName="?")),
            group("x", registration(1, clubName="", age=9)),
        ),
    )
    late = capture(
        "participants",
        URL,
        participants(
            group(GROUP, registration(1, clubName="", age=40), registration(2, clubName="Club")),
            group(GROUP, registration(3, seed_position=2)),
        ),
        at=T0 + timedelta(hours=1),
    )
    now = F.lit(NOW)

    def merged(stored, stored_regs, *rows):
        flat = event_athletes.flat_registrations(captures(spark, *rows), SITE)
        people = event_athletes.merge_athletes(flat, stored, clubs, now)
        return people, event_athletes.merge_registrations(flat, people, stored_regs, now)

    def content(people, entries):
        names = people.select("external_id", "age", "academy_external_id", "full_name", "id")
        rows = entries.join(names, F.col("athlete_id") == names.id)
        return (
            sorted(map(tuple, names.drop("id").collect())),
            sorted(map(tuple, rows.select("external_id", "division", "rank", "seed").collect())),
        )

    at_once = content(*merged(athletes, regs, late, early))
    in_turn = content(*merged(*merged(athletes, regs, early), late))
    assert at_once == in_turn
    assert [(r[0], r[1], r[2]) for r in at_once[0]] == [
        ("1", 40, "9"), ("2", 30, "9"), ("3", 30, ""),
    ]


def test_repeats_in_a_stream(spark, tmp_path):
    rows = [(f"u{i % 3}", T0 + timedelta(seconds=i)) for i in range(9)]
    spark.createDataFrame(rows, "url string, at timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, at timestamp").parquet(str(tmp_path / "in"))
    (
        jobs.without_repeats(stream, ["url"], "at")
        .writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def all_kinds(spark):
    """Captures of two owners of each kind, with pages that need each other."""
    club = "Gracie / São 1"
    won = {"is_winner": True, "outcome": "Submission"}

    def matches(n, next_url=None):
        return {
            "data": [{"registrations": [{"matches": [won] * n}]}], "next_page_url": next_url
        }

    late = T0 + timedelta(hours=2)
    path = f"{BASE}/en/profile/1/events"
    return [
        capture("academy_list", f"{BASE}/en/club", "<a href='/en/club/9'>x</a>", country="BR"),
        capture("academy", f"{BASE}/en/club/9", ACADEMY),
        capture("event_list", f"{BASE}/en/events/upcoming", listing(EVENTS)),
        capture("event", f"{BASE}/en/event/7?a=1", event_page(json.dumps(LD))),
        capture("event_panels", f"{BASE}/en/event/7/getInfoPanelsData", {"location_name": "Hall"}),
        capture("event_blocks", f"{BASE}/en/event/7/getCmsData", {"infoPageBlocks": [1]}),
        capture("participants", URL, participants(
            group(GROUP, registration(1, clubName=club, age=20), registration(2)))),
        capture("participants", URL, participants(
            group(GROUP, registration(1, clubName=club, age=99999999999))), at=late),
        capture("profile", f"{BASE}/en/profile/1", PROFILE),
        capture("profile", f"{BASE}/en/profile/1", "<p>nothing</p>", at=late),
        capture("profile_events", path, matches(4, "/en/profile/1/events?page=2")),
        capture("profile_events", path + "?page=2", matches(30)),
        capture("profile_events", f"{BASE}/en/profile/2/events?page=2", matches(8)),
        capture("profile", f"{BASE}/en/profile/2", PROFILE),
        capture("probe", "https://adcc.example.com/en/event/7", None, status=404),
        capture("probe", "https://adcc.example.com/en/event/7", None, at=late),
    ]


TABLES = ("athletes", "academies", "events", "event_details", "event_registrations", "event_hosts")


@pytest.mark.parametrize("seed", range(2))
def test_any_cut_into_batches_gives_the_same_tables(spark, tmp_path, seed):
    rows = all_kinds(spark)
    whole = Store(spark, str(tmp_path / "whole"), buckets=2)
    ingest(whole, captures(spark, *rows), SITE, "one", NOW)
    one = table(whole, "athletes")["1"]
    assert (one.total_wins, one.age, one.academy_external_id) == (34, 99999999999, "9")
    assert table(whole, "athletes")["2"].wins_by_submission == 3  # page 2 alone is no tally
    details = whole.read("event_details").first()
    assert details.location_name == "Hall" and details.info_page_blocks_json == "[1]"

    rng = random.Random(seed)
    rng.shuffle(rows)
    cut = Store(spark, str(tmp_path / "cut"), buckets=2)
    for i in range(4):
        ingest(cut, captures(spark, *rows[i::4]), SITE, f"b{i}", NOW + timedelta(hours=i))
    for name in TABLES:
        assert comparable(cut, name) == comparable(whole, name), name


@pytest.mark.parametrize("cuts", [1, 2])
def test_a_list_that_shrank(spark, tmp_path, cuts):
    def matches(n, at, next_url=None):
        won = [{"is_winner": True, "outcome": "Points"}] * n
        data = [{"registrations": [{"matches": won}]}]
        tail = "?page=2" if n == 2 else ""
        url = f"{BASE}/en/profile/1/events{tail}"
        return capture("profile_events", url, {"data": data, "next_page_url": next_url}, at=at)

    rows = [
        capture("participants", URL, participants(group(GROUP, registration(1)))),
        capture("profile", f"{BASE}/en/profile/1", "<p>nothing</p>"),
        matches(3, T0, "/en/profile/1/events?page=2"),
        matches(2, T0),
        matches(5, T0 + timedelta(days=1)),
    ]
    store = Store(spark, str(tmp_path), buckets=2)
    for i, part in enumerate([rows] if cuts == 1 else [rows[:4], rows[4:]]):
        ingest(store, captures(spark, *part), SITE, f"b{i}", NOW + timedelta(hours=i))
    assert table(store, "athletes")["1"].total_wins == 5


def test_a_batch_writes_only_what_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    ingest(store, captures(spark, *all_kinds(spark)), SITE, "one", NOW)
    before = store.state()["tables"]
    late = capture("event_list", f"{BASE}/en/events/past", listing(EVENTS[:1]), at=T0 + timedelta(days=1))
    ingest(store, captures(spark, late), SITE, "two", LATER)
    after = store.state()["tables"]
    for name in TABLES:
        assert (before[name] == after[name]) == (name != "events")
    changed = [b for b in after["events"] if after["events"][b] != before["events"][b]]
    assert len(changed) == 1 and len(before["events"]) > 1
    kept = comparable(store, "events")
    gone = store.expire(keep=1)
    assert any("/events/" in g for g in gone)
    assert comparable(store, "events") == kept and store.is_done("one")


def test_running_is_visible_while_a_batch_works(spark, tmp_path, monkeypatch):
    store, seen = Store(spark, str(tmp_path), buckets=2), []
    commit = type(store.begin("x")).commit

    def watched(batch):
        seen.append({(r.job_type, r.status) for r in runs.current_runs(store.read("runs")).collect()})
        commit(batch)

    monkeypatch.setattr(type(store.begin("x")), "commit", watched)
    ingest(store, captures(spark, late_listing()), SITE, "one", NOW)
    assert seen == [set(), {("all", "running")}]
    done = runs.current_runs(store.read("runs")).collect()
    assert {(r.job_type, r.status) for r in done} == {("all", "completed"), ("events_past", "completed")}


def late_listing():
    return capture("event_list", f"{BASE}/en/events/past", listing(EVENTS[:1]))


def test_a_taken_event_id_goes_to_quarantine(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    page = event_page(json.dumps(LD))
    first = [capture("event", f"{BASE}/en/event/{i}", page) for i in (1, 2)]
    ingest(store, captures(spark, *first), SITE, "one", NOW)
    stored = store.read("event_details")
    moved = stored.limit(1).select(F.lit("2").alias("event_id"), F.lit(f"{BASE}/en/event/1").alias("event_url"))
    held = event_details.held_back(moved, stored, "event_id", "event_url")
    assert [r.event_id for r in held.collect()] == ["2"]


def test_details_of_an_event(spark, store):
    details = store.read("event_details")
    by_id = reads.details_of_event(details, "7").first()
    assert by_id.location_city == "Rio"
    assert reads.details_of_event(details, event_url=by_id.event_url).first() == by_id
    with pytest.raises(ValueError):
        reads.details_of_event(details)


class _Calls:
    """The state of one bucket in place of the executor's, counting the calls on it."""

    def __init__(self):
        self.rows, self.timers, self.calls = [], set(), 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, list(rows)

    def clear(self):
        self.calls, self.rows = self.calls + 1, []

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class _Fired:
    def __init__(self, at, mark):
        self.getExpiryTimeInMs, self.getCurrentWatermarkInMs = lambda: at, lambda: mark


def test_changed_captures_reads_the_state_once_for_many_addresses():
    state, newest = _Calls(), jobs._Newest(["kind", "url", "fetched_at"])
    newest.init(state)

    def passed(*rows):
        frame = pd.DataFrame(rows, columns=["url", "fetched_at", jobs.CONTENT]).assign(kind="event")
        frame[jobs.AT] = frame["fetched_at"]
        out = pd.concat(newest.handleInputRows((0,), iter([frame[:1], frame[1:]]), None))
        return sorted(zip(out["url"], out["fetched_at"]), key=str)

    every = [(f"u{i}", 10 + i, 1) for i in range(500)]
    assert len(passed(*every)) == 500
    assert state.calls == 2 and state.timers == {10}
    # the same, changed, changed and back, late, without an address
    rows = ("u0", 20, 1), ("u1", 20, 2), ("u2", 30, 1), ("u2", 20, 3), ("u99", 9, 7), (None, 5, 1)
    assert passed(*rows) == [("u1", 20), ("u2", 20), ("u2", 30), (None, 5)]
    assert state.calls == 4 and state.timers == {5}
    list(newest.handleExpiredTimer((0,), _Fired(5, 400), _Fired(5, 400)))
    assert min(r[2] for r in state.rows) == 400 and 400 in state.timers
    list(newest.handleExpiredTimer((0,), _Fired(400, 9999), _Fired(400, 9999)))
    assert not state.rows


def test_a_batch_is_dealt_over_the_cores_and_steps_of_absent_kinds_are_left_out(
    spark, tmp_path, monkeypatch
):
    def unused(*_):
        raise AssertionError("no such captures came")

    for module, name in (
        (event_details, "event_pages"), (event_details, "event_documents"),
    ):
        monkeypatch.setattr(module, name, unused)
    pages = [capture("event_list", f"{BASE}/en/events/past?p={i}", listing(EVENTS)) for i in range(40)]
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    one_file = captures(spark, *pages, capture("other", f"{BASE}/x", "y")).coalesce(1)
    seen = store.begin("a").by_kind(one_file, ("event_list", "probe"))
    assert seen[1] == {"n": 41, "event_list": 40, "probe": 0}
    assert sorted(seen[0].collect()) == sorted(one_file.collect())
    assert len(seen[0].filter("kind = 'event_list'").inputFiles()) > 2
    assert ingest(store, one_file, SITE, "b", NOW)
    assert store.read("events").count() > 0


def test_batch_counters_decodes_valid_and_saved_rows_once(spark, tmp_path):
    from meetlake.checks.payloads import batch_counters

    spark.sql(
        "SELECT id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, 1.5D AS o_totalprice, "
        "TIMESTAMP '2025-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(1, 20)"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    found = batch_counters(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    one = found.filter("event_id = '1'").first()
    assert (one["groups"], one["registrations"], one["valid"], one["saved"]) == (2, 3, 3, 2)


def test_kinds_of_a_batch_are_decoded_at_once_and_tables_merged_at_once(spark, tmp_path, monkeypatch):
    """Each step waits until the others of its kind have begun."""
    decoding, merging = threading.Barrier(3), threading.Barrier(2)

    def met(module, name, barrier):
        real = getattr(module, name)

        def step(*args):
            barrier.wait(timeout=30)
            return real(*args)

        monkeypatch.setattr(module, name, step)

    met(payloads, "decode_participants", decoding)
    met(profiles, "profile_pages", decoding)
    met(listings, "listed_events", decoding)
    met(listings, "rows_of", merging)
    met(event_details, "details_of", merging)
    staged, real = [], stamps.staged
    monkeypatch.setattr(stamps, "staged", lambda rows, of: (staged.append(of), real(rows, of))[1])
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    assert ingest(store, first_batch(spark), SITE, "one", NOW)
    # rows a batch has written are merged from there; those of athletes are first cut down
    assert staged == ["batch"]
    assert {t: store.read(t).count() for t in ("events", "athletes")} == {"events": 2, "athletes": 2}


def test_a_step_that_fails_fails_the_others(spark):
    def lost():
        raise ValueError("lost")

    assert session.at_once(spark, lambda: 1, lambda: spark.range(3).count()) == [1, 3]
    with pytest.raises(ValueError, match="lost"):
        session.at_once(spark, lambda: 1, lost)


def test_a_batch_leaves_no_frames_behind(spark, tmp_path, monkeypatch):
    folders = []

    def folder(spark, purpose):
        folders.append(str(tmp_path / f"{purpose}-{len(folders)}"))
        return folders[-1]

    monkeypatch.setattr(session, "shared_folder", folder)
    asked = []
    monkeypatch.setattr(payloads, "quarantine", lambda rows, f=payloads.quarantine: (asked.append(rows), f(rows))[1])
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    before = spark.conf.get(session._CLEANUP)
    for i, late in enumerate((T0, T0 + timedelta(days=1))):
        rows = first_batch(spark).withColumn("fetched_at", F.lit(late))
        assert ingest(store, rows, SITE, f"b{i}", NOW + timedelta(days=i))
    assert folders and not [f for f in folders if os.path.exists(f)]
    assert spark.conf.get(session._CLEANUP) == before
    kept = {name for batch in store._batches() for name in store._names(batch)}
    assert kept <= {*ENTITY_TABLES, *APPENDED} and "athletes" in kept
    # registrations and refused payloads come from one pass over the bodies, written once
    assert "_read" not in kept and "_registrations" in store._names()
    refused = store.read("quarantine").filter("kind = 'participants'")
    assert [r["url"] for r in refused.collect()] == [URL + "?bad"] * 2
    owners = spark.createDataFrame([("0",), ("1",), ("2",)], "external_id string")
    parts = store.parts("_registrations", asked[0].withColumn("_owner", F.lit(0)).schema, owners)
    assert parts.count() == 8 and parts.filter("fault IS NOT NULL").count() == 0


def test_a_batch_read_by_enough_tasks_is_not_dealt_again(spark, tmp_path):
    pages = [capture("event_list", f"{BASE}/en/events/past?p={i}", "x") for i in range(40)]
    rows = captures(spark, *pages).coalesce(1)
    batch = Store(spark, str(tmp_path / "store")).begin("a")
    got, seen = batch.by_kind(rows, ("event_list",), deal=False)
    assert seen == {"n": 40, "event_list": 40} and len(got.inputFiles()) == 1
    assert sorted(got.collect()) == sorted(rows.collect())
