from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from golden import BASE, EVENTS, LD, T0, capture, captures, event_page, group, listing
from golden import participants as payload
from golden import registration
from pyspark.sql import functions as F

from meetlake import Site, session
from meetlake.checks import payloads as checks
from meetlake.operators import keyed, lookup
from meetlake.operators.tally import page_tallies, profile_tally
from meetlake.plans import event_athletes, event_details, listings, stamps
from meetlake.sources import payloads

SITE = Site()
URL = f"{BASE}/en/event/7/participants"


def flat_of(spark, body, **kw):
    rows = event_athletes.flat_registrations(
        captures(spark, capture("participants", URL, body, **kw)), SITE
    )
    return [r.asDict() for r in rows.orderBy("group_pos", "reg_pos").collect()]


def faults(spark, *bodies):
    rows = captures(
        spark, *[capture("participants", f"{URL}?{i}", b) for i, b in enumerate(bodies)]
    )
    return [r.fault for r in payloads.decode_participants(rows).orderBy("url").collect()]


def test_registration_record(spark):
    weights = [{"weight_measured": w} for w in (None, "", "x", "60.90", "70")]
    reg = registration(
        5, middle_name="M", categories=weights, seed_position=3, cn="br", birth="1990"
    )
    (row,) = flat_of(spark, payload(group("Men / Adults / Beginner / -60 kg / z", reg)))
    assert row["external_id"] == "5"
    assert row["full_name"] == "Ana M L5"
    assert row["country_code"] == "BR"
    assert (row["division"], row["age_category"]) == ("Men", "Adults")
    assert (row["rank"], row["weight_class"]) == ("Beginner", "-60 kg")
    assert row["actual_weight"] == 60.9
    assert row["seed"] == 3
    assert row["birth_year"] == 1990
    assert row["profile_url"] == f"{BASE}/en/profile/5"
    assert row["event_id"] == "7" and row["event_name"] == "Event 7"


def test_missing_values_are_empty(spark):
    rows = flat_of(
        spark,
        {
            "participants": [
                {"name": "A/B/C", "registrations": [{"user_id": 1, "firstname": None}]},
                {"name": "none", "registrations": None},
            ]
        },
        event_name="Named",
    )
    (row,) = rows
    assert row["full_name"] == " "
    assert row["division"] == "" and row["weight_class"] == ""
    assert row["birth_year"] == 0 and row["age"] == 0 and row["actual_weight"] == 0.0
    assert row["academy_name"] == "" and row["event_name"] == "Named"


@pytest.mark.parametrize(
    "birth, year", [("", 0), ("1990", 1990), (" 1990", 0), ("n/a", 0), ("+7", 7)]
)
def test_birth_year(spark, birth, year):
    (row,) = flat_of(spark, payload(group("x", registration(1, birth=birth))))
    assert row["birth_year"] == year


def test_one_wrong_type_refuses_the_whole_payload(spark):
    good = registration(1)
    bad = [
        payload(group("x", good, registration(2, age="30"))),
        payload(group("x", good, registration(2, firstname=5))),
        payload(group("x", good, registration(2, clubName={"a": 1}))),
        payload(group("x", registration(2, categories=[{"weight_measured": 60.9}]))),
        payload(group(7, good)),
        payload(categories=[{"weight_maximum": "heavy"}]),
        payload(categories=[{"weight_maximum": True}]),
        "not json",
        '{"participants": []} x',
        "",
    ]
    sound = [
        payload(group("x", good)),
        payload(categories=[{"weight_maximum": "60.5", "weight_minimum": 4}]),
        payload(categories=[{"weight_maximum": "", "weight_minimum": None}]),
        {},
        {"participants": None},
    ]
    assert all(faults(spark, *bad))
    assert faults(spark, *sound) == [None] * len(sound)
    assert flat_of(spark, bad[0]) == []


def test_failed_answers_are_quarantined(spark):
    
    rows = captures(
        spark,
        capture("participants", URL, payload(group("x", registration(1))), status=500),
        capture("participants", URL + "2", payload(group("x", registration(1)))),
    )
    (row,) = payloads.quarantine(payloads.decode_participants(rows)).collect()
    assert row.fault == "status 500"


def test_payload_counts_and_field_check(spark):
    body = payload(
        group("x", registration(1, firstname="", birth=""), registration(2)),
        group("y"),
        categories=[{}, {}],
    )
    decoded = payloads.decode_participants(captures(spark, capture("participants", URL, body)))
    (n,) = payloads.payload_counts(decoded).collect()
    assert (n.n_groups, n.n_categories, n.n_registrations) == (2, 2, 2)
    (check,) = payloads.field_check(decoded).collect()
    assert check.has_groups and check.missing_fields == ["birth", "firstname"]


def fights(*matches):
    return [{"registrations": [{"matches": [{"is_winner": w, "outcome": o} for w, o in matches]}]}]


def tallies(spark, *rows):
    decoded = payloads.decode_profile_events(captures(spark, *rows), SITE)
    return {r.external_id: r.asDict() for r in profile_tally(page_tallies(decoded)).collect()}


def page(athlete, n, data, next_url=None, at=T0, status=200):
    tail = "" if n == 1 else f"?page={n}"
    return capture(
        "profile_events",
        f"{BASE}/en/profile/{athlete}/events{tail}",
        {"data": data, "next_page_url": next_url},
        at=at,
        status=status,
    )


def test_match_tally(spark):
    one = fights(
        (True, " Submission by decision"), (True, "Points"), (True, "BYE"), (False, "Walkover"),
        (False, "Disqualification"), (False, "strange"), (True, None),
    )
    two = fights((True, "Decision"), (False, "DQ"))
    got = tallies(
        spark,
        page(1, 1, one, "/en/profile/1/events?page=2"),
        page(1, 2, two, ""),
        page(1, 2, fights((True, "Points")), at=T0 - timedelta(days=1)),  # older capture
        page(2, 1, one, f"{BASE}/en/profile/2/events?page=2"),  # next page never captured
        page(3, 1, one, "/en/profile/3/events?page=2"),
        page(3, 2, two, status=500),  # refused page
        page(4, 1, None),
    )
    assert set(got) == {"1", "4"}
    assert got["1"] == {
        "external_id": "1", "total_wins": 4, "wins_by_submission": 1, "wins_by_points": 1,
        "wins_by_decision": 1, "wins_by_dq": 0, "total_losses": 3, "losses_by_submission": 0,
        "losses_by_points": 0, "losses_by_decision": 0, "losses_by_dq": 2,
    }
    assert sum(v for k, v in got["4"].items() if k != "external_id") == 0


def wins(n):
    return fights(*[(True, "Points")] * n)


def test_only_linked_pages_count(spark):
    def path(athlete, n):
        return f"/en/profile/{athlete}/events?page={n}"

    late = T0 + timedelta(days=1)
    chain = [page(5, n, wins(1), path(5, n + 1) if n < 40 else None) for n in range(1, 41)]
    got = tallies(
        spark,
        # shrunk: the first page no longer links the second
        page(1, 1, wins(3), path(1, 2)), page(1, 2, wins(2)), page(1, 1, wins(5), at=late),
        # cut anew: other pages are linked, the old second page was refused later
        page(2, 1, wins(3), path(2, 2)), page(2, 2, wins(2)), page(2, 2, wins(2), status=500, at=late),
        page(2, 1, wins(4), path(2, 7), at=late), page(2, 7, wins(6), path(2, 8), at=late),
        page(2, 8, wins(1), at=late),
        # in a circle, and linked by a page nothing links
        page(3, 1, wins(1), path(3, 2)), page(3, 2, wins(1), path(3, 3)),
        page(3, 3, wins(1), path(3, 2)), page(3, 9, wins(50), path(3, 2)),
        # to itself; a link that leads to another athlete's page is open
        page(4, 1, wins(2), "/en/profile/4/events"), page(6, 1, wins(2), path(5, 2)),
        # a late first page without its second one any more
        page(7, 2, wins(2)),
        *chain,
    )
    assert {k: v["total_wins"] for k, v in got.items()} == {"1": 5, "2": 11, "3": 3, "4": 2, "5": 40}


def test_rounds_grow_with_the_logarithm_of_a_list(spark, monkeypatch):
    from meetlake.operators import tally as operators

    rounds, real = [], operators.staged

    def noted(rows, purpose):
        rounds.append(purpose)
        return real(rows, purpose)

    monkeypatch.setattr(operators, "staged", noted)
    rows = [("1", f"u?{i}" if i else "u", f"u?{i + 1}" if i < 999 else None, T0) for i in range(1000)]
    pages = spark.createDataFrame(
        rows, "external_id string, url string, next_url string, fetched_at timestamp"
    )
    assert operators.linked_pages(pages).count() == 1000
    assert rounds.count("linked-pages") <= 11 + 1


def test_match_rows_give_the_same_tally(spark):
    from meetlake.operators.tally import tally

    one = fights((True, "Submission"), (False, "Bye"), (False, "Points"))
    decoded = payloads.decode_profile_events(captures(spark, page(1, 1, one)), SITE)
    flat = tally(payloads.profile_matches(decoded), ["external_id"])
    cols = sorted(flat.columns)
    assert flat.select(cols).collect() == profile_tally(page_tallies(decoded)).select(cols).collect()


def listed(spark, body, url=f"{BASE}/en/events/upcoming", country="cl"):
    rows = captures(spark, capture("event_list", url, body, country=country))
    return [r.asDict() for r in listings.listed_events(rows, SITE).orderBy("pos").collect()]


def test_embedded_events_win_over_cards(spark):
    a, b = listed(spark, listing(EVENTS))
    assert (a["external_id"], a["name"], a["image_url"]) == ("11", 'A ] "q"', "f.png")
    assert (a["country_code"], a["days_text"], a["city"]) == ("BR", "5 days left", "Rio")
    assert (b["external_id"], b["days_text"], b["event_type"]) == ("12", "3 days ago", "upcoming")


@pytest.mark.parametrize(
    "events",
    [
        [],
        EVENTS[2:],
        [EVENTS[0], {"id": "x"}],
        [EVENTS[0], {"days_to_start": 1.5}],
        [EVENTS[0], {"eventEnded": "no"}],
        [EVENTS[0], 5],
    ],
)
def test_cards_where_the_array_gives_nothing(spark, events):
    five, six = listed(spark, listing(events))
    assert five["event_url"] == f"{BASE}/en/event/5" and five["name"] == "Open 5"
    assert five["section"] == "This week" and five["image_url"] == "c.png"
    assert (five["city"], five["country"]) == ("Rosario, Santa Fe", "Argentina")
    assert (five["country_code"], five["date_text"]) == ("AR", "May 1")
    assert six["event_url"] == f"{BASE}/en/event/6" and six["external_id"] == "6"
    assert (six["city"], six["country"], six["country_code"]) == ("", "Chile", "CL")


def test_array_without_end_is_no_array(spark):
    body = listing(EVENTS).replace("]; var z = [1];", "; ")
    assert [e["external_id"] for e in listed(spark, body)] == ["5", "6"]


def details(spark, *rows):
    return {r.event_id: r for r in event_details.fetched_details(captures(spark, *rows)).collect()}


def test_event_details(spark):
    panels = {
        "location_city": "unused", "location_country_human": "Brazil", "location_name": 5,
        "organizer": {"name": "Org"}, "z": None,
    }
    got = details(
        spark,
        capture("event", f"{BASE}/en/event/7", event_page("", '{"@type": "x"}', json.dumps(LD))),
        capture("event_panels", f"{BASE}/en/event/7/getInfoPanelsData", panels),
        capture("event_blocks", f"{BASE}/en/event/7/getCmsData", {"infoPageBlocks": [1, "a"]}),
        capture("event", f"{BASE}/en/event/8", event_page(json.dumps([{"@type": "x"}, LD]))),
        capture("event_panels", f"{BASE}/en/event/8/getInfoPanelsData", [1]),
        capture("event", f"{BASE}/en/event/9", event_page(json.dumps(LD | {"image": ["i"]}))),
        capture("event_blocks", f"{BASE}/en/event/9/getCmsData", {"infoPageBlocks": None}),
        capture("event", f"{BASE}/en/event/10", "gone", status=404),
    )
    assert set(got) == {"7", "8", "9"}
    seven, eight, nine = got["7"], got["8"], got["9"]
    assert (seven.name, seven.location_city, seven.location_country) == ("Ev", "Rio", "Brazil")
    assert (seven.location_name, seven.organizer_name) == ("", "Org")
    assert json.loads(seven.info_panels_json) == panels
    assert json.loads(seven.info_page_blocks_json) == [1, "a"]
    assert (eight.name, eight.info_panels_json, eight.info_page_blocks_json) == ("Ev", "null", "")
    assert nine.name == "" and json.loads(nine.info_page_blocks_json) == {"infoPageBlocks": None}


def test_one_wrong_element_refuses_its_script_only(spark):
    bad = json.dumps([LD | {"name": 5}, LD])
    body = event_page(bad, json.dumps(LD | {"name": "Second"}))
    rows = spark.createDataFrame([(body,)], "body string")
    found = rows.select(payloads.linked_event(F.col("body")).alias("v"))
    assert found.select(F.expr("v:name::string").alias("n")).first().n == "Second"


def test_registrations_write_what_they_keep_and_no_more(spark, tmp_path, monkeypatch):
    orders = [(1, 0, "O", 10.5, "1-URGENT", date(1995, 1, 1))]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    names += "o_orderpriority string, o_orderdate date"
    spark.createDataFrame(orders, names).write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(0, "a", 1, "LAND", 1.0)]
    names = "c_custkey long, c_name string, c_nationkey long, c_mktsegment string, c_acctbal double"
    spark.createDataFrame(customers, names).write.parquet(f"{tmp_path}/customer.parquet")
    seen, kept = {}, session.staged
    for module in (checks, event_athletes, lookup, stamps, keyed):
        monkeypatch.setattr(
            module, "staged", lambda rows, of: (seen.update({of: rows.columns}), kept(rows, of))[1]
        )
    rows = checks.registrations_from_events(spark, str(tmp_path)).collect()
    got = {(r["stored_id"], r["athlete_id"], r["division"], r["event_name"], r["actual_weight"]) for r in rows}
    assert got == {(1, 1, "Men", "Event 1", 10.5), (None, 1, "", "Event 1", 10.5)} and len(rows) == 2
    # the flat rows are not written, and what is read back for the look-up is not written again
    assert set(seen) == {"latest", "batch", "new-keys"}
    assert set(seen["latest"]) == {*event_athletes.OUTER_KEY, "event_name", "actual_weight", "seed", "ranking"}
