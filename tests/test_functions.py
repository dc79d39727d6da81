from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meetlake import Site
from meetlake.functions import labels, numbers, places, text, urls
from meetlake.operators.reads import EnrichmentBatch, Paging

SITE = Site()


def check(spark, cases):
    """cases: (Column, expected) all evaluated in one row."""
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    for i, (column, want) in enumerate(cases):
        assert row[i] == want, f"case {i}: {column} gave {row[i]!r}, not {want!r}"


def on(function, *pairs, **kw):
    return [(function(F.lit(v).cast("string"), **kw), want) for v, want in pairs]


def test_text(spark):
    nbsp = " "
    cases = on(text.strip, ("\t Rio　\n", "Rio"), (nbsp + "a b" + nbsp, "a b"), ("", ""))
    cases += on(text.normal_label, ("  Wins\t by X ", "wins by x"))
    cases += on(text.slug, ("Gracie / São 1!", "gracie---so-1"), ("A  b", "a--b"))
    cases += [
        (text.days_text(F.lit(v).cast("int")), w)
        for v, w in ((0, "0 days left"), (-3, "3 days ago"), (5, "5 days left"), (None, ""))
    ]
    cases += [
        (text.full_name(F.lit("A"), F.lit(""), F.lit("B")), "A B"),
        (text.full_name(F.lit("A"), F.lit("M"), F.lit("")), "A M "),
        (text.comma_list(F.lit(" a, ,b\t,")), ["a", "b"]),
        (text.event_name_or_default(F.lit(""), F.lit("7")), "Event 7"),
        (text.is_sports_event(F.lit(" sportsEVENT\n")), True),
        (text.first_filled(F.lit(""), F.lit(None), F.lit("x")), "x"),
    ]
    for category, want in (
        ("Men / Adults /  Beginner/ -60 kg / z", ["Men", "Adults", "Beginner", "-60 kg"]),
        ("A/B/C", ["", "", "", ""]),
        ("///", ["", "", "", ""]),
    ):
        parts = text.category_parts(F.lit(category))
        cases.append((F.array(*parts.values()), want))
    check(spark, cases)


def test_numbers(spark):
    cases = on(
        numbers.first_int, ("1,234", 1), ("n 12 x 3", 12), ("none", None), ("99999999999", 99999999999), ("9" * 20, None)
    )
    cases += on(numbers.comma_int, (" 1,234 ", 1234), ("x7", 0), ("+7", 7), ("7.5", 0), ("", 0))
    cases += on(
        numbers.birth_year, ("1990", 1990), (" 1990", 0), ("", 0), ("n/a", 0), ("-5", -5)
    )
    cases += on(
        numbers.flexible_double, ("60.90", 60.9), ("", None), (None, None), ("1e2", 100.0),
        ("x", None), ("1d", None), (" 7", None), (".5", 0.5),
    )
    cases += on(numbers.is_bad_flexible_double, ("x", True), ("", False), ("7", False))
    check(spark, cases)


def test_labels(spark):
    cases = on(
        labels.outcome_method, ("submission by decision", "submission"),
        ("decision on points", "decision"), ("points", "points"), ("disqualification", "dq"),
        ("by dq", "dq"), ("draw", ""),
    )
    cases += on(
        labels.stat_counter, ("wins by decision on points", "wins_by_points"),
        ("losses by decision", "losses_by_decision"), ("wins and losses", "total_wins"),
        ("loss", "total_losses"), ("dq wins", "wins_by_dq"), ("rank", None),
    )
    cases += on(
        labels.tile_counter, ("Total WINS", "total_wins"), ("members", "athlete_count"),
        ("Gold losses", "total_losses"), ("rank", None),
    )
    cases += on(labels.is_bye, ("a bye", True), ("walkover", True), ("win", False))
    cases += on(
        labels.belt_rank, ("PURPLE  Belt II", "Purple belt"), (" Newcomer ", "Newcomer"),
        ("xblack belt", "xblack belt"), ("black belts", "black belts"),
    )
    check(spark, cases)


def test_places(spark):
    def location(*spans):
        parts = places.location_parts(F.array(*[F.lit(s) for s in spans]))
        return F.array(places.city_of(parts), places.country_of(parts))

    check(
        spark,
        [
            (location(" Rio, ", " , ", "Brazil"), ["Rio", "Brazil"]),
            (location("A", "B", "C"), ["A, B", "C"]),
            (location("Chile"), ["", "Chile"]),
            (location("", ","), ["", ""]),
            (places.flag_country(F.lit("x flag-icon-br y"), F.lit("ar")), "BR"),
            (places.flag_country(F.lit(None).cast("string"), F.lit(" ar ")), "AR"),
            (places.country_name(F.lit("PE")), "Peru"),
            (places.country_name(F.lit("US")), "US"),
            (places.country_code(F.lit("Perú")), "PE"),
            (places.country_code(F.lit("Spain")), ""),
        ],
    )


def test_urls(spark):
    page = F.lit("https://x.test/a/b?c=/d")
    cases = on(urls.last_segment, ("https://x/en/club/7", "7"), ("a/b/", ""), ("a/7?p=1", "7?p=1"))
    cases += on(
        urls.site_host, ("https://adcc.example.com/e/1", "adcc.example.com"),
        ("see http://example.com", "example.com"), ("https://a.b.example.com", "example.com"),
        ("https://other.test", "example.com"), (None, "example.com"), site=SITE,
    )
    cases += on(
        urls.under_base, (" /e/1 ", "https://b.test/e/1"), ("e/1", "https://b.test/e/1"),
        ("http://c.test", "http://c.test"), ("", ""), (None, ""), base_url="https://b.test/",
    )
    cases += on(
        urls.resolved, ("/p", "https://x.test/p"), ("q", "https://x.test/a/q"), ("#f", ""),
        ("//y.test/z", "https://y.test/z"), ("http://z.test", "http://z.test"), page_url=page,
    )
    host = F.lit("a.test")
    cases += on(
        urls.same_domain, ("a.test", True), ("a.test/x", True), ("https://a.test", True),
        ("https://a.test/x", False), ("a.test.org", False), host=host,
    )
    cases += on(
        urls.follow_up_url, ("/n?p=2", "https://example.com/n?p=2"), ("http://x", "http://x"),
        ("", None), (None, None), site=SITE,
    )
    cases += [
        (urls.listing_url("past", F.lit("br"), SITE), "https://example.com/en/events/past?countries=BR"),
        (urls.listing_url("upcoming", F.lit(""), SITE), "https://example.com/en/events/upcoming"),
        (
            urls.side_document_url(F.lit("https://a.example.com/en/event/1"), F.lit("1"), "getCmsData"),
            "https://a.example.com/en/event/1/getCmsData",
        ),
    ]
    check(spark, cases)
    with pytest.raises(ValueError):
        urls.listing_url("all", F.lit(""), SITE)


def test_arguments():
    assert Paging.of("0", "101") == Paging(1, 20)
    assert Paging.of("x", None) == Paging.of(" 2", "1_0") == Paging(1, 20)
    assert Paging.of(3, 100).offset == 200
    assert EnrichmentBatch.of(0, -1, None) == EnrichmentBatch(50, 0, True)
    assert EnrichmentBatch.of("900", "5", "f") == EnrichmentBatch(200, 5, False)
    assert EnrichmentBatch.of(1, 1, "maybe").only_missing
