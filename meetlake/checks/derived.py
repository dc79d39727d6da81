"""Captures that Spark makes of the driver's tables: one response per row.

Payloads and pages hold the odd cases on purpose (wrong types, blank fields, unclosed
tags, missing pages), spread over the rows by remainders of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetlake.checks import stand_ins

_COLUMNS = (
    "url", "kind", "fetched_at", "status", "location", "content_type", "country",
    "event_name", "body",
)


def table(spark, sf, name) -> DataFrame:
    return stand_ins.split(spark, sf, name)


def _captures(rows: DataFrame, kind: str, url: str, body, **more: str) -> DataFrame:
    given = {
        "fetched_at": "TIMESTAMP '2026-01-01 00:00:00'",
        "status": "200",
        "location": "CAST(NULL AS STRING)",
        "content_type": "'text/html'",
        "country": "CAST(NULL AS STRING)",
        "event_name": "CAST(NULL AS STRING)",
    } | more
    columns = {name: F.expr(text) for name, text in given.items()}
    columns |= {"kind": F.lit(kind), "url": F.expr(url), "body": body}
    return rows.select(*[columns[c].alias(c) for c in _COLUMNS])


def participants(spark, sf) -> DataFrame:
    """An order as an event: one group of two athletes (missing for every seventh) and a
    badly named group that holds the first athlete again."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")

    def registration(user, club):
        return F.struct(
            user.alias("user_id"),
            F.concat(F.lit("F"), user).alias("firstname"),
            F.when(user % 2 == 1, "M").otherwise("").alias("middle_name"),
            F.col("o_orderstatus").alias("lastname"),
            F.when(key % 4 == 0, " 1990")
            .otherwise((key % 50 + 1950).cast("string"))
            .alias("birth"),
            (key % 60).alias("age"),
            F.when(key % 3 == 0, "").otherwise(F.concat(F.lit(club), key % 50)).alias("clubName"),
            F.concat(F.lit("n"), key % 25).alias("cn"),
            F.when(key % 9 == 0, "").otherwise(F.col("o_orderpriority")).alias("country"),
            F.when(key % 2 == 1, key % 16).alias("seed_position"),
            F.array(
                F.struct(F.lit(None).cast("string").alias("weight_measured")),
                F.struct(F.lit("").alias("weight_measured")),
                F.struct(F.lit("x").alias("weight_measured")),
                F.struct(F.col("o_totalprice").cast("string").alias("weight_measured")),
            ).alias("categories"),
        )

    user = F.col("o_custkey")
    first = F.struct(
        F.concat_ws(" / ", F.lit("Men"), "o_orderpriority", "o_orderstatus", F.lit("-60 kg")).alias(
            "name"
        ),
        F.when(
            key % 7 > 0, F.array(registration(user, "Club "), registration(user + 1, "Club "))
        ).alias("registrations"),
    )
    second = F.struct(
        F.lit("Men / A / B").alias("name"),
        F.array(registration(user, "Dojo ")).alias("registrations"),
    )
    limits = F.array(
        F.struct(
            F.when(key % 17 == 0, "heavy").otherwise("60.5").alias("weight_maximum"),
            F.lit(4).alias("weight_minimum"),
        )
    )
    payload = F.to_json(
        F.struct(F.array(first, second).alias("participants"), limits.alias("categories")),
        {"ignoreNullFields": "false"},
    )
    orders = orders.withColumn("payload", payload)
    payload = F.col("payload")
    wrong_age = F.replace(payload, F.lit('"age":'), F.lit('"age":"x","old_age":'))
    return _captures(
        orders,
        "participants",
        "concat('https://example.com/en/event/', o_orderkey, '/participants')",
        F.when(key % 11 == 0, wrong_age).otherwise(payload),
        fetched_at="CAST(o_orderdate AS TIMESTAMP)",
        status="CASE WHEN o_orderkey % 13 = 0 THEN 500 ELSE 200 END",
        event_name="CASE WHEN o_orderkey % 2 = 0 THEN concat('Cup ', o_orderkey) END",
    )


def profile_events(spark, sf) -> DataFrame:
    """A customer as an athlete with one or two pages of matches.

    Every third has a second page, which is missing for every twelfth; the first page
    failed for every tenth.
    """
    customers = table(spark, sf, "customer")
    key = F.col("c_custkey")
    captured = F.when((key % 3 == 0) & (key % 12 > 0), F.array(F.lit(0), F.lit(1)))
    paged = customers.withColumn("page", F.explode(F.coalesce(captured, F.array(F.lit(0)))))
    outcomes = F.array(
        *[F.lit(o) for o in ("Submission", "Decision", "Points ", "DQ", "Bye", "walkover", "Other")]
    )
    matches = F.transform(
        F.sequence(F.lit(0), (key % 5).cast("int")),
        lambda i: F.struct(
            ((i + F.col("c_nationkey") + F.col("page")) % 2 == 0).alias("is_winner"),
            F.get(outcomes, ((i + key + F.col("page")) % 7).cast("int")).alias("outcome"),
        ),
    )
    events = F.array(
        F.struct(
            F.array(
                F.struct(matches.alias("matches")),
                F.struct(F.lit(None).cast(_MATCHES).alias("matches")),
            ).alias("registrations")
        ),
        F.struct(F.lit(None).cast(_REGISTRATIONS).alias("registrations")),
    )
    path = F.concat(F.lit("/en/profile/"), key, F.lit("/events?page=2"))
    next_url = F.when((F.col("page") == 0) & (key % 3 == 0), path).when(
        (F.col("page") == 1) & (key % 2 == 0), ""
    )
    body = F.to_json(
        F.struct(events.alias("data"), next_url.alias("next_page_url")),
        {"ignoreNullFields": "false"},
    )
    return _captures(
        paged,
        "profile_events",
        "concat('https://example.com/en/profile/', c_custkey, '/events', "
        "CASE page WHEN 1 THEN '?page=2' ELSE '' END)",
        body,
        status="CASE WHEN page = 0 AND c_custkey % 10 = 9 THEN 500 ELSE 200 END",
    )


def linked_lists(spark, sf) -> DataFrame:
    """A customer as an athlete whose page list changed or does not end well.

    By remainder of the key: a list that shrank to its first page, one cut anew at other
    pages, one that runs in a circle, one with a page missing, and long sound ones.
    """
    kind = "array<struct<page: int, next: int, day: int>>"
    lists = (
        "array((0, 1, 0), (1, NULL, 0), (0, NULL, 1))",
        "array((0, 1, 0), (1, 2, 0), (2, NULL, 0), (0, 3, 1), (3, 4, 1), (4, NULL, 1))",
        "array((0, 1, 0), (1, 2, 0), (2, 1, 0), (3, 2, 0))",
        "array((0, 1, 0), (1, 9, 0))",
        "transform(sequence(0, CAST(c_custkey % 23 AS INT)), "
        "p -> (p, CASE WHEN p < c_custkey % 23 THEN p + 1 END, 0))",
    )
    cases = " ".join(f"WHEN {i} THEN CAST({text} AS {kind})" for i, text in enumerate(lists))
    rows = table(spark, sf, "customer").selectExpr("c_custkey", f"inline(CASE c_custkey % 5 {cases} END)")
    n = ((F.col("c_custkey") + 2 * F.col("page") + F.col("day")) % 7).cast("int")
    matches = F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            ((i + F.col("page")) % 2 == 0).alias("is_winner"), F.lit("Submission").alias("outcome")
        ),
    )
    path = F.concat(F.lit("/en/profile/"), "c_custkey", F.lit("/events?page="), F.col("next"))
    events = F.array(F.struct(F.array(F.struct(matches.alias("matches"))).alias("registrations")))
    body = F.struct(events.alias("data"), path.alias("next_page_url"))
    return _captures(
        rows,
        "profile_events",
        "concat('https://example.com/en/profile/', c_custkey, '/events', "
        "CASE WHEN page > 0 THEN concat('?page=', page) ELSE '' END)",
        F.to_json(body, {"ignoreNullFields": "false"}),
        fetched_at="timestamp_seconds(1700000000 + 86400 * day)",
    )


_MATCHES = "array<struct<is_winner:boolean,outcome:string>>"
_REGISTRATIONS = f"array<struct<matches:{_MATCHES}>>"


def profiles(spark, sf) -> DataFrame:
    """A customer as a profile page."""
    html = F.expr(
        """concat('<!DOCTYPE html><html><body>',
        CASE c_mktsegment
            WHEN 'BUILDING' THEN '<div class="x well-skillevel"><strong class="font-size-md b">PURPLE  Belt II</strong></div>'
            WHEN 'MACHINERY' THEN '<div class="well-skillevel"><i class="font-size-md"> New comer </i></div>'
            ELSE '' END,
        '<ul class="fights_wins_legend"><li><span class="total">', c_custkey % 9,
        '</span><span class="type"> Submission</span><li><strong>', c_custkey % 4,
        '</strong> by points</ul><dl><dt>Total wins<dd>', c_custkey % 3, '</dd>',
        CASE WHEN c_mktsegment = 'FURNITURE' THEN '<dt>Belt</dt><dd>Brown 7</dd>' ELSE '' END,
        '</dl><div class="stat-item"><span class="label">Losses by DQ</span><span class="value">',
        c_custkey % 5, ',000</span></div><table><tr><th>Wins by<br> decision</th><td>',
        c_custkey % 6, '<tr><th>Rank</th></tr></table><ul><li>Losses by points: ', c_custkey % 8,
        array_join(transform(sequence(0, CAST(c_custkey % 4 AS INT)), i -> concat(
            '<li><b class="label label-danger">', CASE WHEN i % 2 = 0 THEN 'WIN' ELSE 'Loss' END,
            '</b> by decision</li>')), ''),
        '</ul></body></html>')"""
    )
    return _captures(
        table(spark, sf, "customer"),
        "profile",
        "concat('https://example.com/en/profile/', c_custkey)",
        html,
    )


def academies(spark, sf) -> DataFrame:
    """A supplier as an academy page; every tenth has no name."""
    html = F.expr(
        """concat('<html><body>',
        CASE WHEN s_suppkey % 10 = 9 THEN '' WHEN s_suppkey % 3 = 0
            THEN concat('<p class="club-name"> ', s_name, ' / Team </p>')
            ELSE concat('<h1> ', s_name, ' &amp; Co</h1>') END,
        '<img class="club-logo" src="/logo/', s_suppkey, '.png">',
        '<img src="x.png" class="wide club-cover" />',
        '<div class="club-bio"> Bio <b>bold</div><div class="club-description">more </div>',
        '<a href="https://example.com/en/x">own</a>',
        '<a href=" https://instagram.com/s', s_suppkey, '">i</a>',
        CASE WHEN s_suppkey % 2 = 0 THEN '<a href="http://facebook.com/f">f</a>' ELSE '' END,
        '<div class="stat-item"><i class="stat-label">WINS</i><i class="stat-value">7</i></div>',
        '<div class="stats-item"><i class="label">Total wins</i><i class="value"> ',
        format_number(s_suppkey * 1000, 0), ' </i></div>',
        '<div class="stat-item"><i class="label">Members</i><i class="value">x</i></div>',
        '<div class="stat-item"><i class="label">Gold</i><i class="value">', s_suppkey % 20,
        '</i></div></body></html>')"""
    )
    return _captures(
        table(spark, sf, "supplier"),
        "academy",
        "concat('https://example.com/en/club/', s_suppkey)",
        html,
    )


def academy_lists(spark, sf) -> DataFrame:
    """A nation as a run that read a list page of four academies and some other links."""
    html = F.expr(
        """concat('<html><!-- <a href="/en/club/0">no</a> --><ul>',
        array_join(transform(sequence(0, 3), i -> concat('<li><a class="c" href="/en/club/',
            n_nationkey * 3 + i, '">x</a>')), ''),
        '</ul><a href="/en/club/finder/1">f</a><a href="/en/club/">e</a>',
        "<a href='/de/club/1'>d</a><a name=x>n</a></html>")"""
    )
    return _captures(
        table(spark, sf, "nation"),
        "academy_list",
        "'https://example.com/en/club'",
        html,
        country="n_name",
        fetched_at="timestamp_seconds(1700000000 + n_nationkey)",
    )


def listings(spark, sf) -> DataFrame:
    """A customer as a listing page: an array of two events and a card.

    The array is empty for every fourth page and has a wrong type in every fourth.
    """
    html = F.expr(
        r"""concat('<html><script>var other = [1]; var events = ',
        CASE c_custkey % 4 WHEN 0 THEN '[]' ELSE concat(
            '[{"id": ', c_custkey, ', "title": " A ] \\"', c_custkey, '\\" ", "url": "https://example.com/en/event/',
            c_custkey, '", "cover_image": "", "cover_image_fallback": " f.png", "days_to_start": ',
            c_nationkey - 10, ', "location_country": "br", "location_country_human": "Brazil", "tags": ["]"]}, ',
            '{"id": ', CASE WHEN c_custkey % 4 = 1 THEN '"7"' ELSE '7' END,
            ', "title": "', CASE WHEN c_custkey % 4 = 2 THEN ' ' ELSE 'B' END,
            '", "url": "https://example.com/en/event/b', c_custkey, '", "cover_image": "c.png"}]') END,
        '; var z = [2];</script><div class="margin-bottom-xs-64"><h2> Soon </h2><div>',
        '<div class="event-card"><a class="image-container" href="/en/event/c', c_custkey,
        '"><img src=" i.png "></a><a class="event-title"> Card ', c_custkey, ' </a>',
        CASE WHEN c_custkey % 3 = 0 THEN '<i class="flag-icon flag-icon-ar"></i>' ELSE '' END,
        '<p class="location"><span>Rosario,</span><span> , </span><span>', c_mktsegment,
        '</span></p><span class="date"> May </span></div>',
        '<div class="event-card"><a class="event-title" href="/en/event/d"> </a></div>',
        '</div></div></html>')"""
    )
    return _captures(
        table(spark, sf, "customer"),
        "event_list",
        "concat('https://example.com/en/events/', CASE WHEN c_custkey % 2 = 0 THEN 'past' "
        "ELSE 'upcoming' END, '?countries=N', c_custkey)",
        html,
        country="concat('n', c_nationkey)",
    )


def event_pages(spark, sf) -> DataFrame:
    """A customer as an event page with its two side documents."""
    customers = table(spark, sf, "customer")
    event = """concat('{"@type": " sportsevent ", "name": "Ev ', c_custkey, '", "startDate": "s", "image": ',
        CASE WHEN c_custkey % 5 = 4 THEN '["i"]' ELSE '"i"' END,
        ', "location": {"name": "", "address": {"addressLocality": "',
        CASE WHEN c_custkey % 2 = 0 THEN 'Rio' ELSE '' END, '"}}}')"""
    html = F.expr(
        f"""concat('<html><head><script type="application/ld+json"> </script>',
        '<script type="application/ld+json">{{"@type": "Thing", "name": "no"}}</script>',
        '<script type="application/ld+json">',
        CASE c_custkey % 3 WHEN 0 THEN {event} WHEN 1
            THEN concat('[{{"@type": "Thing"}}, ', {event}, ']') ELSE 'no json' END,
        '</script></head><body>x</body></html>')"""
    )
    pages = _captures(
        customers, "event", "concat('https://example.com/en/event/', c_custkey)", html
    )
    panels = F.expr(
        """concat('{"z": null, "location_city": "Panel city", "location_name": ', CASE WHEN c_custkey % 2 = 0
        THEN '5' ELSE '"Hall"' END, ', "organizer": ', CASE WHEN c_custkey % 7 = 0 THEN '"o"'
        ELSE '{"name": "Org"}' END, '}')"""
    )
    side = "concat('https://example.com/en/event/', c_custkey, '{}')"
    with_panels = _captures(
        customers,
        "event_panels",
        side.format("/getInfoPanelsData"),
        panels,
        status="CASE WHEN c_custkey % 4 = 3 THEN 404 ELSE 200 END",
    )
    blocks = F.expr(
        """CASE c_custkey % 4 WHEN 0 THEN '{"infoPageBlocks": [1, "a"], "b": 1}'
        WHEN 1 THEN '{"infoPageBlocks": null}' WHEN 2 THEN '[1]' ELSE '{"b": {"c": 2}}' END"""
    )
    with_blocks = _captures(customers, "event_blocks", side.format("/getCmsData"), blocks)
    return pages.unionByName(with_panels).unionByName(with_blocks)


def probes(spark, sf) -> DataFrame:
    """A nation as an event whose hosts were probed: one answered, one moved away."""
    hosts = F.array(*[F.lit(h) for h in stand_ins.SITE.hosts])
    rows = table(spark, sf, "nation").withColumn("host", F.explode(hosts))
    return _captures(
        rows,
        "probe",
        "concat('https://', host, '/en/event/', n_nationkey)",
        F.lit(None).cast("string"),
        status="CASE WHEN length(host) % 3 = n_nationkey % 3 THEN 200 ELSE 302 END",
        location="'https://elsewhere.test/'",
    )
