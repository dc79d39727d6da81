"""JSON payloads: decode, unnest, refuse; whole merges from payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from meetlake.checks import derived
from meetlake.checks.stand_ins import (
    SITE,
    split,
    stamp_days,
    stamped,
    stamps_sql,
    stand_in,
    table,
    with_stand_ins,
)
from meetlake.checks.tallies import counters_sql
from meetlake.functions import numbers, text, urls
from meetlake.operators import runs, tally
from meetlake.plans import event_athletes, event_details, listings, profiles
from meetlake.session import staged
from meetlake.sources import payloads
from meetlake.sources.captures import frontier
from meetlake.sources.pages import page_links

_FLAT = (
    "event_id", "event_name", "group_pos", "reg_pos", "external_id", "full_name",
    "nationality", "country_code", "birth_year", "age", "academy_name", "profile_url",
    "division", "age_category", "rank", "weight_class", "actual_weight", "seed",
)


def _flat(spark, sf):
    return event_athletes.flat_registrations(derived.participants(spark, sf), SITE)


def unnest_registrations(spark, sf):
    """SRC-1, JSN-2, JSN-3, PRJ-1 and their field functions."""
    return _flat(spark, sf).select(*_FLAT)


def payload_refusals(spark, sf):
    """JSN-1, FN-14: captures refused whole, by answer status or by one wrong field."""
    decoded = payloads.decode_participants(derived.participants(spark, sf))
    return payloads.quarantine(decoded).select("url", "status", "fault")


def batch_counters(spark, sf):
    """AGG-5 per event."""
    decoded = payloads.decode_participants(derived.participants(spark, sf))
    flat = event_athletes.event_athletes(payloads.registrations(decoded), SITE)
    # the bodies are decoded once for the rows, not once for valid and once for saved ones
    flat = staged(flat.select("event_id", "external_id"), "flat")
    saved = flat.distinct()
    return runs.batch_counters(payloads.payload_counts(decoded), flat, saved, "event_id")


def field_check(spark, sf):
    """Required fields of the first registration of each sound payload."""
    decoded = payloads.decode_participants(derived.participants(spark, sf))
    return payloads.field_check(decoded).select(
        "url", "has_groups", F.array_join("missing_fields", ",").alias("missing")
    )


def _stored_athletes(spark, sf):
    return stand_in(spark, sf, "athletes").select(
        "id",
        "external_id",
        F.lit("old").alias("first_name"),
        "full_name",
        "academy_external_id",
        "country_code",
        "belt_rank",
        "total_wins",
        F.lit(0).alias("age"),
        F.lit("").alias("image_url"),
        F.lit("").alias("avatar_url"),
    )


def athletes_from_events(spark, sf):
    """DML-3 with AGG-7 and JON-3: payloads into stored athletes."""
    merged = event_athletes.merge_athletes(
        _flat(spark, sf),
        stamped(_stored_athletes(spark, sf)),
        stand_in(spark, sf, "academies"),
        F.lit("2026-01-01").cast("timestamp"),
    )
    return stamp_days(merged).drop("id", "image_url", "avatar_url")


def registrations_from_events(spark, sf):
    """DML-4 with JON-4: payloads into stored registrations of the stored athletes."""
    stored = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") + 1).alias("athlete_id"),
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.lit("Men").alias("division"),
        F.col("o_orderpriority").alias("age_category"),
        F.col("o_orderstatus").alias("rank"),
        F.lit("-60 kg").alias("weight_class"),
        F.lit("old").alias("event_name"),
        F.lit(0.0).alias("actual_weight"),
        F.lit(0).alias("seed"),
    )
    merged = event_athletes.merge_registrations(
        _flat(spark, sf),
        _stored_athletes(spark, sf),
        stamped(stored),
        F.lit("2026-01-01").cast("timestamp"),
    )
    top = stored.agg(F.max("id")).scalar()
    return stamp_days(merged).withColumn("stored_id", F.when(F.col("id") <= top, F.col("id"))).drop("id")


def first_weight(spark, sf):
    """JSN-3 on lines: the first text that is a number."""
    texts = [
        F.when(F.col("l_linenumber") % 2 == 0, "").otherwise("n/a"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_quantity").cast("string")),
        F.when(F.col("l_linenumber") % 5 > 0, F.col("l_extendedprice").cast("string")),
    ]
    weight = numbers.first_weight(F.array(*texts))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", weight.alias("weight")
    )


def profile_matches(spark, sf):
    """SRC-2, JSN-4."""
    decoded = payloads.decode_profile_events(derived.profile_events(spark, sf), SITE)
    return payloads.profile_matches(decoded).drop("fetched_at")


def profile_tally(spark, sf):
    """AGG-2 over pages; none for athletes with a failed or missing page."""
    matches = profiles.match_pages(derived.profile_events(spark, sf), SITE)
    return tally.profile_tally(staged(matches, "match-pages"))


def tally_of_linked_pages(spark, sf):
    """SRC-2, JON-6, JON-8: of lists that changed only the pages linked now are summed."""
    matches = profiles.match_pages(derived.linked_lists(spark, sf), SITE)
    rows = tally.profile_tally(staged(matches, "match-pages"))
    return rows.select("external_id", "total_wins", "wins_by_submission", "total_losses")


def next_page_frontier(spark, sf):
    """JON-6: next pages that were not captured."""
    captured = derived.profile_events(spark, sf)
    links = payloads.decode_profile_events(captured, SITE).select(F.col("next_url").alias("url"))
    return frontier(links, captured)


def link_frontier(spark, sf):
    """JON-6 on pages: linked site paths that no page address has."""
    pages = table(spark, sf, "pages")
    links = pages.select(F.explode(page_links(F.col("html"))).alias("url"))
    paths = pages.select(
        F.concat(F.lit("/"), urls.last_segment(F.col("url"))).alias("url")
    )
    return frontier(links, paths)


def event_props(spark, sf):
    """JSN-5: a member counts only if it is a JSON string."""
    props = F.when(
        F.col("event_id") % 2 == 0, F.regexp_replace("props", r": (\d+)", ': "$1"')
    ).otherwise(F.col("props"))
    nested = F.concat(F.lit('{"location_city": '), F.get_json_object(props, "$.k"), F.lit("}"))
    quoted = F.concat(F.lit('{"organizer": {"name": "'), "event_type", F.lit('"}, "location_city": "c"}'))
    doc = payloads.open_object(F.when(F.col("event_id") % 3 == 0, quoted).otherwise(nested))
    fields = payloads.panel_fields(doc)
    return split(spark, sf, "events").select(
        "event_id",
        payloads.text_of(F.try_variant_get(F.try_parse_json(props), "$.k", "variant")).alias("k"),
        text.first_filled(fields["organizer_name"]).alias("organizer"),
        text.first_filled(fields["location_city"]).alias("city"),
    )


def page_script_value(spark, sf):
    """HTM-11: the array after a marker, appended to each page's markup."""
    page = F.concat(
        "html",
        F.lit("<script>var events = "),
        F.when(F.col("page_id") % 5 == 0, "none")
        .when(F.col("page_id") % 5 == 1, F.concat(F.lit('[{"id": 1, "title": "'), "url", F.lit('"}')))
        .otherwise(
            F.concat(
                F.lit('[{"id": '), "page_id", F.lit(', "title": "a]\\"'), "url", F.lit('"}, {"id": 2}]')
            )
        ),
        F.lit("; f(1);</script>"),
    )
    events = payloads.array_after(page, "var events", "struct<id bigint, title string>")
    return table(spark, sf, "pages").select(
        "page_id", F.size(events).alias("n"), F.get(events, F.lit(0))["title"].alias("title")
    )


def listed_events(spark, sf):
    """SRC-3, HTM-6, HTM-12, PRJ-2: embedded events, cards where there are none."""
    rows = listings.listed_events(derived.listings(spark, sf), SITE)
    return rows.drop("fetched_at")


def merged_events(spark, sf):
    """DML-2: listed events into stored ones on the address."""
    stored = stand_in(spark, sf, "meets").select(
        "id", "external_id", "event_url", "country_code", "event_type", F.lit("old").alias("name")
    )
    listed = listings.listed_events(derived.listings(spark, sf), SITE)
    merged = listings.merge_events(listed, stamped(stored), F.lit("2026-01-01").cast("timestamp"))
    top = stored.agg(F.max("id")).scalar()
    return stamp_days(merged).withColumn("stored_id", F.when(F.col("id") <= top, F.col("id"))).drop("id")


def fetched_details(spark, sf):
    """SRC-4, HTM-10, PRJ-3, PRJ-4, JSN-5 … JSN-8, DML-8."""
    rows = event_details.fetched_details(derived.event_pages(spark, sf))
    return rows.select(
        "event_id", "event_url", "name", "start_date", "image_url", "location_name",
        "location_city", "organizer_name", "info_panels_json", "info_page_blocks_json",
    )


QUERIES = {
    f.__name__: f
    for f in (
        unnest_registrations, payload_refusals, batch_counters, field_check,
        athletes_from_events, registrations_from_events, first_weight, profile_matches,
        profile_tally, tally_of_linked_pages, next_page_frontier, link_frontier, event_props, page_script_value,
        listed_events, merged_events, fetched_details,
    )
}

_BAD = "(o_orderkey % 11 = 0 OR o_orderkey % 17 = 0)"
_SOUND = f"o_orderkey % 13 > 0 AND NOT {_BAD}"
_FLAT_SQL = f"""
    SELECT CAST(o_orderkey AS STRING) AS event_id,
        concat(CASE WHEN o_orderkey % 2 = 0 THEN 'Cup ' ELSE 'Event ' END, o_orderkey) AS event_name,
        group_pos, reg_pos, CAST(u AS STRING) AS external_id, concat('F', u) AS first_name,
        concat('F', u, CASE WHEN u % 2 = 1 THEN ' M ' ELSE ' ' END, o_orderstatus) AS full_name,
        CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE o_orderpriority END AS nationality,
        concat('N', o_orderkey % 25) AS country_code,
        CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE CAST(o_orderkey % 50 + 1950 AS BIGINT) END
            AS birth_year,
        CAST(o_orderkey % 60 AS BIGINT) AS age,
        CASE WHEN o_orderkey % 3 = 0 THEN ''
            ELSE concat(CASE group_pos WHEN 0 THEN 'Club ' ELSE 'Dojo ' END, o_orderkey % 50) END
            AS academy_name,
        concat('https://example.com/en/profile/', u) AS profile_url,
        CASE group_pos WHEN 0 THEN 'Men' ELSE '' END AS division,
        CASE group_pos WHEN 0 THEN o_orderpriority ELSE '' END AS age_category,
        CASE group_pos WHEN 0 THEN o_orderstatus ELSE '' END AS rank,
        CASE group_pos WHEN 0 THEN '-60 kg' ELSE '' END AS weight_class,
        o_totalprice AS actual_weight,
        CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey % 16 AS BIGINT) ELSE 0 END AS seed,
        (o_orderdate, concat('https://example.com/en/event/', o_orderkey, '/participants'),
            group_pos, reg_pos) AS seen
    FROM (SELECT *, o_custkey + reg_pos AS u
        FROM orders, (VALUES (0, 0), (0, 1), (1, 0)) v(group_pos, reg_pos)
        WHERE {_SOUND} AND (group_pos = 1 OR o_orderkey % 7 > 0))
"""
_MATCH_ROWS = """
    SELECT CAST(c_custkey AS STRING) AS external_id, page,
        concat('https://example.com/en/profile/', c_custkey, '/events',
            CASE page WHEN 1 THEN '?page=2' ELSE '' END) AS url,
        (i + c_nationkey + page) % 2 = 0 AS is_winner,
        ['Submission', 'Decision', 'Points ', 'DQ', 'Bye', 'walkover', 'Other'][
            (i + c_custkey + page) % 7 + 1] AS outcome
    FROM (SELECT *, unnest(range(c_custkey % 5 + 1)) AS i
        FROM customer, (VALUES (0), (1)) v(page)
        WHERE (page = 0 AND c_custkey % 10 <> 9)
            OR (page = 1 AND c_custkey % 3 = 0 AND c_custkey % 12 > 0))
"""
_SCRIPTED = "c_custkey % 4 > 1"
_LISTED = f"""
    SELECT concat('https://example.com/en/events/', CASE WHEN c_custkey % 2 = 0 THEN 'past'
            ELSE 'upcoming' END, '?countries=N', c_custkey) AS url,
        CASE WHEN c_custkey % 2 = 0 THEN 'past' ELSE 'upcoming' END AS event_type,
        CAST(i AS INTEGER) AS pos,
        CASE WHEN NOT {_SCRIPTED} THEN concat('c', c_custkey) WHEN i = 0 THEN CAST(c_custkey AS STRING)
            ELSE '7' END AS external_id,
        CASE WHEN NOT {_SCRIPTED} THEN concat('Card ', c_custkey)
            WHEN i = 0 THEN concat('A ] "', c_custkey, '"') ELSE 'B' END AS name,
        concat('https://example.com/en/event/', CASE WHEN NOT {_SCRIPTED} THEN 'c'
            WHEN i = 0 THEN '' ELSE 'b' END, c_custkey) AS event_url,
        CASE WHEN NOT {_SCRIPTED} THEN 'i.png' WHEN i = 0 THEN 'f.png' ELSE 'c.png' END AS image_url,
        CASE WHEN {_SCRIPTED} THEN '' ELSE 'Rosario' END AS city,
        CASE WHEN NOT {_SCRIPTED} THEN c_mktsegment WHEN i = 0 THEN 'Brazil' ELSE '' END AS country,
        CASE WHEN NOT {_SCRIPTED} THEN CASE WHEN c_custkey % 3 = 0 THEN 'AR'
            ELSE concat('N', c_nationkey) END WHEN i = 0 THEN 'BR' ELSE '' END AS country_code,
        CASE WHEN {_SCRIPTED} THEN '' ELSE 'May' END AS date_text,
        CASE WHEN NOT {_SCRIPTED} OR i = 1 THEN '' WHEN c_nationkey >= 10
            THEN concat(c_nationkey - 10, ' days left')
            ELSE concat(10 - c_nationkey, ' days ago') END AS days_text,
        CASE WHEN {_SCRIPTED} THEN '' ELSE 'Soon' END AS section
    FROM (SELECT *, unnest(range(CASE WHEN c_custkey % 4 = 3 THEN 2 ELSE 1 END)) AS i FROM customer)
"""
_LD = "(c_custkey % 3 < 2 AND c_custkey % 5 < 4)"
_PANELS = "c_custkey % 4 <> 3"

SQL = {
    "unnest_registrations": f"SELECT {', '.join(_FLAT)} FROM ({_FLAT_SQL})",
    "payload_refusals": f"""
        SELECT concat('https://example.com/en/event/', o_orderkey, '/participants') AS url,
            CASE WHEN o_orderkey % 13 = 0 THEN 500 ELSE 200 END AS status,
            CASE WHEN o_orderkey % 13 = 0 THEN 'status 500'
                ELSE 'payload does not fit its schema' END AS fault
        FROM orders WHERE NOT ({_SOUND})""",
    "batch_counters": f"""
        SELECT event_id, 2::BIGINT AS "groups", count(*) AS registrations, count(*) AS valid,
            count(DISTINCT external_id) AS saved
        FROM ({_FLAT_SQL}) GROUP BY event_id""",
    "field_check": f"""
        SELECT concat('https://example.com/en/event/', o_orderkey, '/participants') AS url,
            true AS has_groups, CASE WHEN o_orderkey % 7 = 0
                THEN 'age,birth,cn,country,firstname,lastname,user_id'
                WHEN o_orderkey % 9 = 0 THEN 'country' ELSE '' END AS missing
        FROM orders WHERE {_SOUND}""",
    "athletes_from_events": with_stand_ins(
        f"""WITH flat AS ({_FLAT_SQL}), ba AS (
            SELECT external_id, arg_max(first_name, seen) AS first_name,
                arg_max(full_name, seen) AS full_name, arg_max(country_code, seen) AS country_code,
                arg_max(age, seen) AS age,
                arg_max(academy_name, seen) FILTER (WHERE academy_name <> '') AS academy_name
            FROM flat GROUP BY external_id),
        found AS (SELECT ba.*, CASE WHEN academy_name IS NOT NULL THEN coalesce((
            SELECT arg_min(c.external_id, c.id) FROM academies c WHERE c.name = academy_name), '')
            END AS link FROM ba)
        SELECT coalesce(b.external_id, s.external_id) AS external_id,
            coalesce(b.first_name, 'old') AS first_name, coalesce(b.full_name, s.full_name) AS full_name,
            coalesce(b.link, s.academy_external_id, '') AS academy_external_id,
            coalesce(b.country_code, s.country_code) AS country_code,
            CASE WHEN s.external_id IS NULL THEN '' ELSE s.belt_rank END AS belt_rank,
            coalesce(s.total_wins, 0) AS total_wins, coalesce(b.age, 0) AS age,
            {stamps_sql("s.external_id IS NULL", "b.external_id IS NOT NULL")}
        FROM athletes s FULL JOIN found b ON s.external_id = b.external_id""",
        "athletes",
        "academies",
    ),
    "registrations_from_events": f"""
        WITH flat AS ({_FLAT_SQL}), ba AS (
            SELECT CAST(external_id AS BIGINT) + 1 AS athlete_id, event_id, division, age_category,
                rank, weight_class, arg_max(event_name, seen) AS event_name,
                arg_max(actual_weight, seen) AS actual_weight, arg_max(seed, seen) AS seed
            FROM flat WHERE external_id IN (SELECT CAST(c_custkey AS STRING) FROM customer)
            GROUP BY ALL),
        st AS (SELECT o_orderkey AS stored_id, o_custkey + 1 AS athlete_id,
            CAST(o_orderkey AS STRING) AS event_id, 'Men' AS division,
            o_orderpriority AS age_category, o_orderstatus AS rank, '-60 kg' AS weight_class
            FROM orders)
        SELECT stored_id, athlete_id, event_id, division, age_category, rank, weight_class,
            coalesce(event_name, 'old') AS event_name, coalesce(actual_weight, 0) AS actual_weight,
            coalesce(seed, 0) AS seed,
            {stamps_sql("stored_id IS NULL", "event_name IS NOT NULL")}
        FROM st FULL JOIN ba USING (athlete_id, event_id, division, age_category, rank, weight_class)""",
    "first_weight": """
        SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN l_quantity
            WHEN l_linenumber % 5 > 0 THEN l_extendedprice ELSE 0 END AS weight
        FROM lineitem""",
    "profile_matches": f"SELECT external_id, url, is_winner, outcome FROM ({_MATCH_ROWS})",
    "profile_tally": f"""
        SELECT external_id, {counters_sql()}
        FROM (SELECT c.c_custkey, CAST(c.c_custkey AS STRING) AS external_id, m.is_winner,
                CASE m.outcome WHEN 'Submission' THEN 'submission' WHEN 'Decision' THEN 'decision'
                    WHEN 'Points ' THEN 'points' WHEN 'DQ' THEN 'dq' ELSE '' END AS method
            FROM customer c LEFT JOIN ({_MATCH_ROWS}) m
            ON m.external_id = CAST(c.c_custkey AS STRING) AND m.outcome NOT IN ('Bye', 'walkover'))
        WHERE c_custkey % 10 <> 9 AND c_custkey % 12 > 0 GROUP BY external_id""",
    "tally_of_linked_pages": """
        WITH RECURSIVE l AS (
            SELECT c_custkey AS c, v.p, v.next, v.day
            FROM customer, (VALUES (0, 0, 1, 0), (0, 1, NULL, 0), (0, 0, NULL, 1),
                (1, 0, 1, 0), (1, 1, 2, 0), (1, 2, NULL, 0), (1, 0, 3, 1), (1, 3, 4, 1), (1, 4, NULL, 1),
                (2, 0, 1, 0), (2, 1, 2, 0), (2, 2, 1, 0), (2, 3, 2, 0),
                (3, 0, 1, 0), (3, 1, 9, 0)) v(k, p, next, day)
            WHERE c_custkey % 5 = v.k
            UNION ALL
            SELECT c_custkey, p, CASE WHEN p < c_custkey % 23 THEN p + 1 END, 0
            FROM customer, range(23) r(p) WHERE c_custkey % 5 = 4 AND p <= c_custkey % 23),
        newest AS (SELECT c, p, arg_max((next, day), day) AS at FROM l GROUP BY c, p),
        reached AS (
            SELECT DISTINCT c, 0::BIGINT AS p FROM l
            UNION
            SELECT r.c, n.at[1]::BIGINT FROM reached r JOIN newest n ON n.c = r.c AND n.p = r.p
            WHERE n.at[1] IS NOT NULL),
        counted AS (
            SELECT r.c, n.p, (r.c + 2 * n.p + n.at[2]) % 7 AS n
            FROM reached r LEFT JOIN newest n ON n.c = r.c AND n.p = r.p)
        SELECT CAST(c AS STRING) AS external_id,
            CAST(sum((n + p % 2) // 2) AS BIGINT) AS total_wins,
            CAST(sum((n + p % 2) // 2) AS BIGINT) AS wins_by_submission,
            CAST(sum(n - (n + p % 2) // 2) AS BIGINT) AS total_losses
        FROM counted GROUP BY c HAVING count(*) = count(p)""",
    "next_page_frontier": """
        SELECT concat('https://example.com/en/profile/', c_custkey, '/events?page=2') AS url
        FROM customer WHERE c_custkey % 12 = 0""",
    "link_frontier": """
        SELECT DISTINCT url FROM (
            SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS url FROM pages)
        WHERE url NOT IN (SELECT concat('/', string_split(url, '/')[-1]) FROM pages) AND url <> ''""",
    "event_props": """
        SELECT event_id,
            CASE WHEN event_id % 2 = 0 THEN regexp_extract(props, '[0-9]+') END AS k,
            CASE WHEN event_id % 3 = 0 THEN event_type ELSE '' END AS organizer,
            CASE WHEN event_id % 3 = 0 THEN 'c' ELSE '' END AS city
        FROM events""",
    "page_script_value": """
        SELECT page_id, CASE WHEN page_id % 5 > 1 THEN 2 END AS n,
            CASE WHEN page_id % 5 > 1 THEN concat('a]"', url) END AS title
        FROM pages""",
    "listed_events": _LISTED,
    "merged_events": with_stand_ins(
        f"""WITH ba AS ({_LISTED})
        SELECT s.id AS stored_id, coalesce(b.external_id, s.external_id) AS external_id,
            coalesce(b.event_url, s.event_url) AS event_url,
            coalesce(b.country_code, s.country_code) AS country_code,
            coalesce(b.event_type, s.event_type) AS event_type, coalesce(b.name, 'old') AS name,
            {stamps_sql("s.id IS NULL", "b.event_url IS NOT NULL")}
        FROM meets s FULL JOIN ba b ON s.event_url = b.event_url""",
        "meets",
    ),
    "fetched_details": f"""
        SELECT CAST(c_custkey AS STRING) AS event_id,
            concat('https://example.com/en/event/', c_custkey) AS event_url,
            CASE WHEN {_LD} THEN concat('Ev ', c_custkey) ELSE '' END AS name,
            CASE WHEN {_LD} THEN 's' ELSE '' END AS start_date,
            CASE WHEN {_LD} THEN 'i' ELSE '' END AS image_url,
            CASE WHEN {_PANELS} AND c_custkey % 2 = 1 THEN 'Hall' ELSE '' END AS location_name,
            CASE WHEN {_LD} AND c_custkey % 2 = 0 THEN 'Rio' WHEN {_PANELS} THEN 'Panel city'
                ELSE '' END AS location_city,
            CASE WHEN {_PANELS} AND c_custkey % 7 > 0 THEN 'Org' ELSE '' END AS organizer_name,
            CASE WHEN {_PANELS} THEN concat('{{"location_city":"Panel city","location_name":',
                CASE WHEN c_custkey % 2 = 0 THEN '5' ELSE '"Hall"' END, ',"organizer":',
                CASE WHEN c_custkey % 7 = 0 THEN '"o"' ELSE '{{"name":"Org"}}' END, ',"z":null}}')
                ELSE 'null' END AS info_panels_json,
            CASE c_custkey % 4 WHEN 0 THEN '[1,"a"]' WHEN 1 THEN '{{"infoPageBlocks":null}}'
                WHEN 2 THEN '' ELSE '{{"b":{{"c":2}}}}' END AS info_page_blocks_json
        FROM customer""",
}
