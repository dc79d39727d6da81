"""Markup pages: flat tags by pattern, nested ones by the markup stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from meetlake.checks import derived
from meetlake.checks.stand_ins import SITE, split, stamp_days, stamped, stamps_sql, table
from meetlake.functions import urls
from meetlake.functions.labels import COUNTERS
from meetlake.operators.hosts import host_of_event
from meetlake.operators.reads import EnrichmentBatch
from meetlake.operators.tally import profile_counters
from meetlake.plans import academies, profiles
from meetlake.session import staged
from meetlake.sources import pages
from meetlake.sources.captures import answered
from meetlake.sources.markup import Pick, Record, field, found_of, records_in
from meetlake.sources.payloads import unnested

_PARSED = (
    Record("link", ("a",), (Pick("href", take="href"), Pick("text"))),
    Record("item", ("li",), (Pick("text"),)),
)


def _found(spark, sf):
    return split(spark, sf, "pages").select("page_id", records_in(F.col("html"), _PARSED).alias("found"))


def page_links(spark, sf):
    """HTM-1: link targets by pattern, with the full address."""
    rows = unnested(
        table(spark, sf, "pages"),
        pages.page_links(F.col("html")),
        "page_id",
        "url",
        item="href",
        position="pos",
    )
    return rows.select(
        "page_id",
        "pos",
        "href",
        urls.resolved(F.col("href"), F.col("url")).alias("full"),
        urls.under_base(F.col("href"), SITE.base_url + "/").alias("under_base"),
    )


def html_links_parser(spark, sf):
    """The same links by the markup stage, with their texts."""
    rows = unnested(
        _found(spark, sf), found_of(F.col("found"), "link"), "page_id", item="f", position="pos"
    )
    return rows.select(
        "page_id", "pos", field(F.col("f"), "href").alias("href"), field(F.col("f"), "text").alias("text")
    )


def page_list_items(spark, sf):
    """HTM-5 (list items): label and value of items with a colon put in."""
    html = F.regexp_replace("html", "</a></li>", ": a:b</a></li>")
    found = table(spark, sf, "pages").select(
        "page_id", records_in(html, pages.PROFILE_RECORDS).alias("found")
    )
    rows = unnested(found, pages.label_values(F.col("found")), "page_id", item="p", position="pos")
    return rows.select("page_id", "pos", "p.label", "p.value")


def academy_fields(spark, sf):
    """HTM-2 … HTM-4, FLT-9."""
    rows = pages.academies(derived.academies(spark, sf), SITE)
    return rows.drop("fetched_at", "country", "url")


def academies_merged(spark, sf):
    """SRC-6, JON-7, DML-1: linked academies with their pages into stored ones."""
    captures = derived.academies(spark, sf).unionByName(derived.academy_lists(spark, sf))
    stored = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1).alias("id"),
        (F.col("s_suppkey") * 2).cast("string").alias("external_id"),
        F.lit("old").alias("name"),
        F.lit("N").alias("country_code"),
    )
    merged = academies.merge_academies(
        academies.visited_academies(captures, SITE),
        stamped(stored),
        F.lit("2026-01-01").cast("timestamp"),
    )
    top = stored.agg(F.max("id")).scalar()
    return stamp_days(merged).withColumn("stored_id", F.when(F.col("id") <= top, F.col("id"))).drop("id")


def profile_fields(spark, sf):
    """HTM-5, HTM-7 … HTM-9, AGG-3, AGG-4, AGG-8, FN-6, FN-8, FN-15, FN-17."""
    parts = pages.profile_parts(answered(derived.profiles(spark, sf)), ("url",))
    return profile_counters(parts, ("url",))


def profiles_merged(spark, sf):
    """§3.2 whole: pages and match tallies into stored athletes (JON-8, DML-5, DML-7)."""
    captures = derived.profiles(spark, sf).unionByName(derived.profile_events(spark, sf))
    stored = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1).alias("id"),
        (F.col("c_custkey") * 2).cast("string").alias("external_id"),
        F.lit("none").alias("belt_rank"),
        *[F.lit(-1).alias(c) for c in COUNTERS],
    )
    stored = stored.withColumns(
        {c: F.lit("2020-01-01").cast("timestamp") for c in ("scraped_at", "updated_at")}
    )
    now = F.lit("2026-01-01").cast("timestamp")
    matches = staged(profiles.match_pages(captures, SITE), "match-pages")
    merged = profiles.merge_profiles(profiles.profile_updates(captures, matches), stored, now)
    changed = (F.col("scraped_at") == now).alias("changed")
    return merged.select("id", "external_id", "belt_rank", *COUNTERS, changed)


def enriched_batch(spark, sf):
    """SRT-5, FLT-3, FLT-6 into DML-5: only the athletes of one batch are enriched."""
    captures = derived.profiles(spark, sf).unionByName(derived.profile_events(spark, sf))
    stored = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1).alias("id"),
        (F.col("c_custkey") * 2).cast("string").alias("external_id"),
        F.when(F.col("c_custkey") % 4 > 0, "").otherwise("black").alias("belt_rank"),
        F.lit("").alias("profile_url"),
        *[(F.col("c_custkey") % 3).cast("int").alias(c) for c in COUNTERS],
    )
    stored = stored.withColumns(
        {c: F.lit("2020-01-01").cast("timestamp") for c in ("scraped_at", "updated_at")}
    )
    now = F.lit("2026-01-01").cast("timestamp")
    batch = EnrichmentBatch.of("60", "5")
    merged = profiles.enrich(stored, captures, SITE, batch, now)
    changed = (F.col("scraped_at") == now).alias("changed")
    return merged.select("id", "external_id", "belt_rank", *COUNTERS, changed)


def host_choice(spark, sf):
    """AGG-6, FN-25: events as probe answers of a user's hosts."""
    hosts = F.array(*[F.lit(h) for h in SITE.hosts], F.lit("other.test"))
    probes = table(spark, sf, "events").select(
        "user_id",
        F.col("user_id").alias("event_id"),
        F.get(hosts, (F.col("event_id") % 9).cast("int")).alias("host"),
        F.when(F.col("event_type") == "signup", 200)
        .when(F.col("event_type") == "click", 302)
        .when(F.col("event_type") == "view", 301)
        .otherwise(404)
        .alias("status"),
        "value",
    )
    location = (
        F.when(F.col("value") < 5, F.concat("host", F.lit("/x")))
        .when(F.col("value") < 10, F.concat(F.lit("https://"), "host"))
        .otherwise(F.concat(F.lit("https://"), "host", F.lit("/x")))
    )
    rare = F.when((F.col("status") == 200) & (F.col("value") > 3), 500).otherwise(F.col("status"))
    probed = probes.withColumn("location", location).withColumn("status", rare)
    return host_of_event(probed, SITE)


QUERIES = {
    f.__name__: f
    for f in (
        page_links, html_links_parser, page_list_items, academy_fields, academies_merged,
        profile_fields, profiles_merged, enriched_batch, host_choice,
    )
}

_LINKS = """
    SELECT page_id, url, CAST(i - 1 AS INTEGER) AS pos, hrefs[i] AS href, texts[i] AS text
    FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM (
        SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
            regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts
        FROM pages))
"""
_NAME = """CASE WHEN s_suppkey % 10 = 9 THEN '' WHEN s_suppkey % 3 = 0
    THEN concat(s_name, ' / Team') ELSE concat(s_name, ' & Co') END"""
_ACADEMY = f"""
    SELECT CAST(s_suppkey AS STRING) AS external_id, {_NAME} AS name,
        regexp_replace(replace(replace(lower({_NAME}), ' ', '-'), '/', '-'), '[^a-z0-9-]', '', 'g')
            AS slug,
        concat('https://example.com/logo/', s_suppkey, '.png') AS logo_url,
        'https://example.com/en/club/x.png' AS cover_url, 'Bio boldmore' AS bio,
        concat('https://instagram.com/s', s_suppkey) AS website,
        concat('https://instagram.com/s', s_suppkey) AS instagram,
        CASE WHEN s_suppkey % 2 = 0 THEN 'http://facebook.com/f' ELSE '' END AS facebook,
        CAST(s_suppkey * 1000 AS BIGINT) AS total_wins, 0 AS total_losses, 0 AS athlete_count,
        CAST(s_suppkey % 20 AS BIGINT) AS gold_medals, 0 AS silver_medals, 0 AS bronze_medals
    FROM supplier WHERE s_suppkey % 10 <> 9
"""
_LOSSES = "CAST((c_custkey % 4 + 1) // 2 AS BIGINT)"
_BY = {
    "wins_by_submission": "c_custkey % 9",
    "wins_by_points": "c_custkey % 4",
    "wins_by_decision": "c_custkey % 6",
    "wins_by_dq": "NULL",
    "losses_by_submission": "NULL",
    "losses_by_points": "c_custkey % 8",
    "losses_by_decision": f"nullif({_LOSSES}, 0)",
    "losses_by_dq": "c_custkey % 5",
}
_WON = "c_custkey % 9 + c_custkey % 4 + c_custkey % 6"
_LOST = "c_custkey % 8 + c_custkey % 5"
_PROFILE = f"""
    SELECT CAST(c_custkey AS STRING) AS external_id,
        concat('https://example.com/en/profile/', c_custkey) AS url,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'Purple belt' WHEN 'MACHINERY' THEN 'New comer'
            WHEN 'FURNITURE' THEN 'Brown 7' END AS belt_rank,
        {', '.join(f"CAST({v} AS BIGINT) AS {k}" for k, v in _BY.items())},
        CAST(CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 WHEN {_WON} > 0 THEN {_WON} ELSE 0 END
            AS BIGINT) AS total_wins,
        CAST(CASE WHEN {_LOSSES} > 0 THEN {_LOSSES} WHEN {_LOST} > 0 THEN {_LOST} END AS BIGINT)
            AS total_losses
    FROM customer
"""


def _tally_sql() -> str:
    from meetlake.checks.payloads import SQL as payload_sql

    return payload_sql["profile_tally"]


SQL = {
    "page_links": f"""
        SELECT page_id, pos, href, concat(regexp_extract(url, '^https?://[^/?#]+'), href) AS "full",
            concat('https://example.com', href) AS under_base
        FROM ({_LINKS})""",
    "html_links_parser": f"SELECT page_id, pos, href, text FROM ({_LINKS})",
    "page_list_items": f"SELECT page_id, pos, text AS label, 'a:b' AS value FROM ({_LINKS})",
    "academy_fields": _ACADEMY,
    "academies_merged": f"""
        WITH links AS (
            SELECT CAST(n_nationkey * 3 + i AS STRING) AS external_id,
                arg_max(n_name, n_nationkey) AS country
            FROM (SELECT *, unnest(range(4)) AS i FROM nation) GROUP BY ALL),
        ba AS (SELECT a.*, country FROM ({_ACADEMY}) a JOIN links USING (external_id)),
        st AS (SELECT s_suppkey + 1 AS stored_id, CAST(s_suppkey * 2 AS STRING) AS external_id
            FROM supplier)
        SELECT stored_id, external_id, coalesce(name, 'old') AS name,
            coalesce(country, 'N') AS country_code,
            {stamps_sql("stored_id IS NULL", "name IS NOT NULL")}
        FROM st FULL JOIN ba USING (external_id)""",
    "profile_fields": f"SELECT * EXCLUDE (external_id) FROM ({_PROFILE})",
    "profiles_merged": f"""
        WITH ba AS (SELECT * FROM ({_PROFILE})), ta AS ({_tally_sql()}),
        st AS (SELECT c_custkey + 1 AS id, CAST(c_custkey * 2 AS STRING) AS external_id FROM customer)
        SELECT st.id, st.external_id, coalesce(ba.belt_rank, 'none') AS belt_rank,
            {', '.join(f"coalesce(CASE WHEN ta.{c} > 0 THEN ta.{c} ELSE ba.{c} END, -1) AS {c}" for c in COUNTERS)},
            ba.external_id IS NOT NULL AS changed
        FROM st LEFT JOIN ba ON st.external_id = ba.external_id
        LEFT JOIN ta ON ta.external_id = ba.external_id""",
    "enriched_batch": f"""
        WITH ta AS ({_tally_sql()}),
        st AS (SELECT c_custkey + 1 AS id, CAST(c_custkey * 2 AS STRING) AS external_id,
            CASE WHEN c_custkey % 4 > 0 THEN '' ELSE 'black' END AS belt_rank,
            CAST(c_custkey % 3 AS BIGINT) AS n FROM customer),
        chosen AS (SELECT id FROM st WHERE belt_rank = '' OR n = 0 ORDER BY id LIMIT 60 OFFSET 5),
        ba AS (SELECT p.* FROM ({_PROFILE}) p JOIN st ON st.external_id = p.external_id
            WHERE st.id IN (SELECT id FROM chosen))
        SELECT st.id, st.external_id, coalesce(ba.belt_rank, st.belt_rank) AS belt_rank,
            {', '.join(f"coalesce(CASE WHEN ta.{c} > 0 THEN ta.{c} ELSE ba.{c} END, st.n) AS {c}" for c in COUNTERS)},
            ba.external_id IS NOT NULL AS changed
        FROM st LEFT JOIN ba ON st.external_id = ba.external_id
        LEFT JOIN ta ON ta.external_id = ba.external_id""",
    "host_choice": f"""
        WITH hosts(rank, host) AS (VALUES {', '.join(f"({i}, '{h}')" for i, h in enumerate(SITE.hosts))}),
        usable AS (SELECT user_id, min(event_id % 9) AS rank FROM events
            WHERE event_id % 9 < 8 AND ((event_type = 'signup' AND value <= 3)
                OR (event_type IN ('click', 'view') AND value < 10))
            GROUP BY user_id)
        SELECT e.user_id AS event_id, coalesce(h.host, 'example.com') AS host
        FROM (SELECT DISTINCT user_id FROM events) e
        LEFT JOIN usable u ON u.user_id = e.user_id LEFT JOIN hosts h ON h.rank = u.rank""",
}
