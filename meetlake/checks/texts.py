"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meetlake.checks.stand_ins import SITE, split, table
from meetlake.functions import labels, numbers, places, text, urls


def _documents(spark, sf):
    return split(spark, sf, "documents")


def category_parts(spark, sf):
    """FN-5 on phrases of four, three or five parts."""
    category = F.concat_ws(
        " / ",
        "o_orderpriority",
        "o_orderstatus",
        F.lit("Beginner "),
        F.when(F.col("o_orderkey") % 3 > 0, "-60 kg"),
        F.when(F.col("o_orderkey") % 3 > 1, "x"),
    )
    parts = text.category_parts(category)
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in parts.items()]
    )


def full_names(spark, sf):
    """FN-16."""
    middle = F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.lower("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey", text.full_name(F.lit("Ana"), middle, F.col("c_name")).alias("full_name")
    )


def document_labels(spark, sf):
    """FN-0, FN-8: whole texts as labels."""
    padded = F.concat(F.lit("\t  "), F.col("text"), F.lit("　\n"))
    return _documents(spark, sf).select(
        "doc_id",
        F.md5(text.strip(padded)).alias("stripped"),
        F.md5(text.normal_label(F.col("text"))).alias("label"),
    )


def document_numbers(spark, sf):
    """FN-6, FN-7 on whole texts and on numbers with commas."""
    commas = F.concat(F.lit(" "), F.format_number("n_chars", 0))
    return _documents(spark, sf).select(
        "doc_id",
        numbers.first_int(F.col("text")).alias("first_in_text"),
        numbers.first_int(commas).alias("first_int"),
        numbers.comma_int(commas).alias("comma_int"),
        numbers.comma_int(F.col("source")).alias("no_number"),
    )


def document_slugs(spark, sf):
    """FN-4 on whole texts."""
    return _documents(spark, sf).select("doc_id", F.md5(text.slug(F.col("text"))).alias("slug"))


def document_methods(spark, sf):
    """FN-9, FN-10, FN-17, FN-27: classes of free text, two orders of methods."""
    words = F.concat_ws(
        " ",
        F.when(F.col("doc_id") % 2 == 0, "winner by"),
        F.when(F.col("doc_id") % 3 == 0, "Points and"),
        F.when(F.col("doc_id") % 5 == 0, "decision of"),
        F.when(F.col("doc_id") % 7 == 0, "submission"),
        F.when(F.col("doc_id") % 11 == 0, "DQ loss"),
        "text",
    )
    outcome = labels.normal_outcome(words)
    return _documents(spark, sf).select(
        "doc_id",
        labels.outcome_method(outcome).alias("method"),
        labels.is_bye(outcome).alias("bye"),
        labels.stat_counter(text.normal_label(words)).alias("counter"),
    )


def belt_ranks(spark, sf):
    """FN-15 on segments as belts."""
    shown = (
        F.when(F.col("c_mktsegment") == "BUILDING", " PURPLE  Belt II ")
        .when(F.col("c_mktsegment") == "MACHINERY", "xblack belt")
        .when(F.col("c_mktsegment") == "FURNITURE", "old Black\tbelt")
        .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment")))
    )
    return table(spark, sf, "customer").select("c_custkey", labels.belt_rank(shown).alias("belt_rank"))


def location_split(spark, sf):
    """FN-20 on the comma-separated words of part names."""
    spans = F.array(
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" , "),
        F.concat(F.lit(" "), F.element_at(F.split("p_name", " "), 1), F.lit(",")),
        F.when(F.col("p_size") % 3 > 0, F.element_at(F.split("p_name", " "), 2)).otherwise(""),
    )
    parts = places.location_parts(spans)
    return table(spark, sf, "part").select(
        "p_partkey", places.city_of(parts).alias("city"), places.country_of(parts).alias("country")
    )


def flag_countries(spark, sf):
    """FN-19, FN-26."""
    css = F.when(
        F.col("c_custkey") % 3 > 0,
        F.concat(F.lit("flag-icon flag-icon-"), F.lower(F.substring("c_mktsegment", 1, 2))),
    )
    asked = F.concat(F.lit(" n"), F.col("c_nationkey"))
    return table(spark, sf, "customer").select(
        "c_custkey", places.flag_country(css, asked).alias("country_code")
    )


def country_tables(spark, sf):
    """FN-11, FN-12."""
    codes = F.array(*[F.lit(c) for c in ("AR", "BR", "CL", "MX", "EC", "VE", "PE", "CO", "US")])
    code = F.get(codes, (F.col("c_custkey") % 9).cast("int"))
    name = F.when(F.col("c_custkey") % 2 == 0, places.country_name(code)).otherwise("México")
    return table(spark, sf, "customer").select(
        "c_custkey", name.alias("name"), places.country_code(name).alias("code")
    )


def country_list(spark, sf):
    """FN-23 on the commas of whole texts."""
    items = text.comma_list(F.col("text"))
    return _documents(spark, sf).select(
        "doc_id",
        F.size(items).alias("n_items"),
        F.md5(F.array_join(items, "|")).alias("items"),
    )


def days_text(spark, sf):
    """FN-13."""
    days = F.when(F.col("value") < 50, F.floor("value").cast("int") - 10)
    return table(spark, sf, "events").select("event_id", text.days_text(days).alias("days_text"))


def birth_year(spark, sf):
    """FN-18."""
    year = F.concat(
        F.when(F.col("c_custkey") % 4 == 0, " ").when(F.col("c_custkey") % 4 == 1, "n").otherwise(""),
        (F.col("c_custkey") % 60 + 1950).cast("string"),
    )
    return table(spark, sf, "customer").select("c_custkey", numbers.birth_year(year).alias("birth_year"))


def flexible_numbers(spark, sf):
    """FN-14: null, empty, numeric text, other text."""
    value = (
        F.when(F.col("p_size") % 5 == 0, "")
        .when(F.col("p_size") % 5 == 1, "x1")
        .when(F.col("p_size") % 5 > 2, F.col("p_retailprice").cast("string"))
    )
    return table(spark, sf, "part").select(
        "p_partkey",
        numbers.flexible_double(value).alias("number"),
        F.coalesce(numbers.is_bad_flexible_double(value), F.lit(False)).alias("is_bad"),
    )


def event_names(spark, sf):
    """FN-28."""
    name = F.when(F.col("o_orderkey") % 3 == 0, "").when(
        F.col("o_orderkey") % 3 == 1, F.col("o_orderpriority")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.event_name_or_default(name, F.col("o_orderkey").cast("string")).alias("event_name"),
    )


def built_urls(spark, sf):
    """FN-21, FN-22."""
    key = F.col("c_custkey").cast("string")
    country = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("n "), F.col("c_nationkey")))
    page = urls.event_url(F.lit("adcc.example.com"), key)
    return table(spark, sf, "customer").select(
        "c_custkey",
        urls.participants_url(F.lit("example.com"), key).alias("participants"),
        urls.profile_url(F.col("c_custkey"), SITE).alias("profile"),
        urls.listing_url("past", country, SITE).alias("listing"),
        urls.side_document_url(page, key, "getCmsData").alias("side"),
    )


def page_segments(spark, sf):
    """FN-1."""
    return table(spark, sf, "pages").select(
        "page_id", urls.last_segment(F.col("url")).alias("segment")
    )


def page_hosts(spark, sf):
    """FN-2: hosts of the site's own domain, any other page counts as the main one."""
    return table(spark, sf, "pages").select(
        "page_id", urls.site_host(F.col("url"), SITE).alias("host")
    )


def page_slugs(spark, sf):
    """HTM-2, FN-4: heading by flat tag, as a slug."""
    heading = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return table(spark, sf, "pages").select("page_id", text.slug(heading).alias("slug"))


def redirects(spark, sf):
    """FN-25 on page addresses as redirect targets."""
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    target = (
        F.when(F.col("page_id") % 4 == 0, host)
        .when(F.col("page_id") % 4 == 1, F.concat(host, F.lit("/x")))
        .when(F.col("page_id") % 4 == 2, F.concat(host, F.lit(".x/y")))
        .otherwise(F.col("url"))
    )
    return table(spark, sf, "pages").select("page_id", urls.same_domain(target, host).alias("same"))


QUERIES = {
    f.__name__: f
    for f in (
        category_parts, full_names, document_labels, document_numbers, document_slugs,
        document_methods, belt_ranks, location_split, flag_countries, country_tables,
        country_list, days_text, birth_year, flexible_numbers, event_names, built_urls,
        page_segments, page_hosts, page_slugs, redirects,
    )
}

# White space as DuckDB's regular expressions write it.
_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORDS = """concat_ws(' ', CASE WHEN doc_id % 2 = 0 THEN 'winner by' END,
    CASE WHEN doc_id % 3 = 0 THEN 'Points and' END,
    CASE WHEN doc_id % 5 = 0 THEN 'decision of' END,
    CASE WHEN doc_id % 7 = 0 THEN 'submission' END,
    CASE WHEN doc_id % 11 = 0 THEN 'DQ loss' END, text)"""


def _stripped(value: str) -> str:
    return f"regexp_replace({value}, '^{_WS}+|{_WS}+$', '', 'g')"


def _method_sql(order: str) -> str:
    tests = " ".join(f"WHEN contains(w, '{m}') THEN '{m}'" for m in order.split())
    return (
        f"CASE {tests} WHEN contains(w, 'dq') OR contains(w, 'disqualification') THEN 'dq' "
        "ELSE '' END"
    )


SQL = {
    "category_parts": """
        SELECT o_orderkey, CASE WHEN four THEN o_orderpriority ELSE '' END AS division,
            CASE WHEN four THEN o_orderstatus ELSE '' END AS age_category,
            CASE WHEN four THEN 'Beginner' ELSE '' END AS rank,
            CASE WHEN four THEN '-60 kg' ELSE '' END AS weight_class
        FROM (SELECT *, o_orderkey % 3 > 0 AS four FROM orders)""",
    "full_names": """
        SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN concat('Ana ', c_name)
            ELSE concat('Ana ', lower(c_mktsegment), ' ', c_name) END AS full_name
        FROM customer""",
    "document_labels": f"""
        SELECT doc_id, md5({_stripped("text")}) AS stripped,
            md5(regexp_replace(lower({_stripped("text")}), '{_WS}+', ' ', 'g')) AS label
        FROM documents""",
    "document_numbers": """
        SELECT doc_id,
            TRY_CAST(nullif(regexp_extract(text, '[0-9]+'), '') AS BIGINT) AS first_in_text,
            CAST(regexp_extract(format('{:,}', n_chars), '[0-9]+') AS BIGINT) AS first_int,
            CAST(n_chars AS BIGINT) AS comma_int, 0::BIGINT AS no_number
        FROM documents""",
    "document_slugs": """
        SELECT doc_id, md5(regexp_replace(
            replace(replace(lower(text), ' ', '-'), '/', '-'), '[^a-z0-9-]', '', 'g')) AS slug
        FROM documents""",
    "document_methods": f"""
        SELECT doc_id, {_method_sql("submission decision points")} AS method,
            contains(w, 'bye') OR contains(w, 'walkover') AS bye,
            CASE WHEN contains(w, 'win') THEN CASE WHEN m = '' THEN 'total_wins'
                    ELSE concat('wins_by_', m) END
                WHEN contains(w, 'loss') THEN CASE WHEN m = '' THEN 'total_losses'
                    ELSE concat('losses_by_', m) END END AS counter
        FROM (SELECT *, {_method_sql("submission points decision")} AS m
            FROM (SELECT doc_id, lower({_WORDS}) AS w FROM documents))""",
    "belt_ranks": """
        SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Purple belt'
            WHEN 'MACHINERY' THEN 'xblack belt' WHEN 'FURNITURE' THEN 'Black belt'
            ELSE c_mktsegment END AS belt_rank
        FROM customer""",
    "location_split": """
        SELECT p_partkey,
            CASE WHEN len(p) >= 2 THEN array_to_string(p[1:len(p) - 1], ', ') ELSE '' END AS city,
            coalesce(p[len(p)], '') AS country
        FROM (SELECT p_partkey, list_filter([
                CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END, split_part(p_name, ' ', 1),
                CASE WHEN p_size % 3 > 0 THEN split_part(p_name, ' ', 2) ELSE '' END],
                lambda s: s <> '') AS p
            FROM part)""",
    "flag_countries": """
        SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN substr(c_mktsegment, 1, 2)
            ELSE concat('N', c_nationkey) END AS country_code
        FROM customer""",
    "country_tables": """
        WITH t(i, c, n) AS (VALUES (0, 'AR', 'Argentina'), (1, 'BR', 'Brazil'), (2, 'CL', 'Chile'),
            (3, 'MX', 'Mexico'), (4, 'EC', 'Ecuador'), (5, 'VE', 'Venezuela'), (6, 'PE', 'Peru'),
            (7, 'CO', 'Colombia'), (8, '', 'US'))
        SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN n ELSE 'México' END AS name,
            CASE WHEN c_custkey % 2 = 0 THEN c ELSE 'MX' END AS code
        FROM customer JOIN t ON c_custkey % 9 = i""",
    "country_list": f"""
        SELECT doc_id, CAST(len(items) AS INTEGER) AS n_items,
            md5(array_to_string(items, '|')) AS items
        FROM (SELECT doc_id, list_filter(list_transform(string_split(text, ','),
                lambda s: {_stripped("s")}), lambda s: s <> '') AS items
            FROM documents)""",
    "days_text": """
        SELECT event_id, CASE WHEN value >= 50 THEN ''
            WHEN floor(value) >= 10 THEN concat(CAST(floor(value) - 10 AS INT), ' days left')
            ELSE concat(CAST(10 - floor(value) AS INT), ' days ago') END AS days_text
        FROM events""",
    "birth_year": """
        SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN 0
            ELSE CAST(c_custkey % 60 + 1950 AS BIGINT) END AS birth_year
        FROM customer""",
    "flexible_numbers": """
        SELECT p_partkey, CASE WHEN p_size % 5 > 2 THEN p_retailprice END AS number,
            p_size % 5 = 1 AS is_bad
        FROM part""",
    "event_names": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority
            ELSE concat('Event ', o_orderkey) END AS event_name
        FROM orders""",
    "built_urls": """
        SELECT c_custkey,
            concat('https://example.com/en/event/', c_custkey, '/participants') AS participants,
            concat('https://example.com/en/profile/', c_custkey) AS profile,
            concat('https://example.com/en/events/past', CASE WHEN c_custkey % 2 = 0
                THEN concat('?countries=N+', c_nationkey) ELSE '' END) AS listing,
            concat('https://adcc.example.com/en/event/', c_custkey, '/getCmsData') AS side
        FROM customer""",
    "page_segments": "SELECT page_id, string_split(url, '/')[-1] AS segment FROM pages",
    "page_hosts": r"""
        SELECT page_id, coalesce(nullif(regexp_extract(
            url, 'https?://(([a-z0-9\-]+\.)?example\.com)', 1), ''), 'example.com') AS host
        FROM pages""",
    "page_slugs": """
        SELECT page_id, regexp_replace(replace(replace(lower(
            regexp_extract(html, '<h1>(.*?)</h1>', 1)), ' ', '-'), '/', '-'),
            '[^a-z0-9-]', '', 'g') AS slug
        FROM pages""",
    "redirects": """
        SELECT page_id, CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false
            ELSE ends_with(url, split_part(url, '/', 3)) END AS same
        FROM pages""",
}
