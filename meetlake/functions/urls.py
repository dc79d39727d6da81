"""Address helpers on Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from meetlake.functions.text import strip
from meetlake.site import Site

LISTING_KINDS = ("past", "upcoming")


def last_segment(url: Column) -> Column:
    """Text after the last slash; a query string stays (FN-1)."""
    return F.substring_index(url, "/", -1)


def site_host(url: Column, site: Site) -> Column:
    """Host of a site address, at most one lower-case prefix; else the domain (FN-2)."""
    pattern = rf"https?://((?:[a-z0-9\-]+\.)?{re.escape(site.domain)})"
    host = F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)
    return F.when(host == "", site.domain).otherwise(host)


def _has_scheme(href: Column) -> Column:
    return F.startswith(href, F.lit("http://")) | F.startswith(href, F.lit("https://"))


def under_base(href: Column, base_url: str) -> Column:
    """Full address of an event link (FN-3): blank stays empty, http(s) is kept."""
    path = strip(F.coalesce(href, F.lit("")))
    base = base_url.rstrip("/")
    return (
        F.when((path == "") | _has_scheme(path), path)
        .when(F.startswith(path, F.lit("/")), F.concat(F.lit(base), path))
        .otherwise(F.concat(F.lit(base + "/"), path))
    )


def resolved(href: Column, page_url: Column) -> Column:
    """Address of a link relative to the page it stands on; a bare fragment is none.

    Dot segments inside a path are left as they are.
    """
    link = strip(href)
    origin = F.regexp_extract(page_url, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(page_url, r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(
        F.concat(folder, F.lit("/"))
    )
    return (
        F.when((link == "") | F.startswith(link, F.lit("#")), "")
        .when(_has_scheme(link), link)
        .when(
            F.startswith(link, F.lit("//")),
            F.concat(F.substring_index(page_url, "//", 1), link),
        )
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .otherwise(F.concat(folder, F.regexp_replace(link, r"^\./", "")))
    )


def same_domain(location: Column, host: Column) -> Column:
    """Redirect stays on the host: equal, host plus slash first, or host last (FN-25).

    Not a general contains: "https://host/path" is no hit, as it neither starts nor
    ends with the host.
    """
    return F.startswith(location, F.concat(host, F.lit("/"))) | F.endswith(location, host)


def participants_url(host: Column, event_id: Column) -> Column:
    """Address of the participants payload (FN-21)."""
    return F.format_string("https://%s/en/event/%s/participants", host, event_id)


def event_url(host: Column, event_id: Column) -> Column:
    return F.format_string("https://%s/en/event/%s", host, event_id)


def profile_url(user_id: Column, site: Site) -> Column:
    return F.format_string(f"{site.base_url}/en/profile/%s", user_id.cast("string"))


def listing_url(kind: str, country: Column, site: Site) -> Column:
    """Address of an event listing, filtered by country if one is given (FN-21)."""
    if kind not in LISTING_KINDS:
        raise ValueError(f"listing kind must be one of {LISTING_KINDS}: {kind!r}")
    plain = F.lit(f"{site.base_url}/en/events/{kind}")
    return F.when(F.coalesce(country, F.lit("")) == "", plain).otherwise(
        F.concat(plain, F.lit("?countries="), F.url_encode(F.upper(country)))
    )


def side_document_url(event_page_url: Column, event_id: Column, suffix: str) -> Column:
    """Address of a side document of an event page, on the page's own host (FN-22)."""
    origin = F.regexp_extract(event_page_url, r"^(https?://[^/?#]+)", 1)
    return F.format_string(f"%s/en/event/%s/{suffix}", origin, event_id)


def follow_up_url(next_url: Column, site: Site) -> Column:
    """Next page address: relative links get the site address, empty stays null."""
    return F.when(
        F.startswith(next_url, F.lit("/")), F.concat(F.lit(site.base_url), next_url)
    ).otherwise(F.nullif(next_url, F.lit("")))
