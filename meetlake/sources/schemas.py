"""Schemas of captures, payloads and entity tables."""

from __future__ import annotations

CAPTURES = """
    url string, kind string, fetched_at timestamp, status int, location string,
    content_type string, country string, event_name string, body string
"""

# Payload fields that must be JSON strings are read as VARIANT: a string field would take
# a number or an object as its text without complaint, a variant keeps the JSON type.
CORRUPT = "_corrupt string"

REG_CATEGORY = """
    event_registration_id bigint, category_value_id bigint, event_category_id bigint,
    sort_order bigint, estimated_weight double, weight_measured variant
"""
REGISTRATION = f"""
    id bigint, approved bigint, status variant, club_id bigint, affiliation_id bigint,
    seed_position bigint, affiliationName variant, age bigint, birth variant,
    bracket_seed bigint, categories array<struct<{REG_CATEGORY}>>, clubName variant,
    cn variant, country variant, event_group_id bigint, firstname variant, gender variant,
    lastname variant, middle_name variant, profile_image variant, profile_image_id bigint,
    public_note variant, scoring_athlete bigint, status2 variant, teamName variant,
    trashed bigint, user_id bigint
"""
REGISTRATION_TEXTS = (
    "status", "affiliationName", "birth", "clubName", "cn", "country", "firstname",
    "gender", "lastname", "middle_name", "profile_image", "public_note", "status2",
    "teamName",
)
PARTICIPANT = f"""
    bracket_id bigint, entry_id bigint, event_id bigint, id bigint, name variant,
    registrations array<struct<{REGISTRATION}>>
"""
CATEGORY = """
    event_category_id bigint, category_name variant, datatype variant,
    datatype_weight_unit variant, id bigint, name variant, weight_maximum variant,
    weight_minimum variant
"""
CATEGORY_TEXTS = ("category_name", "datatype", "datatype_weight_unit", "name")
CATEGORY_WEIGHTS = ("weight_maximum", "weight_minimum")
PARTICIPANTS_PAYLOAD = f"""
    participants array<struct<{PARTICIPANT}>>, categories array<struct<{CATEGORY}>>, {CORRUPT}
"""

PROFILE_EVENTS_PAYLOAD = f"""
    data array<struct<registrations array<struct<matches array<struct<
        is_winner boolean, outcome variant>>>>>>,
    next_page_url variant, {CORRUPT}
"""

_STAMPS = "scraped_at timestamp, created_at timestamp, updated_at timestamp"

ACADEMIES = f"""
    id bigint, external_id string, name string, slug string, country string,
    country_code string, logo_url string, cover_url string, bio string, website string,
    instagram string, facebook string, total_wins bigint, total_losses bigint,
    athlete_count bigint, gold_medals bigint, silver_medals bigint, bronze_medals bigint, {_STAMPS}
"""
ATHLETES = f"""
    id bigint, external_id string, first_name string, last_name string, full_name string,
    academy_external_id string, nationality string, country_code string,
    belt_rank string, age bigint, gender string, profile_url string, avatar_url string,
    birth_year bigint, image_url string, affiliation_name string, total_wins bigint,
    wins_by_submission bigint, wins_by_points bigint, wins_by_decision bigint, wins_by_dq bigint,
    total_losses bigint, losses_by_submission bigint, losses_by_points bigint,
    losses_by_decision bigint, losses_by_dq bigint, {_STAMPS}
"""
EVENTS = f"""
    id bigint, external_id string, name string, event_url string, image_url string,
    city string, country string, country_code string, date_text string,
    days_text string, event_type string, section string, {_STAMPS}
"""
EVENT_DETAILS = f"""
    id bigint, event_id string, event_url string, name string, description string,
    start_date string, end_date string, image_url string, location_name string,
    location_city string, location_country string, location_address string,
    organizer_name string, info_panels_json string, info_page_blocks_json string,
    {_STAMPS}
"""
EVENT_REGISTRATIONS = """
    id bigint, athlete_id bigint, event_id string, event_name string, division string,
    age_category string, rank string, weight_class string, actual_weight double,
    seed bigint, ranking bigint, event_card_url string, registration_date timestamp,
    created_at timestamp, updated_at timestamp
"""
RUN_LOG = """
    run_id bigint, job_type string, status string, event_time timestamp,
    items_scraped bigint, error_message string
"""

ENTITY_TABLES = {
    "academies": ACADEMIES,
    "athletes": ATHLETES,
    "events": EVENTS,
    "event_details": EVENT_DETAILS,
    "event_registrations": EVENT_REGISTRATIONS,
    "event_detail_keys": "key string, id bigint",
    "event_hosts": "event_id string, host string",
    "runs": RUN_LOG,
}

REGISTRATION_KEY = (
    "athlete_id", "event_id", "division", "age_category", "rank", "weight_class",
)
# Columns whose hash names the bucket of a row. Event details are matched on two columns: a table
# of both kinds of key names the rows they belong to.
ENTITY_BUCKET_KEYS = {
    "academies": ("external_id",),
    "athletes": ("external_id",),
    "events": ("event_url",),
    "event_details": ("id",),
    "event_detail_keys": ("key",),
    "event_registrations": ("athlete_id",),
    "event_hosts": ("event_id",),
}
# Owner of the rows of each table of parts: a batch reads those of the owners it touches.
PART_OWNERS = {
    "_academy_links": "external_id",
    "_academy_pages": "external_id",
    "_listed_events": "event_url",
    "_event_pages": "event_id",
    "_event_documents": "event_id",
    "_registrations": "external_id",
    "_members": "academy_name",
    "_match_pages": "external_id",
    "_profile_pages": "external_id",
    "_probes": "event_id",
}
ENTITY_KEYS = {
    "academies": ("external_id",),
    "athletes": ("external_id",),
    "events": ("event_url",),
    "event_details": ("event_id",),
    "event_registrations": REGISTRATION_KEY,
}
