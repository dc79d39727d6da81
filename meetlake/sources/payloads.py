"""JSON payloads of captures: strict decode, unnest, projections.

A payload is refused whole if any field has another JSON type than its schema says
(JSN-1). Numbers and booleans are checked by `from_json` itself, which reports a mismatch
at any depth in the corrupt-record column. Text fields are read as VARIANT and checked
here. Each body is parsed once and dropped right after.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetlake.functions import numbers, text, urls
from meetlake.functions.places import upper_code
from meetlake.site import Site
from meetlake.sources import schemas
from meetlake.sources.captures import of_kind, refusal


def is_json(value: Column, *kinds: str) -> Column:
    """Variant is of one of the JSON types: STRING, OBJECT, ARRAY, BIGINT, VOID …

    Nested and decimal types carry arguments, so they are compared by how they start.
    """
    shape = F.schema_of_variant(value)
    plain = [k for k in kinds if k not in ("OBJECT", "ARRAY", "DECIMAL")]
    tests = [shape.isin(*plain)] if plain else []
    tests += [F.startswith(shape, F.lit(k)) for k in kinds if k not in plain]
    return any_of(tests)


def is_type_fault(value: Column, kind: str) -> Column:
    """True unless the variant is missing, null or of the given JSON type."""
    return F.coalesce(~is_json(value, "VOID", kind), F.lit(False))


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def text_of(value: Column) -> Column:
    """Text of a variant, null unless it is a JSON string."""
    return F.when(is_json(value, "STRING"), F.try_variant_get(value, "$", "string"))


def sound_text(value: Column) -> Column:
    """Text of a variant that is known to be a JSON string, null or missing."""
    return F.try_variant_get(value, "$", "string")


def unnested(
    rows: DataFrame,
    array: Column,
    *columns,
    item: str,
    position: str = "_pos",
    or_if: Column | None = None,
) -> DataFrame:
    """`columns` with one row per array element; rows without elements vanish, but for
    those with `or_if`.

    The outer form plus a filter on its position, and not the inner form: for that one
    the optimizer puts size tests on the array below the parse, which then runs again
    for each of them.
    """
    exploded = rows.select(*columns, F.posexplode_outer(array).alias(position, item))
    kept = F.col(position).isNotNull()
    return exploded.filter(kept if or_if is None else kept | or_if)


def those(rows: DataFrame, keep: Column, *columns) -> DataFrame:
    """`columns` of the rows where `keep` holds, for a costly `keep`.

    The test is made in the projection and not by a filter, which the optimizer would move
    below it and so evaluate everything `keep` is made of a second time.
    """
    packed = F.when(keep, F.array(F.struct(*columns)))
    return (
        rows.select(F.explode_outer(packed).alias("row"))
        .filter(F.col("row").isNotNull())
        .select("row.*")
    )


def quarantine(decoded: DataFrame) -> DataFrame:
    """Refused captures with the reason."""
    about = ("url", "kind", "fetched_at", "status", "fault")
    return those(decoded, F.col("fault").isNotNull(), *about)


def _decoded(captures: DataFrame, schema: str) -> DataFrame:
    payload = F.from_json("body", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return captures.withColumn("payload", payload)


def _is_unreadable(payload: Column) -> Column:
    return payload.isNull() | payload["_corrupt"].isNotNull()


# --- participants of one event (SRC-1) -------------------------------------------------


def _participants_fault(payload: Column) -> Column:
    def bad_texts(row, fields):
        return any_of(is_type_fault(row[f], "STRING") for f in fields)

    def bad_registration(reg):
        bad_weight = F.exists(
            reg["categories"], lambda c: is_type_fault(c["weight_measured"], "STRING")
        )
        return bad_texts(reg, schemas.REGISTRATION_TEXTS) | F.coalesce(bad_weight, F.lit(False))

    def bad_group(group):
        inside = F.exists(group["registrations"], bad_registration)
        return is_type_fault(group["name"], "STRING") | F.coalesce(inside, F.lit(False))

    def bad_limit(value):
        # number, numeric text, empty text or null (FN-14)
        bad_text = numbers.is_bad_flexible_double(text_of(value))
        known = is_json(value, "VOID", "STRING", "BIGINT", "DECIMAL", "DOUBLE")
        return F.coalesce(~known | bad_text, F.lit(False))

    def bad_category(row):
        limits = any_of(bad_limit(row[f]) for f in schemas.CATEGORY_WEIGHTS)
        return bad_texts(row, schemas.CATEGORY_TEXTS) | limits

    return (
        _is_unreadable(payload)
        | F.coalesce(F.exists(payload["participants"], bad_group), F.lit(False))
        | F.coalesce(F.exists(payload["categories"], bad_category), F.lit(False))
    )


def decode_participants(captures: DataFrame) -> DataFrame:
    """Participants captures with `payload` and `fault` (why refused, else null)."""
    decoded = _decoded(of_kind(captures, "participants"), schemas.PARTICIPANTS_PAYLOAD)
    # text after the object: the JSON parser stops at the closing bracket
    trailing = ~F.endswith(text.strip(F.coalesce("body", F.lit(""))), F.lit("}"))
    fault = refusal(_participants_fault(F.col("payload")) | trailing)
    event_id = F.regexp_extract("url", "/event/([^/?#]+)", 1)
    return decoded.select(
        "url",
        "kind",
        "fetched_at",
        "status",
        event_id.alias("event_id"),
        text.event_name_or_default(F.col("event_name"), event_id).alias("event_name"),
        "payload",
        fault.alias("fault"),
    )


def payload_counts(decoded: DataFrame) -> DataFrame:
    """Groups, category definitions and registrations per participants capture."""
    groups = F.col("payload.participants")
    registrations = F.aggregate(
        groups,
        F.lit(0),
        lambda n, g: n + F.greatest(F.coalesce(F.size(g["registrations"]), F.lit(0)), F.lit(0)),
    )
    return those(
        decoded,
        F.col("fault").isNull(),
        "url",
        "event_id",
        F.coalesce(F.size(groups), F.lit(0)).alias("n_groups"),
        F.coalesce(F.size("payload.categories"), F.lit(0)).alias("n_categories"),
        F.coalesce(registrations, F.lit(0)).alias("n_registrations"),
    )


def registrations(decoded: DataFrame, keep_refused: bool = False) -> DataFrame:
    """Unnest groups and registrations of sound payloads, with positions (JSN-2).

    Groups without registrations vanish. No registration is filtered by its `approved`,
    `status` or `trashed` (FLT-8). `keep_refused` adds one bare row per refused capture,
    so that one pass over the bodies serves the rows and the quarantine.
    """
    about = ("url", "kind", "fetched_at", "status", "event_id", "event_name", "fault")
    sound = F.when(F.col("fault").isNull(), F.col("payload.participants"))
    refused = F.col("fault").isNotNull() if keep_refused else None
    groups = unnested(
        decoded, sound, *about, item="g", position="group_pos", or_if=refused
    )
    # the group's name is read once, not once per registration
    parts = text.category_parts(text.or_empty(sound_text(F.col("g.name"))))
    named = groups.select(
        *about,
        "group_pos",
        F.struct(*[part.alias(n) for n, part in parts.items()]).alias("category"),
        F.col("g.registrations").alias("regs"),
    )
    return unnested(
        named,
        F.col("regs"),
        *about,
        "group_pos",
        "category",
        item="r",
        position="reg_pos",
        or_if=refused,
    )


def event_athletes(unnested: DataFrame, site: Site) -> DataFrame:
    """Flat athlete and registration record of each unnested row (PRJ-1)."""

    def words(name):
        return text.or_empty(sound_text(F.col(f"r.{name}")))

    first, middle, last = words("firstname"), words("middle_name"), words("lastname")
    weights = F.transform("r.categories", lambda c: sound_text(c["weight_measured"]))
    user_id = text.or_zero(F.col("r.user_id"))
    flat = unnested.select(
        "url",
        "kind",
        "fetched_at",
        "status",
        "fault",
        "event_id",
        "event_name",
        "group_pos",
        "reg_pos",
        user_id.cast("string").alias("external_id"),
        first.alias("first_name"),
        middle.alias("middle_name"),
        last.alias("last_name"),
        text.full_name(first, middle, last).alias("full_name"),
        words("country").alias("nationality"),
        upper_code(words("cn")).alias("country_code"),
        numbers.birth_year(words("birth")).alias("birth_year"),
        text.or_zero(F.col("r.age")).alias("age"),
        words("clubName").alias("academy_name"),
        words("affiliationName").alias("affiliation_name"),
        urls.profile_url(user_id, site).alias("profile_url"),
        words("profile_image").alias("image_url"),
        "category.*",
        numbers.first_weight(weights).alias("actual_weight"),
        text.or_zero(F.col("r.seed_position")).alias("seed"),
        F.lit(0).cast("bigint").alias("ranking"),
        words("gender").alias("gender"),
    )
    # The record must have an id and a name (FLT-5); as both always hold text, this
    # drops nothing, but it states what the saved rows rely on.
    return flat.filter((F.col("external_id") != "") & (F.col("full_name") != ""))


def field_check(decoded: DataFrame) -> DataFrame:
    """Data-quality view of sound payloads: which required fields the first registration
    lacks, and whether groups are there at all."""
    first = F.get(F.get(F.col("payload.participants"), F.lit(0))["registrations"], F.lit(0))
    required = ("firstname", "lastname", "country", "cn", "birth")
    missing = [
        F.when(F.coalesce(text_of(first[f]), F.lit("")) == "", F.lit(f)) for f in required
    ]
    missing += [F.when(first[f].isNull(), F.lit(f)) for f in ("user_id", "age")]
    return those(
        decoded,
        F.col("fault").isNull(),
        "url",
        (F.coalesce(F.size("payload.participants"), F.lit(0)) > 0).alias("has_groups"),
        F.array_sort(F.array_compact(F.array(*missing))).alias("missing_fields"),
    )


# --- fights of a profile (SRC-2) -------------------------------------------------------


def decode_profile_events(captures: DataFrame, site: Site) -> DataFrame:
    """Profile-events captures with `payload`, `fault`, athlete and next page address."""

    def bad_match(m):
        return is_type_fault(m["outcome"], "STRING")

    def bad_registration(reg):
        return F.coalesce(F.exists(reg["matches"], bad_match), F.lit(False))

    def bad_event(event):
        return F.coalesce(F.exists(event["registrations"], bad_registration), F.lit(False))

    decoded = _decoded(of_kind(captures, "profile_events"), schemas.PROFILE_EVENTS_PAYLOAD)
    payload = F.col("payload")
    fault = (
        _is_unreadable(payload)
        | is_type_fault(payload["next_page_url"], "STRING")
        | F.coalesce(F.exists(payload["data"], bad_event), F.lit(False))
    )
    return decoded.select(
        "url",
        "kind",
        "fetched_at",
        "status",
        F.regexp_extract("url", "/profile/([^/?#]+)/events", 1).alias("external_id"),
        "payload",
        urls.follow_up_url(text_of(payload["next_page_url"]), site).alias("next_url"),
        refusal(fault).alias("fault"),
    )


def profile_matches(decoded: DataFrame) -> DataFrame:
    """Unnest events, registrations and matches of sound payloads (JSN-4)."""
    about = ("external_id", "url", "fetched_at")
    sound = F.when(F.col("fault").isNull(), F.col("payload.data"))
    events = unnested(decoded, sound, *about, item="e")
    regs = unnested(events, F.col("e.registrations"), *about, item="r")
    matches = unnested(regs, F.col("r.matches"), *about, item="m")
    return matches.select(
        *about,
        F.coalesce("m.is_winner", F.lit(False)).alias("is_winner"),
        text.or_empty(sound_text(F.col("m.outcome"))).alias("outcome"),
    )


# --- event listing: array inside a script (HTM-11, HTM-12) -----------------------------

EMBEDDED_TEXTS = (
    "title", "cover_image", "cover_image_fallback", "url", "eventPeriod",
    "location_country", "location_country_human", "location_city", "startdate", "enddate",
)
EMBEDDED_EVENT = "struct<id variant, days_to_start variant, eventEnded variant, {}>".format(
    ", ".join(f"{name} variant" for name in EMBEDDED_TEXTS)
)


def array_after(page: Column, marker: str, element: str) -> Column:
    """Array that follows a marker text in a page, null if there is no sound one (HTM-11).

    The JSON parser reads from the first "[" after the marker to the bracket that matches
    it: brackets inside strings and the rest of the script do no harm, and an array that
    never ends is null.
    """
    start = F.call_function("locate", F.lit("["), page, F.instr(page, F.lit(marker)))
    tail = F.substr(page, start)
    found = F.contains(page, F.lit(marker)) & (start > 0)
    return F.from_json(F.when(found, tail), f"array<{element}>")


def sound_events(events: Column) -> Column:
    """The array, or null if any element has a field of a wrong type."""

    def bad(event):
        faults = [is_type_fault(event[f], "STRING") for f in EMBEDDED_TEXTS]
        faults += [is_type_fault(event[f], "BIGINT") for f in ("id", "days_to_start")]
        faults.append(is_type_fault(event["eventEnded"], "BOOLEAN"))
        return any_of(faults)

    return F.when(~F.exists(events, bad), events)


def embedded_event_fields(event: Column) -> list[Column]:
    """Event columns of one array element (PRJ-2); `section` stays empty."""

    def words(name):
        return text.strip(text.or_empty(sound_text(event[name])))

    return [
        text.or_zero(F.try_variant_get(event["id"], "$", "bigint"))
        .cast("string")
        .alias("external_id"),
        words("title").alias("name"),
        words("url").alias("event_url"),
        text.first_filled(words("cover_image"), words("cover_image_fallback")).alias("image_url"),
        words("location_city").alias("city"),
        words("location_country_human").alias("country"),
        upper_code(words("location_country")).alias("country_code"),
        words("eventPeriod").alias("date_text"),
        text.days_text(F.try_variant_get(event["days_to_start"], "$", "bigint")).alias("days_text"),
        F.lit("").alias("section"),
    ]


# --- event page: linked data and side documents (HTM-10, JSN-5 … JSN-8) ----------------

_LD_TEXTS = ("@type", "name", "startDate", "endDate", "image", "description", "url")
_LD_SCRIPT = (
    r"(?is)<script(?:\s[^>]*)?\stype\s*=\s*([\"']?)application/ld\+json\1(?:\s[^>]*)?>(.*?)</script"
)


def _member(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def _text_at(value: Column, path: str) -> Column:
    return text_of(_member(value, path))


def _linked_data_fault(value: Column) -> Column:
    """True where a linked-data object does not have the types it must have."""
    texts = [f"$['{name}']" for name in _LD_TEXTS]
    texts += ["$.location.name", "$.organizer.name"]
    texts += [
        f"$.location.address.{name}"
        for name in ("addressLocality", "addressCountry", "description")
    ]
    objects = ["$.location", "$.location.address", "$.organizer"]
    faults = [is_type_fault(_member(value, path), "STRING") for path in texts]
    faults += [is_type_fault(_member(value, path), "OBJECT") for path in objects]
    return is_type_fault(value, "OBJECT") | any_of(faults)


def linked_event(page: Column) -> Column:
    """First sports event of the page's linked-data scripts as a variant, null if none.

    A script holds an object or a list (JSN-8). One element of a wrong type refuses its
    whole script; the search goes on with the next one.
    """
    scripts = F.regexp_extract_all(page, F.lit(_LD_SCRIPT), F.lit(2))

    # Each step is a pass of its own over the few scripts of the page, so that no step
    # is evaluated again for every use of its result.
    values = F.transform(scripts, lambda raw: F.try_parse_json(text.strip(raw)))
    lists = F.transform(
        F.filter(values, lambda v: v.isNotNull()),
        lambda v: F.coalesce(
            F.when(is_json(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>")), F.array(v)
        ),
    )
    sound = F.filter(lists, lambda each: ~F.exists(each, _linked_data_fault))
    events = F.filter(
        F.flatten(sound), lambda v: text.is_sports_event(_text_at(v, "$['@type']"))
    )
    return F.get(events, F.lit(0))


def linked_event_fields(event: Column) -> dict[str, Column]:
    """Detail fields of a linked-data event, empty where missing (PRJ-3)."""
    paths = {
        "name": "$.name",
        "description": "$.description",
        "start_date": "$.startDate",
        "end_date": "$.endDate",
        "image_url": "$.image",
        "location_name": "$.location.name",
        "location_city": "$.location.address.addressLocality",
        "location_country": "$.location.address.addressCountry",
        "location_address": "$.location.address.description",
        "organizer_name": "$.organizer.name",
    }
    return {name: text.or_empty(_text_at(event, path)) for name, path in paths.items()}


def panel_fields(panels: Column) -> dict[str, Column]:
    """Detail fields of an info-panels document; only JSON strings count (JSN-5)."""
    paths = {
        "location_city": "$.location_city",
        "location_country": "$.location_country_human",
        "location_name": "$.location_name",
        "location_address": "$.location_address",
        "organizer_name": "$.organizer.name",
    }
    return {name: _text_at(panels, path) for name, path in paths.items()}


def open_object(body: Column) -> Column:
    """Body as a variant if it is a JSON object (or null), else null."""
    value = F.try_parse_json(body)
    return F.when(is_json(value, "OBJECT", "VOID"), value)


def page_blocks(document: Column) -> Column:
    """Member `infoPageBlocks` if it is there and not null, else the whole object (JSN-6)."""
    blocks = _member(document, "$.infoPageBlocks")
    present = F.coalesce(~is_json(blocks, "VOID"), F.lit(False))
    return F.when(present, blocks).otherwise(document)


def panels_json(panels: Column) -> Column:
    """Panels as stored: a missing document is the text "null" (JSN-7)."""
    return F.coalesce(F.to_json(panels), F.lit("null"))


def blocks_json(blocks: Column) -> Column:
    """Blocks as stored: a missing document is empty text (JSN-7)."""
    return F.coalesce(F.to_json(blocks), F.lit(""))
