"""Filtered, ordered and paged reads; run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from meetlake.checks.stand_ins import stand_in, with_stand_ins
from meetlake.operators import reads, runs
from meetlake.operators.reads import EnrichmentBatch, Paging

_ATHLETE = ("id", "external_id", "full_name", "country_code", "total_wins")
_ATHLETE_SQL = ", ".join(f"a.{c}" for c in _ATHLETE)


def _athletes(spark, sf):
    return stand_in(spark, sf, "athletes"), stand_in(spark, sf, "academies")


def _with_academy_name(rows):
    return rows.select(
        *_ATHLETE,
        F.col("academy.external_id").alias("academy_id"),
        F.col("academy.name").alias("academy_name"),
    )


def academies_page(spark, sf):
    return reads.academies_page(stand_in(spark, sf, "academies"), paging=Paging.of("2", "30"))


def academies_by_country(spark, sf):
    return reads.academies_page(stand_in(spark, sf, "academies"), "N16", Paging.of("x", 500))


def athletes_page(spark, sf):
    return _with_academy_name(reads.athletes_page(*_athletes(spark, sf), paging=Paging.of(2, 25)))


def athletes_by_country(spark, sf):
    page = reads.athletes_page(*_athletes(spark, sf), "N3", "28", Paging.of(0, 100))
    return _with_academy_name(page)


def athletes_deep_page(spark, sf):
    athletes, _ = _athletes(spark, sf)
    paging = Paging.of(8, 100)
    by = ["-total_wins", "id"]
    return reads.deep_slice(athletes, by, paging.offset, paging.limit).select(*_ATHLETE)


def athletes_after_row(spark, sf):
    """SRT-1 by seeking: the hundred athletes after the 700th, given that row."""
    athletes, _ = _athletes(spark, sf)
    by = ["-total_wins", "id"]
    last = reads.deep_slice(athletes, by, 699, 1).first()
    if last is None:  # fewer than 700: none are after it
        return athletes.select(*_ATHLETE).limit(0)
    return reads.rows_after(athletes, by, last.asDict(), 100).select(*_ATHLETE)


def athletes_with_academy(spark, sf):
    return _with_academy_name(reads.with_academy(*_athletes(spark, sf)))


def athlete_by_id(spark, sf):
    return _with_academy_name(reads.athlete_by_id(*_athletes(spark, sf), "77"))


def academy_with_athletes(spark, sf):
    athletes, academies = _athletes(spark, sf)
    rows = reads.academy_with_athletes(academies, athletes, "5")
    return rows.select(
        "external_id",
        "name",
        F.col("athlete.external_id").alias("athlete_id"),
        F.col("athlete.full_name").alias("athlete_name"),
    )


def events_page(spark, sf):
    meets = stand_in(spark, sf, "meets")
    return reads.events_page(meets, " past ", "n3", Paging.of(3)).drop("scraped_at")


def events_by_country_name(spark, sf):
    meets = stand_in(spark, sf, "meets")
    return reads.events_page(meets, None, "Land 7", Paging.of(1, 100)).drop("scraped_at")


def event_by_id(spark, sf):
    return reads.first_by(stand_in(spark, sf, "meets"), "external_id", "42").drop("scraped_at")


def page_envelope(spark, sf):
    academies = stand_in(spark, sf, "academies")
    paging = Paging.of(1, 3)
    return reads.envelope(
        reads.academies_page(academies, "N16", paging),
        reads.matching(academies, country_code="N16"),
        "academies",
        paging,
    )


def needs_enrichment(spark, sf):
    athletes, _ = _athletes(spark, sf)
    return reads.needs_enrichment(athletes).select("id", "belt_rank", "total_wins", "total_losses")


def enrichment_batch(spark, sf):
    athletes, _ = _athletes(spark, sf)
    batch = EnrichmentBatch.of("999", "10", "yes")
    return reads.enrichment_batch(athletes, batch).select("id", "external_id", "profile_url")


def run_history(spark, sf):
    return (
        runs.current_runs(stand_in(spark, sf, "run_log"))
        .withColumn("duration_known", F.col("completed_at").isNotNull())
        .select("id", "job_type", "status", "duration_known", "items_scraped", "error_message")
    )


def runs_page(spark, sf):
    current = runs.current_runs(stand_in(spark, sf, "run_log"))
    return reads.runs_page(current, Paging.of(2, 15)).select("id", "job_type", "status")


def run_status(spark, sf):
    athletes, academies = _athletes(spark, sf)
    current = runs.current_runs(stand_in(spark, sf, "run_log"))
    return reads.status(academies, athletes, current).select(
        F.date_format("last_run", "yyyy-MM-dd HH:mm:ss").alias("last_run"),
        "total_academies",
        "total_athletes",
    )


QUERIES = {
    f.__name__: f
    for f in (
        academies_page, academies_by_country, athletes_page, athletes_by_country,
        athletes_deep_page, athletes_after_row, athletes_with_academy, athlete_by_id, academy_with_athletes,
        events_page, events_by_country_name, event_by_id, page_envelope, needs_enrichment,
        enrichment_batch, run_history, runs_page, run_status,
    )
}

_CURRENT = """
    WITH current_runs AS (
        SELECT run_id AS id,
            arg_max(job_type, (event_time, status <> 'running')) AS job_type,
            arg_max(status, (event_time, status <> 'running')) AS status,
            arg_max(items_scraped, (event_time, status <> 'running')) AS items_scraped,
            arg_max(error_message, (event_time, status <> 'running')) AS error_message,
            max(event_time) AS last_time, min(event_time) AS created_at
        FROM run_log GROUP BY run_id)
"""
_JOINED = f"""
    SELECT {_ATHLETE_SQL}, c.external_id AS academy_id, c.name AS academy_name
    FROM athletes a LEFT JOIN academies c ON a.academy_external_id = c.external_id
"""
_MEET = "id, external_id, event_url, country_code, country, event_type"

SQL = {
    "academies_page": with_stand_ins(
        "SELECT * FROM academies ORDER BY total_wins DESC, id LIMIT 30 OFFSET 30", "academies"
    ),
    "academies_by_country": with_stand_ins(
        "SELECT * FROM academies WHERE country_code = 'N16' ORDER BY total_wins DESC, id LIMIT 20",
        "academies",
    ),
    "athletes_page": with_stand_ins(
        f"{_JOINED} ORDER BY a.total_wins DESC, a.id LIMIT 25 OFFSET 25", "athletes", "academies"
    ),
    "athletes_by_country": with_stand_ins(
        f"""{_JOINED} WHERE a.country_code = 'N3' AND a.academy_external_id = '28'
        ORDER BY a.total_wins DESC, a.id LIMIT 100""",
        "athletes",
        "academies",
    ),
    "athletes_deep_page": with_stand_ins(
        f"""SELECT {_ATHLETE_SQL} FROM athletes a
        ORDER BY a.total_wins DESC, a.id LIMIT 100 OFFSET 700""",
        "athletes",
    ),
    "athletes_after_row": with_stand_ins(
        f"""SELECT {_ATHLETE_SQL} FROM athletes a
        ORDER BY a.total_wins DESC, a.id LIMIT 100 OFFSET 700""",
        "athletes",
    ),
    "athletes_with_academy": with_stand_ins(_JOINED, "athletes", "academies"),
    "athlete_by_id": with_stand_ins(
        f"{_JOINED} WHERE a.external_id = '77' ORDER BY a.id LIMIT 1", "athletes", "academies"
    ),
    "academy_with_athletes": with_stand_ins(
        """SELECT c.external_id, c.name, a.external_id AS athlete_id, a.full_name AS athlete_name
        FROM (SELECT * FROM academies WHERE external_id = '5' ORDER BY id LIMIT 1) c
        LEFT JOIN athletes a ON a.academy_external_id = c.external_id""",
        "athletes",
        "academies",
    ),
    "events_page": with_stand_ins(
        f"""SELECT {_MEET} FROM meets
        WHERE event_type = 'past' AND (country_code = 'N3' OR country = 'n3')
        ORDER BY scraped_at DESC, id LIMIT 20 OFFSET 40""",
        "meets",
    ),
    "events_by_country_name": with_stand_ins(
        f"""SELECT {_MEET} FROM meets WHERE country_code = 'LAND 7' OR country = 'Land 7'
        ORDER BY scraped_at DESC, id LIMIT 100""",
        "meets",
    ),
    "event_by_id": with_stand_ins(
        f"SELECT {_MEET} FROM meets WHERE external_id = '42' ORDER BY id LIMIT 1", "meets"
    ),
    "page_envelope": with_stand_ins(
        """WITH page AS (SELECT * FROM academies WHERE country_code = 'N16'
            ORDER BY total_wins DESC, id LIMIT 3)
        SELECT CAST(to_json({
            'success': true, 'message': 'Academies retrieved successfully',
            'data': {
                'academies': coalesce((SELECT list({
                    'id': id, 'external_id': external_id, 'name': name,
                    'country_code': country_code, 'total_wins': total_wins}
                    ORDER BY total_wins DESC, id) FROM page), []),
                'page': 1, 'limit': 3,
                'total': (SELECT count(*) FROM academies WHERE country_code = 'N16')}
            }) AS STRING) AS json""",
        "academies",
    ),
    "needs_enrichment": with_stand_ins(
        """SELECT id, belt_rank, total_wins, total_losses FROM athletes
        WHERE belt_rank = '' OR belt_rank IS NULL OR (total_wins = 0 AND total_losses = 0)""",
        "athletes",
    ),
    "enrichment_batch": with_stand_ins(
        """SELECT id, external_id, profile_url FROM (
            SELECT * FROM athletes
            WHERE belt_rank = '' OR belt_rank IS NULL OR (total_wins = 0 AND total_losses = 0)
            ORDER BY id LIMIT 200 OFFSET 10)
        WHERE external_id <> '' OR profile_url <> ''""",
        "athletes",
    ),
    "run_history": with_stand_ins(
        f"""{_CURRENT} SELECT id, job_type, status, status <> 'running' AS duration_known,
        items_scraped, error_message FROM current_runs""",
        "run_log",
    ),
    "runs_page": with_stand_ins(
        f"""{_CURRENT} SELECT id, job_type, status FROM current_runs
        ORDER BY created_at DESC, id LIMIT 15 OFFSET 15""",
        "run_log",
    ),
    "run_status": with_stand_ins(
        f"""{_CURRENT} SELECT
        (SELECT strftime(max(last_time), '%Y-%m-%d %H:%M:%S') FROM current_runs
            WHERE status = 'completed') AS last_run,
        (SELECT count(*) FROM supplier) AS total_academies,
        (SELECT count(*) FROM customer) AS total_athletes""",
        "run_log",
    ),
}
