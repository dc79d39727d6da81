"""Driver tables in the shape of entity tables.

The projections are written once, in SQL both engines read, so that a query and its SQL
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetlake.site import Site

SITE = Site()

_STAND_INS = {
    "academies": (
        "supplier",
        "s_suppkey + 1 AS id",
        "CAST(s_suppkey AS STRING) AS external_id",
        "concat('Club ', CAST(s_suppkey % 37 AS STRING)) AS name",
        "concat('N', CAST(s_nationkey AS STRING)) AS country_code",
        "CAST(floor(s_acctbal / 100) AS INT) AS total_wins",
    ),
    "athletes": (
        "customer",
        "c_custkey + 1 AS id",
        "CAST(c_custkey AS STRING) AS external_id",
        "c_name AS full_name",
        "CAST(c_custkey % 150 AS STRING) AS academy_external_id",
        "concat('N', CAST(c_nationkey AS STRING)) AS country_code",
        "CASE c_mktsegment WHEN 'FURNITURE' THEN '' WHEN 'MACHINERY' THEN NULL "
        "ELSE lower(c_mktsegment) END AS belt_rank",
        "CASE WHEN c_acctbal < 3000 THEN 0 ELSE CAST(floor(c_acctbal / 100) AS INT) END AS total_wins",
        "CASE WHEN c_acctbal < 2000 THEN 0 ELSE CAST(c_custkey % 7 AS INT) END AS total_losses",
        "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('https://example.com/en/profile/', "
        "CAST(c_custkey AS STRING)) END AS profile_url",
    ),
    "meets": (
        "orders",
        "o_orderkey + 1 AS id",
        "CAST(o_custkey AS STRING) AS external_id",
        "concat('https://example.com/en/event/', CAST(o_orderkey AS STRING)) AS event_url",
        "concat('N', CAST(o_custkey % 25 AS STRING)) AS country_code",
        "concat('Land ', CAST(o_custkey % 25 AS STRING)) AS country",
        "CASE o_orderstatus WHEN 'F' THEN 'past' ELSE 'upcoming' END AS event_type",
        "o_orderdate AS scraped_at",
    ),
    "run_log": (
        "events",
        "user_id AS run_id",
        "event_type AS job_type",
        "CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' "
        "ELSE 'running' END AS status",
        "ts AS event_time",
        "CAST(floor(value) AS INT) AS items_scraped",
        "CASE event_type WHEN 'error' THEN props ELSE '' END AS error_message",
    ),
    "outcomes": (
        "part",
        "p_partkey AS l_partkey",
        "CASE p_type WHEN 'PROMO' THEN 'Submission by decision' "
        "WHEN 'ECONOMY' THEN ' Decision on points' WHEN 'LARGE' THEN 'POINTS' "
        "WHEN 'SMALL' THEN 'Disqualification' WHEN 'STANDARD' THEN 'Bye' "
        "ELSE 'Other' END AS outcome",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as if it came in as many files as there are cores.

    Driver tables are single files of one row group, so one task would read all bodies; a
    stored table has splits of its own and needs no such step.
    """
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def stamped(stored: DataFrame) -> DataFrame:
    """Stored rows written on 2020-01-01."""
    old = F.lit("2020-01-01").cast("timestamp")
    return stored.withColumns({c: old for c in ("created_at", "updated_at")})


def stamp_days(merged: DataFrame) -> DataFrame:
    """The days of creation and update in place of their times."""
    days = {"created_on": F.to_date("created_at"), "updated_on": F.to_date("updated_at")}
    return merged.withColumns(days).drop("created_at", "updated_at")


def stamps_sql(is_new: str, is_given: str) -> str:
    """What `stamp_days` must show of a batch of 2026-01-01."""
    return f"""CASE WHEN {is_new} THEN DATE '2026-01-01' ELSE DATE '2020-01-01' END AS created_on,
        CASE WHEN {is_given} THEN DATE '2026-01-01' ELSE DATE '2020-01-01' END AS updated_on"""


def stand_in(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, *columns = _STAND_INS[name]
    return table(spark, sf_dir, source).selectExpr(*columns)


def with_stand_ins(query: str, *names: str) -> str:
    """SQL text with the stand-ins it reads put before it as common tables."""
    tables = [
        f"{name} AS (SELECT {', '.join(columns)} FROM {source})"
        for name in names
        for source, *columns in [_STAND_INS[name]]
    ]
    rest = query.strip()
    if rest.upper().startswith("WITH "):
        return f"WITH {', '.join(tables)}, {rest[5:]}"
    return f"WITH {', '.join(tables)} {rest}"
