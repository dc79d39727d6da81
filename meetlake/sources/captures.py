"""The table of captured responses (SRC-1 … SRC-6): selection, refusals, link frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meetlake.sources.schemas import CAPTURES

KINDS = (
    "participants", "profile", "profile_events", "event_list", "event", "event_panels",
    "event_blocks", "academy_list", "academy", "probe",
)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CAPTURES).parquet(path)


def of_kind(captures: DataFrame, kind: str) -> DataFrame:
    """Captures of one kind; the filter reaches the parquet scan."""
    if kind not in KINDS:
        raise ValueError(f"unknown capture kind: {kind!r}")
    return captures.filter(F.col("kind") == kind)


def answered(captures: DataFrame) -> DataFrame:
    """Captures that were answered with a body to read."""
    return captures.filter(F.col("status") == 200)


def unanswered(captures: DataFrame, *kinds: str) -> DataFrame:
    """Captures of the kinds that were not answered, with the reason."""
    failed = captures.filter(F.col("kind").isin(*kinds)).withColumn("fault", refusal(F.lit(False)))
    return failed.filter(F.col("fault").isNotNull()).select(
        "url", "kind", "fetched_at", "status", "fault"
    )


def refusal(decode_fault: Column) -> Column:
    """Why a capture is not used, null if it is: answer status first, then its content."""
    return F.when(
        F.coalesce(F.col("status"), F.lit(0)) != 200,
        F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("none"))),
    ).when(decode_fault, F.lit("payload does not fit its schema"))


def frontier(links: DataFrame, captures: DataFrame) -> DataFrame:
    """Linked addresses not captured yet, each once (JON-6). Both sides: `url`.

    Both sides are made distinct first, so a link that stands on a third of all pages, or
    a page captured again and again, is one row per task before the shuffle.
    """
    wanted = links.select("url").filter(F.col("url").isNotNull() & (F.col("url") != ""))
    return wanted.distinct().join(captures.select("url").distinct(), "url", "left_anti")
