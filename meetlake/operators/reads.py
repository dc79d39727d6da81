"""Filtered, ordered, paged reads over entity tables; each returns a DataFrame."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetlake.operators.lookup import lookup
from meetlake.operators.runs import last_completed
from meetlake.session import staged

SHALLOW_ROWS = 1000
#: Rows that a deep slice sorts at most, and keys it looks at to find them.
SELECT_ROWS, SAMPLE_ROWS = 50_000, 4_000


def _whole(value, default: int) -> int:
    """A number, maybe given as text; anything that is none counts as the default."""
    return int(value) if re.fullmatch("[+-]?[0-9]+", str(value)) else default


@dataclass(frozen=True)
class Paging:
    """Page number and size (SRT-2): a size outside 1 … 100 becomes 20, not 100."""

    page: int = 1
    limit: int = 20

    def __post_init__(self):
        if self.page < 1 or not 1 <= self.limit <= 100:
            raise ValueError(f"no such page: {self.page} of {self.limit} rows")

    @classmethod
    def of(cls, page=None, limit=None) -> Paging:
        number, size = _whole(page, 0), _whole(limit, 0)
        return cls(max(number, 1), size if 1 <= size <= 100 else 20)

    @property
    def offset(self) -> int:
        return (self.page - 1) * self.limit


@dataclass(frozen=True)
class EnrichmentBatch:
    """Slice of athletes to enrich (SRT-5)."""

    limit: int = 50
    offset: int = 0
    only_missing: bool = True

    def __post_init__(self):
        if self.offset < 0 or not 1 <= self.limit <= 200:
            raise ValueError(f"no such batch: {self.limit} rows from {self.offset}")

    @classmethod
    def of(cls, limit=None, offset=None, only_missing=None) -> EnrichmentBatch:
        size = _whole(limit, 0)
        # Accepted spellings of a flag.
        flags = dict.fromkeys(("1", "t", "T", "TRUE", "true", "True"), True)
        flags |= dict.fromkeys(("0", "f", "F", "FALSE", "false", "False"), False)
        return cls(
            50 if size <= 0 else min(size, 200),
            max(_whole(offset, 0), 0),
            flags.get(str(only_missing), True),
        )


def matching(table: DataFrame, **equal: str | None) -> DataFrame:
    """Equality filters; a parameter that is None or empty does not filter (FLT-1)."""
    for column, value in equal.items():
        if value:
            table = table.filter(F.col(column) == value)
    return table


def in_order(by: list[str]) -> list[Column]:
    """Order columns; a leading "-" means highest first."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in by]


def ordered_slice(rows: DataFrame, by: list[str], offset: int, limit: int) -> DataFrame:
    """Rows offset … offset+limit in the order of `in_order(by)`, which must have no ties.

    Near the top this is Spark's top-k: each task keeps offset+limit rows. A deep slice
    would make one task hold all rows before it, so there see `deep_slice`.
    """
    if offset + limit <= SHALLOW_ROWS:
        return rows.orderBy(*in_order(by)).offset(offset).limit(limit)
    return deep_slice(rows, by, offset, limit)


def beyond(by: list[str], row: dict) -> Column:
    """Whether a row stands after `row` in the order of `in_order(by)`.

    As in that order, nulls come first in a rising column and last in a falling one.
    """
    after, same = F.lit(False), F.lit(True)
    for c in by:
        name = c.removeprefix("-")
        column, value = F.col(name), row[name]
        if value is None:
            further = F.lit(False) if c.startswith("-") else column.isNotNull()
        elif c.startswith("-"):
            further = column.isNull() | (column < F.lit(value))
        else:
            further = column > F.lit(value)
        after = after | (same & F.coalesce(further, F.lit(False)))
        same = same & column.eqNullSafe(F.lit(value))
    return after


def rows_after(rows: DataFrame, by: list[str], last: dict, limit: int) -> DataFrame:
    """The next `limit` rows after the one of the values `last`, in the order of `in_order(by)`.

    A page after a known row is a filter and Spark's top-k, however deep it lies.
    """
    return rows.filter(beyond(by, last)).orderBy(*in_order(by)).limit(limit)


def deep_slice(rows: DataFrame, by: list[str], offset: int, limit: int) -> DataFrame:
    """`ordered_slice` for a deep offset; rows have a unique `id`.

    By selection: keys of a bounded sample, in order, bound where the slice must lie; one count
    over all keys tells how many stand before the bounds and between them. While more than
    `SELECT_ROWS` lie between, these are narrowed again; only what is left is sorted. The sample
    only proposes bounds, which are widened where the counts do not confirm them. The ids of
    the slice, at most `limit`, are then sent to the rows. The driver gets the samples and counts.
    """
    columns = list(dict.fromkeys([*(c.removeprefix("-") for c in by), "id"]))
    inside, order = rows.select(*columns), in_order(by)
    n, width = inside.count(), 4.0
    while n > SELECT_ROWS and offset < n:
        picked = inside.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).orderBy(*order).collect()
        m = len(picked)
        low, high = (m * min(at, n) / n for at in (offset, offset + limit))
        spread = [width * (x * (1 - x / m)) ** 0.5 + width for x in (low, high)]
        i, j = int(low - spread[0]), int(high + spread[1]) + 1
        above = beyond(by, picked[i].asDict()) if i >= 0 else F.lit(True)
        below = ~beyond(by, picked[j].asDict()) if j < m else F.lit(True)
        before, between = inside.agg(
            F.count_if(~above), F.count_if(above & below)
        ).first()
        ends = before + between
        if before > offset or (ends < offset + limit and ends < n):
            width *= 4  # the sample misled
            continue
        if between == n:
            break
        inside, offset, n = inside.filter(above & below), offset - before, between
    found = inside.orderBy(*order).offset(offset).limit(limit).select("id")
    return rows.join(F.broadcast(found), "id", "left_semi").orderBy(*order)


def page_of(table: DataFrame, by: str, paging: Paging) -> DataFrame:
    """One page, highest `by` first, ties by id (SRT-1)."""
    return ordered_slice(table, [f"-{by}", "id"], paging.offset, paging.limit)


def academies_page(
    academies: DataFrame, country: str | None = None, paging: Paging = Paging()
) -> DataFrame:
    return page_of(matching(academies, country_code=country), "total_wins", paging)


def athletes_page(
    athletes: DataFrame,
    academies: DataFrame,
    country: str | None = None,
    academy_id: str | None = None,
    paging: Paging = Paging(),
) -> DataFrame:
    """Page of athletes with their academies; at most a page of rows is joined."""
    kept = matching(athletes, country_code=country, academy_external_id=academy_id)
    page = with_academy_of_few(page_of(kept, "total_wins", paging), academies)
    return page.orderBy(F.desc("total_wins"), "id")


def events_page(
    events: DataFrame,
    event_type: str | None = None,
    country: str | None = None,
    paging: Paging = Paging(),
) -> DataFrame:
    """Page of events, newest first; `country` is a code in any case or a name (FLT-2)."""
    kept = matching(events, event_type=(event_type or "").strip())
    place = (country or "").strip()
    if place:
        kept = kept.filter((F.col("country_code") == place.upper()) | (F.col("country") == place))
    return page_of(kept, "scraped_at", paging)


def runs_page(runs: DataFrame, paging: Paging = Paging()) -> DataFrame:
    return page_of(runs, "created_at", paging)


def with_academy(athletes: DataFrame, academies: DataFrame) -> DataFrame:
    """Athletes with their academy as a struct, null if there is none (JON-1)."""
    parents = academies.select(
        F.col("external_id").alias("academy_external_id"),
        F.struct(*academies.columns).alias("academy"),
    )
    joined = lookup(athletes, parents, "academy_external_id")
    return joined.select(*athletes.columns, "academy")


def with_academy_of_few(athletes: DataFrame, academies: DataFrame) -> DataFrame:
    """`with_academy` for at most a page of athletes.

    Their keys go to the scan of the academies, so the parent table is not shuffled, and
    what is left of it is no more than a page.
    """
    few = staged(athletes, "page")
    keys = few.select(F.col("academy_external_id").alias("external_id"))
    parents = academies.join(F.broadcast(keys), "external_id", "left_semi").select(
        F.col("external_id").alias("academy_external_id"),
        F.struct(*academies.columns).alias("academy"),
    )
    joined = few.join(F.broadcast(parents), "academy_external_id", "left")
    return joined.select(*athletes.columns, "academy")


def first_by(table: DataFrame, column: str, value) -> DataFrame:
    """The row with the lowest id among those with the value; no row if none (SRT-3)."""
    return table.filter(F.col(column) == value).orderBy("id").limit(1)


def athlete_by_id(athletes: DataFrame, academies: DataFrame, external_id: str) -> DataFrame:
    return with_academy_of_few(first_by(athletes, "external_id", external_id), academies)


def details_of_event(details: DataFrame, event_id: str = "", event_url: str = "") -> DataFrame:
    """The details of an event by its id or, if none is given, by its address; one row at most."""
    if not (event_id or event_url):
        raise ValueError("event_id or event_url is required")
    column, value = ("event_id", event_id) if event_id else ("event_url", event_url)
    return first_by(details, column, value)


def academy_with_athletes(
    academies: DataFrame, athletes: DataFrame, external_id: str
) -> DataFrame:
    """An academy with its athletes, one row each; a lone row if it has none (JON-2).

    The athletes stay rows: an academy of any size is never gathered in one task.
    """
    parent = first_by(academies, "external_id", external_id)
    # The key is filtered on both sides, so each scan gets the pushed filter.
    children = athletes.filter(F.col("academy_external_id") == external_id)
    rows = children.select(
        F.col("academy_external_id").alias("external_id"),
        F.struct(*children.columns).alias("athlete"),
    )
    # All children have one key: the parent, a single row, goes to them and not they to it.
    beside = rows.join(F.broadcast(parent), "external_id")
    lone = parent.join(F.broadcast(rows.select("external_id").limit(1)), "external_id", "left_anti")
    return beside.unionByName(lone, allowMissingColumns=True).select(*parent.columns, "athlete")


def needs_enrichment(athletes: DataFrame) -> DataFrame:
    """Athletes without a belt or without any fight (FLT-3)."""
    no_belt = F.coalesce(F.col("belt_rank"), F.lit("")) == ""
    no_fight = (F.col("total_wins") == 0) & (F.col("total_losses") == 0)
    return athletes.filter(no_belt | no_fight)


def enrichment_batch(athletes: DataFrame, batch: EnrichmentBatch = EnrichmentBatch()) -> DataFrame:
    """Athletes of one enrichment batch by id (SRT-5) that have a profile to read (FLT-6).

    The slice is cut first and rows without a reference drop out of it, so a batch may
    be smaller than its limit.
    """
    chosen = needs_enrichment(athletes) if batch.only_missing else athletes
    cut = ordered_slice(chosen, ["id"], batch.offset, batch.limit)
    return cut.filter((F.col("external_id") != "") | (F.col("profile_url") != ""))


def status(academies: DataFrame, athletes: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: end of the last completed run and table sizes (AGG-1, SRT-4)."""
    return last_completed(runs).select(
        "last_run",
        academies.agg(F.count("*")).scalar().alias("total_academies"),
        athletes.agg(F.count("*")).scalar().alias("total_athletes"),
    )


def answer(row: DataFrame, name: str) -> DataFrame:
    """One JSON answer with a single row, or with an error if there is none (SNK-2)."""
    found = row.limit(1).agg(F.first(F.struct(*row.columns)).alias("data"))
    label = name.capitalize()
    good = F.struct(
        F.lit(True).alias("success"),
        F.lit(f"{label} retrieved successfully").alias("message"),
        "data",
    )
    bad = F.struct(F.lit(False).alias("success"), F.lit(f"{label} not found").alias("error"))
    return found.select(
        F.when(F.col("data").isNull(), F.to_json(bad)).otherwise(F.to_json(good)).alias("json")
    )


def envelope(page: DataFrame, all_rows: DataFrame, name: str, paging: Paging) -> DataFrame:
    """One JSON answer with the page and the count of all matching rows (SRT-6, SNK-2).

    A page holds at most 100 rows, so gathering it in one row is bounded.
    """
    total = all_rows.agg(F.count("*")).scalar()
    rows = F.collect_list(F.struct(*page.columns))
    data = F.struct(
        rows.alias(name),
        F.lit(paging.page).alias("page"),
        F.lit(paging.limit).alias("limit"),
        total.alias("total"),
    )
    answer = F.struct(
        F.lit(True).alias("success"),
        F.lit(f"{name.capitalize()} retrieved successfully").alias("message"),
        data.alias("data"),
    )
    # one partition keeps the order of the page in the list
    return page.coalesce(1).agg(F.to_json(answer).alias("json"))
