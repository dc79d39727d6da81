"""Match tallies and profile counters.

Counters of one page or one payload are made inside its row with array functions, so
nothing is shuffled for them; tallies over match rows are plain aggregations, whose
map-side part reduces a hot athlete to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetlake.functions import labels, numbers, text
from meetlake.functions.labels import COUNTERS, METHODS
from meetlake.session import staged

_SIDES = (("wins", True), ("losses", False))


def classed(matches: DataFrame) -> DataFrame:
    """Rows with the `method` of their `outcome`; byes and walkovers are dropped.

    Apply it to the smaller side where outcomes come from a table of their own.
    """
    outcome = labels.normal_outcome(F.col("outcome"))
    fought = matches.withColumn("outcome", outcome).filter(~labels.is_bye(F.col("outcome")))
    return fought.withColumn("method", labels.outcome_method(F.col("outcome"))).drop("outcome")


def counted(fights: DataFrame, by: list[str]) -> DataFrame:
    """Ten counters per group from rows with `is_winner` and `method`.

    A fight without a known method counts in the total only.
    """
    counts = []
    for side, won in _SIDES:
        mine = F.col("is_winner") == won
        counts.append(F.count_if(mine).alias(f"total_{side}"))
        counts += [
            F.count_if(mine & (F.col("method") == m)).alias(f"{side}_by_{m}")
            for m in METHODS
        ]
    return fights.groupBy(*by).agg(*counts)


def tally(matches: DataFrame, by: list[str]) -> DataFrame:
    """Ten counters per group from match rows with `is_winner` and `outcome` (AGG-2)."""
    return counted(classed(matches.select(*by, "is_winner", "outcome")), by)


def counts_of(rows: Column) -> dict[str, Column]:
    """Ten counters of an array of (is_win, method), in the row (AGG-3)."""

    def having(array, name, value):
        return F.filter(array, lambda row: row[name] == value)

    counts = {}
    for side, won in _SIDES:
        mine = having(rows, "is_win", won)
        counts[f"total_{side}"] = F.size(mine)
        for m in METHODS:
            counts[f"{side}_by_{m}"] = F.size(having(mine, "method", m))
    return counts


def _payload_fights(payload: Column) -> Column:
    per_event = F.transform(
        payload["data"],
        lambda e: F.flatten(
            F.transform(
                F.filter(e["registrations"], lambda r: r["matches"].isNotNull()),
                lambda r: r["matches"],
            )
        ),
    )
    matches = F.flatten(F.filter(per_event, lambda m: m.isNotNull()))
    rows = F.transform(
        matches,
        lambda m: F.struct(
            F.coalesce(m["is_winner"], F.lit(False)).alias("is_win"),
            labels.normal_outcome(F.try_variant_get(m["outcome"], "$", "string")).alias("outcome"),
        ),
    )
    fought = F.filter(rows, lambda r: ~F.coalesce(labels.is_bye(r["outcome"]), F.lit(False)))
    return F.transform(
        fought,
        lambda r: F.struct(
            r["is_win"].alias("is_win"),
            labels.outcome_method(F.coalesce(r["outcome"], F.lit(""))).alias("method"),
        ),
    )


def page_tallies(decoded: DataFrame) -> DataFrame:
    """Ten counters per capture of a decoded match list, inside its row (SRC-2, AGG-2)."""
    about = ("external_id", "url", "kind", "fetched_at", "status", "fault", "next_url")
    fights = decoded.select(*about, _payload_fights(F.col("payload")).alias("fights"))
    counts = counts_of(F.col("fights"))
    return fights.select(*about, *[text.or_zero(c).alias(n) for n, c in counts.items()])


def linked_pages(pages: DataFrame) -> DataFrame:
    """(external_id, url) of each list's first page and of all that next-page links lead to.

    `pages` has one row per captured page: external_id, url, next_url, fetched_at. The first
    page is the one whose address has no query (the newest, if there are several). Links are
    followed by doubling: each round joins the pages reached with the links of its length, and
    the links with themselves. So rounds grow with the logarithm of the longest list, a cycle
    ends when nothing new is reached, and no list is gathered in one place. A link to a
    page that was not captured is followed to that page and no further.
    """
    key = ["external_id", "url"]
    linked = pages.filter(F.col("next_url").isNotNull())
    hops = linked.select(*key, F.col("next_url").alias("to"))
    first = F.max_by("url", F.struct("fetched_at", "url")).alias("url")
    plain = pages.filter(~F.contains("url", F.lit("?")))
    reached, n = plain.groupBy("external_id").agg(first), None
    while True:
        ahead = reached.join(hops, key).select("external_id", F.col("to").alias("url"))
        reached = staged(reached.union(ahead).distinct(), "linked-pages")
        before, n = n, reached.count()
        if n == before:
            return reached
        further = hops.select("external_id", F.col("url").alias("to"), F.col("to").alias("end"))
        hops = hops.join(further, ["external_id", "to"])
        hops = staged(hops.select(*key, F.col("end").alias("to")), "page-links")


def profile_tally(pages: DataFrame) -> DataFrame:
    """Tally per athlete over the pages of its match list.

    The newest capture of each page counts, and only pages the list links, see `linked_pages`.
    An athlete has no tally if the first page of its list was not captured, or if a linked page
    was refused or never captured: the counts would be partial.
    """
    page = F.struct("next_url", "fetched_at", F.col("fault").isNull().alias("sound"), *COUNTERS)
    turn = F.struct("fetched_at", F.xxhash64("next_url", "fault", *COUNTERS).alias("tie"))
    newest = pages.groupBy("external_id", "url").agg(F.max_by(page, turn).alias("page"))
    newest = staged(newest.select("external_id", "url", "page.*"), "newest-pages")
    listed = linked_pages(newest).join(newest, ["external_id", "url"], "left")
    totals = listed.groupBy("external_id").agg(
        F.bool_and(F.coalesce("sound", F.lit(False))).alias("sound"),
        *[F.sum(c).alias(c) for c in COUNTERS],
    )
    return totals.filter("sound").drop("sound")


def totals_from_breakdown(counters: dict[str, Column]) -> dict[str, Column]:
    """Total from its methods where it is null or 0 and they sum to more (AGG-4)."""
    out = dict(counters)
    for side, _ in _SIDES:
        total = counters[f"total_{side}"]
        parts = sum(
            (F.coalesce(counters[f"{side}_by_{m}"], F.lit(0)) for m in METHODS), F.lit(0)
        )
        empty = F.coalesce(total, F.lit(0)) == 0
        out[f"total_{side}"] = F.when(empty & (parts > 0), parts).otherwise(total)
    return out


def first_counters(pairs: DataFrame, by: list[str], position: Column) -> DataFrame:
    """First value per counter from label/value rows in order of position (AGG-8)."""
    named = pairs.select(
        *by,
        position.alias("_at"),
        labels.stat_counter(text.normal_label(F.col("label"))).alias("_counter"),
        numbers.first_int(F.col("value")).alias("_value"),
    ).filter(F.col("_counter").isNotNull() & F.col("_value").isNotNull())
    return named.groupBy(*by).agg(
        *[
            F.min_by(F.col("_value"), F.when(F.col("_counter") == c, F.col("_at"))).alias(c)
            for c in COUNTERS
        ]
    )


def _legend_counters(rows: Column, side: str) -> dict[str, Column]:
    """Method counters of legend rows (HTM-8).

    A row sets the first counter it names that is not set yet, so a row that names two
    methods may fall through to the second: a fold over the rows in order.
    """
    order = ("submission", "decision", "points", "dq")
    start = F.struct(*[F.lit(None).cast("bigint").alias(m) for m in order])

    def names(label, method):
        hit = F.contains(label, F.lit(method))
        return hit | F.contains(label, F.lit("disqualification")) if method == "dq" else hit

    def step(acc, row):
        target = F.when(names(row["label"], order[0]) & acc[order[0]].isNull(), order[0])
        for m in order[1:]:
            target = target.when(names(row["label"], m) & acc[m].isNull(), m)
        return F.struct(
            *[F.when(target == m, row["value"]).otherwise(acc[m]).alias(m) for m in order]
        )

    folded = F.aggregate(rows, start, step)
    return {f"{side}_by_{m}": folded[m] for m in METHODS}


def profile_counters(parts: DataFrame, keep: tuple[str, ...] = ("url", "fetched_at")) -> DataFrame:
    """Belt and ten counters of each profile page; null where the page says nothing.

    Order of precedence: skill box and legends, then label/value pairs, then fight rows,
    then totals from the breakdown.
    """
    pairs = F.transform(
        "pairs",
        lambda p: F.struct(
            text.normal_label(p["label"]).alias("label"), p["value"].alias("value")
        ),
    )
    folded = parts.select(
        *keep,
        "belt",
        "fights",
        F.struct(
            *[
                c.alias(n)
                for side, rows in (("wins", "wins_legend"), ("losses", "losses_legend"))
                for n, c in _legend_counters(F.col(rows), side).items()
            ]
        ).alias("legend"),
        pairs.alias("pairs"),
    )
    # A belt label counts only while the belt is unset; the pair that sets it is no number.
    belt_pairs = F.filter("pairs", lambda p: F.contains(p["label"], F.lit("belt")))
    belt_at = F.when(
        F.col("belt").isNull() & (F.size(belt_pairs) > 0),
        F.array_position(
            F.transform("pairs", lambda p: F.contains(p["label"], F.lit("belt"))), True
        ),
    ).otherwise(F.lit(0))
    with_belt = folded.select(
        *keep,
        "fights",
        "legend",
        F.coalesce("belt", F.get(belt_pairs, F.lit(0))["value"]).alias("belt_rank"),
        F.filter("pairs", lambda p, i: i + 1 != belt_at).alias("pairs"),
    )
    numbered = with_belt.withColumn(
        "pairs",
        F.transform(
            "pairs",
            lambda p: F.struct(
                labels.stat_counter(p["label"]).alias("counter"),
                numbers.first_int(p["value"]).alias("value"),
            ),
        ),
    ).withColumn("pairs", F.filter("pairs", lambda p: p["value"].isNotNull()))
    fight_counts = counts_of(F.col("fights"))

    def stated(counter):
        from_pairs = F.get(F.filter("pairs", lambda p: p["counter"] == counter), F.lit(0))["value"]
        from_fights = F.nullif(fight_counts[counter], F.lit(0))
        layers = [from_pairs, from_fights]
        if not counter.startswith("total_"):
            layers.insert(0, F.col(f"legend.{counter}"))
        return F.coalesce(*layers)

    stated_counts = numbered.select(
        *keep, "belt_rank", *[stated(c).alias(c) for c in COUNTERS]
    )
    filled = totals_from_breakdown({c: F.col(c) for c in COUNTERS})
    return stated_counts.select(*keep, "belt_rank", *[c.alias(n) for n, c in filled.items()])


def merged_with_tally(pages: DataFrame, tallies: DataFrame, on: str = "external_id") -> DataFrame:
    """Page counters with the match tally put over them where it is above 0 (DML-7).

    Pages without a tally keep their own values (JON-8).
    """
    renamed = tallies.select(on, *[F.col(c).alias(f"t_{c}") for c in COUNTERS])
    joined = pages.join(renamed, on, "left")
    others = [c for c in pages.columns if c not in COUNTERS]
    return joined.select(
        *others,
        *[F.when(F.col(f"t_{c}") > 0, F.col(f"t_{c}")).otherwise(F.col(c)).alias(c) for c in COUNTERS],
    )
