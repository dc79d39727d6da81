"""Match tallies and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from meetlake.checks.stand_ins import stand_in, table
from meetlake.functions.labels import COUNTERS, METHODS
from meetlake.operators import reads, tally
from meetlake.operators.lookup import lookup
from meetlake.operators.reads import Paging
from meetlake.session import staged

_OWNER = "l_suppkey"


def fights(spark, sf):
    """Lines as fights of a supplier: won if the line is filled, method by part type.

    The outcomes are classed on the part side, once per part and not once per line.
    """
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_partkey", "l_returnflag", (F.col("l_linestatus") == "F").alias("is_winner")
    )
    methods = tally.classed(stand_in(spark, sf, "outcomes"))
    return lookup(lines, methods, "l_partkey", "inner").drop("l_partkey")


def match_tally(spark, sf):
    return tally.counted(fights(spark, sf), [_OWNER])


def tally_page(spark, sf):
    """First page of owners by wins, with the owner's country and the count of all.

    The tally is paged and counted, so it is staged.
    """
    tallies = staged(match_tally(spark, sf).withColumn("id", F.col(_OWNER)), "tally")
    paging = Paging.of(1, 20)
    page = reads.page_of(tallies, "total_wins", paging)
    owners = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", "s_nationkey")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    total = tallies.agg(F.count("*")).scalar()
    return (
        page.join(owners, "id", "left")
        .join(nations, "s_nationkey", "left")
        .select("id", "total_wins", "total_losses", "s_name", "n_name", total.alias("total_owners"))
    )


def totals_from_breakdown(spark, sf):
    """Totals hidden for owners with an odd key, then filled from the breakdown."""
    tallies = match_tally(spark, sf)
    hidden = F.when(F.col(_OWNER) % 3 == 0, F.lit(0)).when(
        F.col(_OWNER) % 3 == 1, F.lit(None).cast("bigint")
    )
    for total in ("total_wins", "total_losses"):
        tallies = tallies.withColumn(
            total, F.when(F.col(_OWNER) % 3 == 2, F.col(total)).otherwise(hidden)
        )
    filled = tally.totals_from_breakdown({c: F.col(c) for c in COUNTERS})
    return tallies.select(_OWNER, *[c.alias(n) for n, c in filled.items()])


def merge_stats(spark, sf):
    """Tally over all lines as the page's values, tally over returned ones put over it."""
    rows = fights(spark, sf)
    pages = tally.counted(rows, [_OWNER])
    returned = tally.counted(rows.filter(F.col("l_returnflag") == "R"), [_OWNER])
    return tally.merged_with_tally(pages, returned, _OWNER)


def labels_to_counters(spark, sf):
    """Label/value rows made of parts, first value per counter and brand."""
    pairs = table(spark, sf, "part").select(
        "p_brand",
        "p_partkey",
        F.concat(
            F.when(F.col("p_size") % 2 == 0, "  Wins ").otherwise("LOSSES\tby  "),
            F.initcap(
                F.when(F.col("p_type") == "PROMO", "submission")
                .when(F.col("p_type") == "ECONOMY", "Points decision")
                .when(F.col("p_type") == "LARGE", "decision")
                .when(F.col("p_type") == "SMALL", "disqualification")
                .otherwise("total")
            ),
        ).alias("label"),
        F.concat(F.lit("n "), F.col("p_size"), F.lit(",5")).alias("value"),
    )
    return tally.first_counters(pairs, ["p_brand"], F.col("p_partkey"))


QUERIES = {
    f.__name__: f
    for f in (match_tally, tally_page, totals_from_breakdown, merge_stats, labels_to_counters)
}


def counters_sql(flag: str = "is_winner") -> str:
    """Ten counters from rows (flag, method)."""
    columns = []
    for side, test in (("wins", flag), ("losses", f"NOT {flag}")):
        columns.append(f"CAST(count(CASE WHEN {test} THEN 1 END) AS BIGINT) AS total_{side}")
        columns += [
            f"CAST(count(CASE WHEN {test} AND method = '{m}' THEN 1 END) AS BIGINT) AS {side}_by_{m}"
            for m in METHODS
        ]
    return ", ".join(columns)


_FOUGHT = """
    SELECT l_suppkey, l_returnflag, l_linestatus = 'F' AS is_winner,
        CASE p_type WHEN 'PROMO' THEN 'submission' WHEN 'ECONOMY' THEN 'decision'
            WHEN 'LARGE' THEN 'points' WHEN 'SMALL' THEN 'dq' ELSE '' END AS method
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'STANDARD'
"""
_TALLY = f"SELECT l_suppkey, {counters_sql()} FROM ({_FOUGHT}) GROUP BY l_suppkey"


def _filled_sql(side: str) -> str:
    parts = " + ".join(f"{side}_by_{m}" for m in METHODS)
    return f"""CASE WHEN l_suppkey % 3 = 2 AND total_{side} > 0 THEN total_{side}
        WHEN {parts} > 0 THEN {parts} WHEN l_suppkey % 3 = 1 THEN NULL
        ELSE 0 END AS total_{side}"""


def _first_counter_sql(counter: str) -> str:
    return (
        f"arg_min(p_size, p_partkey) FILTER (WHERE counter = '{counter}') AS {counter}"
    )


SQL = {
    "match_tally": _TALLY,
    "tally_page": f"""
        SELECT l_suppkey AS id, total_wins, total_losses, s_name, n_name,
            (SELECT count(*) FROM ({_TALLY})) AS total_owners
        FROM (SELECT * FROM ({_TALLY}) ORDER BY total_wins DESC, l_suppkey LIMIT 20)
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "totals_from_breakdown": f"""
        SELECT l_suppkey, {_filled_sql("wins")}, {_filled_sql("losses")},
            {", ".join(c for c in COUNTERS if not c.startswith("total"))}
        FROM ({_TALLY})""",
    "merge_stats": f"""
        SELECT p.l_suppkey,
            {", ".join(f"CASE WHEN t.{c} > 0 THEN t.{c} ELSE p.{c} END AS {c}" for c in COUNTERS)}
        FROM ({_TALLY}) p LEFT JOIN (
            SELECT l_suppkey, {counters_sql()} FROM ({_FOUGHT}) WHERE l_returnflag = 'R'
            GROUP BY l_suppkey) t ON p.l_suppkey = t.l_suppkey""",
    "labels_to_counters": f"""
        SELECT p_brand, {", ".join(_first_counter_sql(c) for c in COUNTERS)}
        FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'wins' ELSE 'losses' END AS side,
                CASE p_type WHEN 'PROMO' THEN '_by_submission' WHEN 'ECONOMY' THEN '_by_points'
                    WHEN 'LARGE' THEN '_by_decision' WHEN 'SMALL' THEN '_by_dq' END AS tail,
                coalesce(side || tail, 'total_' || side) AS counter FROM part)
        GROUP BY p_brand""",
}
