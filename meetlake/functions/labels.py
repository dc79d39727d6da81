"""Classification of outcome texts, statistic labels, tile labels and belts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meetlake.functions.text import strip

METHODS = ("submission", "points", "decision", "dq")

WIN_COUNTERS = ("total_wins",) + tuple(f"wins_by_{m}" for m in METHODS)
LOSS_COUNTERS = ("total_losses",) + tuple(f"losses_by_{m}" for m in METHODS)
COUNTERS = WIN_COUNTERS + LOSS_COUNTERS

# Text tested for, in order, and the tile counter it names.
TILE_LABELS = (
    ("wins", "total_wins"),
    ("losses", "total_losses"),
    ("athletes", "athlete_count"),
    ("members", "athlete_count"),
    ("gold", "gold_medals"),
    ("silver", "silver_medals"),
    ("bronze", "bronze_medals"),
)
TILE_COUNTERS = tuple(dict.fromkeys(counter for _, counter in TILE_LABELS))

# Belt colours read as a rank.
BELT_PATTERN = r"\b(white|blue|purple|brown|black)\s+belt\b"


def _names(text: Column, method: str) -> Column:
    if method == "dq":
        return F.contains(text, F.lit("dq")) | F.contains(text, F.lit("disqualification"))
    return F.contains(text, F.lit(method))


def _first_method(text: Column, order: tuple[str, ...], otherwise: str) -> Column:
    chosen = F.when(_names(text, order[0]), order[0])
    for method in order[1:]:
        chosen = chosen.when(_names(text, method), method)
    return chosen.otherwise(otherwise)


def normal_outcome(outcome: Column) -> Column:
    return F.lower(strip(outcome))


def outcome_method(outcome: Column) -> Column:
    """Method named by a lower-case text, decision before points (FN-9, FN-27)."""
    return _first_method(outcome, ("submission", "decision", "points", "dq"), "")


def is_bye(outcome: Column) -> Column:
    """Bye or walkover: no match was fought (FN-10)."""
    return F.contains(outcome, F.lit("bye")) | F.contains(outcome, F.lit("walkover"))


def stat_counter(label: Column) -> Column:
    """Counter named by a normal label, null if none; points before decision (FN-17).

    The order of methods differs from `outcome_method` on purpose.
    """
    method = _first_method(label, ("submission", "points", "decision", "dq"), "")
    by_method = F.concat(F.lit("_by_"), method)
    return F.when(
        F.contains(label, F.lit("win")),
        F.when(method == "", "total_wins").otherwise(F.concat(F.lit("wins"), by_method)),
    ).when(
        F.contains(label, F.lit("loss")),
        F.when(method == "", "total_losses").otherwise(F.concat(F.lit("losses"), by_method)),
    )


def tile_counter(label: Column) -> Column:
    """Academy counter named by a tile label, null if none (HTM-4)."""
    text = F.lower(strip(label))
    chosen = F.when(F.contains(text, F.lit(TILE_LABELS[0][0])), TILE_LABELS[0][1])
    for word, counter in TILE_LABELS[1:]:
        chosen = chosen.when(F.contains(text, F.lit(word)), counter)
    return chosen


def belt_rank(text: Column) -> Column:
    """"… purple  belt …" to "Purple belt"; any other text as it is (FN-15)."""
    colour = F.regexp_extract(F.lower(text), BELT_PATTERN, 1)
    return F.when(colour == "", strip(text)).otherwise(
        F.concat(F.initcap(colour), F.lit(" belt"))
    )
