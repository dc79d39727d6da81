"""Text helpers on Columns, built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space characters a trim removes. Spark's own trim
# takes only the blank.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WHITE_SPACE_RUN = r"\p{IsWhite_Space}+"


def strip(text: Column) -> Column:
    """Trim every kind of Unicode white space (FN-0)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0))


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty, else empty (DML-8)."""
    return F.coalesce(*[none_if_empty(t) for t in texts], F.lit(""))


def normal_label(label: Column) -> Column:
    """Trimmed, lower case, inner white space collapsed (FN-8)."""
    return F.regexp_replace(F.lower(strip(label)), _WHITE_SPACE_RUN, " ")


def slug(name: Column) -> Column:
    """Lower case, blanks and slashes to dashes, all but [a-z0-9-] dropped (FN-4)."""
    return F.regexp_replace(F.translate(F.lower(name), " /", "--"), "[^a-z0-9-]+", "")


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """First, middle if any, last (FN-16); first and last always count as parts."""
    return F.concat_ws(" ", or_empty(first), none_if_empty(middle), or_empty(last))


def category_parts(category: Column) -> dict[str, Column]:
    """"A / B / C / D" to its four trimmed parts, all empty if fewer (FN-5)."""
    parts = F.split(category, "/")
    names = ("division", "age_category", "rank", "weight_class")
    return {
        name: or_empty(F.when(F.size(parts) >= 4, strip(F.get(parts, F.lit(i)))))
        for i, name in enumerate(names)
    }


def comma_list(text: Column) -> Column:
    """Comma list to trimmed items that are not blank (FN-23)."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda item: item != "")


def days_text(days: Column) -> Column:
    """Days to start as text, null as empty (FN-13)."""
    return (
        F.when(days.isNull(), "")
        .when(days >= 0, F.concat(days.cast("string"), F.lit(" days left")))
        .otherwise(F.concat((-days).cast("string"), F.lit(" days ago")))
    )


def event_name_or_default(name: Column, event_id: Column) -> Column:
    """"Event <id>" where no name was given (FN-28)."""
    return F.coalesce(none_if_empty(name), F.concat(F.lit("Event "), event_id))


def is_sports_event(type_text: Column) -> Column:
    """Linked-data type test, trimmed and without regard to case (FN-24)."""
    return F.lower(strip(type_text)) == "sportsevent"
