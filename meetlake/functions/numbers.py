"""Number readers on Columns; each states what it does with text that is no number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meetlake.functions.text import strip

_INTEGER = r"^[+-]?[0-9]+$"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def first_int(text: Column) -> Column:
    """First run of digits, null if none or beyond 64 bits (FN-6). "1,234" gives 1: kept on
    purpose."""
    digits = F.nullif(F.regexp_extract(text, r"[0-9]+", 0), F.lit(""))
    return digits.try_cast("bigint")


def strict_int(text: Column) -> Column:
    """Whole text as an integer, null otherwise; a plain cast would accept ' 7 '."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def comma_int(text: Column) -> Column:
    """Integer with thousands commas, 0 if it is none (FN-7)."""
    return F.coalesce(strict_int(F.replace(strip(text), F.lit(","), F.lit(""))), F.lit(0))


def birth_year(text: Column) -> Column:
    """All-digit text as year, else 0 (FN-18)."""
    return F.coalesce(strict_int(text), F.lit(0))


def strict_double(text: Column) -> Column:
    """Whole text as a decimal number, null otherwise."""
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def flexible_double(value: Column) -> Column:
    """Number, numeric text, empty text or null in one field, as text (FN-14)."""
    return strict_double(F.nullif(value, F.lit("")))


def is_bad_flexible_double(value: Column) -> Column:
    """True where `flexible_double` has text it cannot read: the payload is unsound."""
    filled = value.isNotNull() & (value != "")
    return filled & strict_double(value).isNull()


def first_weight(texts: Column) -> Column:
    """First text of the list that is a number, else 0 (JSN-3); null texts are passed over."""
    numeric = F.filter(texts, lambda t: t.rlike(_DECIMAL))
    return F.coalesce(F.get(numeric, F.lit(0)).try_cast("double"), F.lit(0.0))
