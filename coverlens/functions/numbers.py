"""Numbers, dates and guarded ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from coverlens.functions.text import as_column

HUNDRED = Decimal("100.0")


def safe_long(value: Column | str) -> Column:
    """Whole number from text; fractions are cut off, anything unreadable is 0."""
    c = as_column(value)
    # The engine also reads type suffixes (12d, 1f); digits, sign, point and exponent alone make a number here.
    plain = c.cast("string").rlike(r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$")
    number = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    return F.coalesce(F.when(plain, number), F.lit(0).cast("bigint"))


def safe_date(value: Column | str) -> Column:
    """Date from text, null where it is none."""
    return as_column(value).try_cast("date")


def guarded_ratio(
    numerator: Column | str,
    denominator: Column | str,
    numerator_type: str = "decimal(20,2)",
    result_type: str = "decimal(38,13)",
) -> Column:
    """Decimal ratio; a zero or missing denominator gives null."""
    num, den = as_column(numerator), as_column(denominator)
    quotient = num.cast(numerator_type) / den.cast("decimal(17,0)")
    return F.when(F.coalesce(den, F.lit(0)) != 0, quotient.cast(result_type))


def percent_of(part: Column | str, whole: Column | str, result_type: str = "decimal(6,2)") -> Column:
    """``part`` as percent of ``whole``, in decimals; null where ``whole`` is 0 or null."""
    p, w = as_column(part), F.nullif(as_column(whole), F.lit(0).cast("bigint"))
    share = p.cast("decimal(19,0)") * F.lit(HUNDRED) / w.cast("decimal(19,0)")
    return share.try_cast(result_type)


def percent_change(
    current: Column | str, previous: Column | str, result_type: str = "decimal(14,2)"
) -> Column:
    """Change in percent; null unless the previous value is positive.

    The default type is wider than a dashboard needs, so that growth from a tiny
    base is shown instead of failing or turning into null.
    """
    cur, prev = as_column(current), as_column(previous)
    return F.when(prev > 0, percent_of(cur - prev, prev, result_type))
