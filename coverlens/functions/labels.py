"""Display labels with ``.`` for thousands and ``,`` for decimals; null becomes ``-``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coverlens.functions.periods import MONTH_NAMES, month_name, period_year
from coverlens.functions.text import as_column

MISSING = "-"


def _localise(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def integer_label(value: Column | str) -> Column:
    return F.coalesce(_localise(F.format_number(as_column(value).cast("bigint"), 0)), F.lit(MISSING))


def decimal_label(value: Column | str, places: int = 1) -> Column:
    return F.coalesce(_localise(F.format_number(as_column(value).cast("double"), places)), F.lit(MISSING))


def percent_label(value: Column | str, places: int = 1) -> Column:
    text = F.concat(_localise(F.format_number(as_column(value).cast("double"), places)), F.lit("%"))
    return F.coalesce(text, F.lit(MISSING))


def month_label(key: Column | str) -> Column:
    """``dezembro/2024`` from a period key."""
    lower = tuple(n.lower() for n in MONTH_NAMES)
    text = F.concat(month_name(key, lower), F.lit("/"), period_year(key).cast("string"))
    return F.coalesce(text, F.lit(MISSING))


def moment_label(value: Column | str) -> Column:
    return F.coalesce(F.date_format(as_column(value), "dd/MM/yyyy HH:mm"), F.lit(MISSING))
