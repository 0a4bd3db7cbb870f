"""Monthly periods: text ``YYYY-MM``, integer key ``YYYYMM``, first day of the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions.text import as_column

# Month names used in period labels.
MONTH_NAMES = (
    "Janeiro",
    "Fevereiro",
    "Março",
    "Abril",
    "Maio",
    "Junho",
    "Julho",
    "Agosto",
    "Setembro",
    "Outubro",
    "Novembro",
    "Dezembro",
)


def parse_period(text: str) -> int:
    """``2024-12`` to 202412."""
    year, _, month = text.partition("-")
    key = int(year) * 100 + int(month)
    if not 1 <= key % 100 <= 12:
        raise ValueError(f"not a month: {text!r}")
    return key


def format_period(key: int) -> str:
    """202412 to ``2024-12``."""
    return f"{key // 100:04d}-{key % 100:02d}"


def period_of_date(value: Column | str) -> Column:
    c = as_column(value)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def period_of_text(value: Column | str) -> Column:
    parts = F.split(as_column(value), "-")
    return (F.get(parts, F.lit(0)).try_cast("int") * 100 + F.get(parts, F.lit(1)).try_cast("int")).cast("int")


def period_year(key: Column | str) -> Column:
    return F.floor(as_column(key) / 100).cast("int")


def period_month(key: Column | str) -> Column:
    return (as_column(key) % 100).cast("int")


def period_date(key: Column | str) -> Column:
    return F.make_date(period_year(key), period_month(key), F.lit(1))


def period_text(key: Column | str) -> Column:
    return F.concat_ws(
        "-",
        F.lpad(period_year(key).cast("string"), 4, "0"),
        F.lpad(period_month(key).cast("string"), 2, "0"),
    )


def month_name(key: Column | str, names: tuple[str, ...] = MONTH_NAMES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), period_month(key))


def period_label(key: Column | str) -> Column:
    return F.concat_ws("/", month_name(key), period_year(key).cast("string"))


def period_attributes(df: DataFrame, key: str = "period_key") -> DataFrame:
    """Add every time-dimension attribute; all of them follow from the key."""
    month = period_month(key)
    return df.withColumns(
        {
            "period_date": period_date(key),
            "year": period_year(key),
            "month": month,
            "month_name": month_name(key),
            "quarter": F.quarter(period_date(key)),
            "half": F.when(month <= 6, 1).otherwise(2),
            "period_label": period_label(key),
        }
    )


def landing_file_name(state: Column | str, key: Column | str) -> Column:
    """The landed archive expected for one state and month."""
    return F.format_string("pda-024-icb-%s-%04d_%02d.zip", as_column(state), period_year(key), period_month(key))
