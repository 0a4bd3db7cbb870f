"""Raw to cleaned: the three inputs, standardised, deduplicated, at their grain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.functions import text
from coverlens.functions.numbers import safe_date, safe_long
from coverlens.operators import dedupe, shape
from coverlens.operators.grain import sum_to_grain
from coverlens.sources.archives import FILE, POSITION
from coverlens.sources.delimited import ORIGIN


@dataclass(frozen=True)
class Cleaned:
    """A cleaned frame and the counters that fill while it is written.

    Counters are carried through the shuffles as columns and observed in the last
    stage only, where a task that runs twice is still counted once.
    """

    frame: DataFrame
    seen: Observation

    def statistics(self) -> dict[str, int]:
        """Counters by name; valid once the frame has been written in full."""
        return {name: value or 0 for name, value in self.seen.get.items()}


def _counted(df: DataFrame, columns: Sequence[str], *measures: Column) -> Cleaned:
    seen = Observation()
    return Cleaned(df.observe(seen, F.count(F.lit(1)).alias("rows_written"), *measures).select(*columns), seen)


def clean_enrolment(raw: DataFrame, period: int, state_codes: Sequence[str] = layouts.STATE_CODES) -> Cleaned:
    """Whole-row duplicates go first, then the rows are added up at the fact grain.

    ``raw`` has all columns of the file: a row is a duplicate only if every column
    repeats, so plans that share the grain are added and not lost.
    """
    shape.require_columns(raw, layouts.ENROLMENT_NAMES, "the enrolment file")
    content = [c for c in raw.columns if c not in (FILE, POSITION)]
    distinct = raw.groupBy(*content).agg(F.count(F.lit(1)).alias("_copies"))
    named = distinct.select(*[F.col(old).alias(new) for old, new in layouts.ENROLMENT_NAMES.items()], "_copies")
    standard = named.withColumns(
        {
            "period_key": F.lit(period),
            "carrier_code": text.strip("carrier_code"),
            # The code stays as delivered; padding would invent another locality.
            "locality_code": text.strip("locality_code"),
            "locality_name": text.strip("locality_name"),
            "state": text.to_domain(text.strip_upper("state"), state_codes, layouts.UNKNOWN_STATE),
            "sex": text.blank_to_null(text.strip_upper("sex")),
            "age_band": text.strip("age_band"),
            "tie_type": text.strip("tie_type"),
            "segment": text.strip("segment"),
            **{m: safe_long(m) for m in layouts.MEASURES},
        }
    )
    standard = standard.withColumn("_distinct", F.lit(1).cast("bigint"))
    summed = sum_to_grain(standard, layouts.ENROLMENT_GRAIN, [*layouts.MEASURES, "_copies", "_distinct"])
    return _counted(
        summed,
        [*layouts.ENROLMENT_GRAIN, *layouts.MEASURES],
        F.sum("_copies").alias("rows_read"),
        F.sum(F.col("_copies") - F.col("_distinct")).alias("exact_duplicates"),
        F.sum(F.col("_copies") - 1).alias("rows_merged"),
    )


def clean_carriers(raw: DataFrame, state_codes: Sequence[str] = layouts.STATE_CODES) -> Cleaned:
    """Keeps the columns the warehouse needs, so personal fields never leave the raw layer."""
    order = [c for c in ORIGIN if c in raw.columns]
    shape.require_columns(raw, layouts.CARRIER_NAMES, "the carrier register")
    rows = raw.select(*[F.col(old).alias(new) for old, new in layouts.CARRIER_NAMES.items()], *order)
    texts = [c for c in layouts.CARRIER_NAMES.values() if c not in ("seat_state", "registered_on")]
    standard = shape.strip_columns(rows, texts).withColumns(
        {
            "seat_state": text.to_domain(text.strip_upper("seat_state"), state_codes, None),
            "registered_on": safe_date("registered_on"),
        }
    )
    columns = list(layouts.CARRIER_NAMES.values())
    first = dedupe.keep_first_counted(standard, ["carrier_code"], order or columns, "_rows")
    return _counted(
        first,
        columns,
        F.sum("_rows").alias("rows_read"),
        F.sum(F.col("_rows") - 1).alias("repeats_removed"),
        F.count_if(text.is_blank("legal_name")).alias("legal_name_missing"),
    )


def clean_facilities(raw: DataFrame, period: int, state_codes: Sequence[str] = layouts.STATE_CODES) -> Cleaned:
    """Unknown layouts are mapped as far as they go; absent columns get defaults."""
    order = [c for c in ORIGIN if c in raw.columns]
    named = shape.rename_known(raw, layouts.FACILITY_NAMES, layouts.FACILITY_REQUIRED)
    known = [c for c in dict.fromkeys(layouts.FACILITY_NAMES.values()) if c in named.columns]
    rows = shape.strip_columns(named.select(*known, *order), known)
    rows = shape.with_defaults(
        rows,
        {
            "state": F.lit(layouts.UNKNOWN_STATE),
            "locality_name": F.lit(layouts.NOT_INFORMED),
            "type_code": F.lit(None).cast("string"),
        },
    )
    rows = shape.with_defaults(rows, {"type_label": F.concat(F.lit("Tipo "), F.col("type_code"))})
    rows = rows.withColumn("state", text.to_domain(F.upper("state"), state_codes, layouts.UNKNOWN_STATE))
    columns = ["facility_code", "facility_name", "type_code", "type_label", "locality_code", "locality_name", "state"]
    first = dedupe.keep_first_counted(rows, ["facility_code"], order or columns, "_rows")
    return _counted(
        first.withColumn("period_key", F.lit(period)),
        [*columns, "period_key"],
        F.sum("_rows").alias("rows_read"),
        F.sum(F.col("_rows") - 1).alias("repeats_removed"),
        F.sum(F.when(text.is_blank("facility_code"), F.col("_rows"))).alias("code_missing"),
    )
