"""Rule engine: one pass over the rows, however many rules there are.

A rule is a condition that marks violating rows.  ERROR rules reject a row (the
first violated one, in list order, is named); WARNING rules only count.  Every
rule sees the whole input, not the survivors of earlier rules.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from coverlens.functions import text
from coverlens.operators.dedupe import flag_repeats
from coverlens.operators.lookups import flag_member

ERROR = "ERROR"
WARNING = "WARNING"

FIRST_ERROR = "_first_error"
FIRST_REASON = "_first_reason"


@dataclass(frozen=True)
class Rule:
    """``violates`` is a condition, or a function that adds the column ``flag`` to a frame.

    The second form is for rules that need a join or an aggregation; the flags it
    adds are then read like any other column.
    """

    name: str
    description: str
    severity: str
    violates: Column | Callable[[DataFrame, str], DataFrame]


def _flag(rule: Rule) -> str:
    return f"_violates_{rule.name}"


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add one flag per rule plus the first violated ERROR rule and its reason."""
    flagged = df
    for rule in rules:
        if callable(rule.violates) and not isinstance(rule.violates, Column):
            flagged = rule.violates(flagged, _flag(rule))
    plain = {_flag(r): F.coalesce(r.violates, F.lit(False)) for r in rules if isinstance(r.violates, Column)}
    if plain:
        flagged = flagged.withColumns(plain)
    errors = [r for r in rules if r.severity == ERROR]
    none = F.lit(None).cast("string")
    first = F.coalesce(*[F.when(F.col(_flag(r)), r.name) for r in errors], none)
    reason = F.coalesce(*[F.when(F.col(_flag(r)), r.description) for r in errors], none)
    return flagged.withColumns({FIRST_ERROR: first, FIRST_REASON: reason})


def _measures(rules: Sequence[Rule]) -> list[Column]:
    counts = [F.count_if(_flag(r)).alias(f"v{i}") for i, r in enumerate(rules)]
    return [F.count(F.lit(1)).alias("evaluated"), F.count_if(F.col(FIRST_ERROR).isNotNull()).alias("rejected"), *counts]


def rule_counts(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: evaluated, accepted, violated.  A single aggregation."""
    entries = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.description).alias("description"),
            F.lit(r.severity).alias("severity"),
            F.col("evaluated"),
            (F.col("evaluated") - F.col(f"v{i}")).alias("accepted"),
            F.col(f"v{i}").alias("violated"),
        )
        for i, r in enumerate(rules)
    ]
    return flagged.agg(*_measures(rules)).select(F.inline(F.array(*entries)))


def totals(flagged: DataFrame) -> DataFrame:
    """One row: evaluated, accepted, rejected rows."""
    rejected = F.count_if(F.col(FIRST_ERROR).isNotNull())
    return flagged.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col(FIRST_ERROR).isNull()).alias("accepted"),
        rejected.alias("rejected"),
    )


def accepted_rows(flagged: DataFrame) -> DataFrame:
    kept = [c for c in flagged.columns if not c.startswith("_violates_") and c not in (FIRST_ERROR, FIRST_REASON)]
    return flagged.where(F.col(FIRST_ERROR).isNull()).select(*kept)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    """Rule, reason and the whole record as a struct, one row per rejected record."""
    kept = [c for c in flagged.columns if not c.startswith("_violates_") and c not in (FIRST_ERROR, FIRST_REASON)]
    return flagged.where(F.col(FIRST_ERROR).isNotNull()).select(
        F.col(FIRST_ERROR).alias("rule"), F.col(FIRST_REASON).alias("reason"), F.struct(*kept).alias("record")
    )


@dataclass(frozen=True)
class Outcome:
    """A finished validation; the frames read what the one pass has written."""

    accepted: DataFrame
    rejected: DataFrame
    counts: DataFrame
    evaluated: int
    rejected_count: int

    @property
    def accepted_count(self) -> int:
        return self.evaluated - self.rejected_count


def validate(df: DataFrame, rules: Sequence[Rule], path: str) -> Outcome:
    """Run the rules and write the flagged rows to ``path``, split by outcome.

    Counters are observed while the rows are written, so the source is read once
    and the accepted and rejected parts are plain scans afterwards.
    """
    spark = df.sparkSession
    flagged = evaluate(df, rules)
    seen = Observation()
    written = (
        flagged.observe(seen, *_measures(rules))
        .drop(*[_flag(r) for r in rules])
        .withColumn("_rejected", F.col(FIRST_ERROR).isNotNull())
    )
    written.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_rejected").parquet(path)
    measured = seen.get
    stored = spark.read.schema(written.schema).parquet(path)
    accepted = accepted_rows(stored.where("not _rejected").drop("_rejected"))
    rejected = rejected_rows(stored.where("_rejected").drop("_rejected"))
    rows = [
        (r.name, r.description, r.severity, measured["evaluated"], measured["evaluated"] - measured[f"v{i}"],
         measured[f"v{i}"])
        for i, r in enumerate(rules)
    ]
    counts = spark.createDataFrame(
        rows, "rule string, description string, severity string, evaluated long, accepted long, violated long"
    )
    return Outcome(accepted, rejected, counts, measured["evaluated"], measured["rejected"])


# Rule builders -------------------------------------------------------------


def negative(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.coalesce(F.col(c) < 0, F.lit(False))
    return condition


def above(column: str, limit: int) -> Column:
    return F.col(column) > limit


def outside_domain(column: str, allowed: Sequence[str]) -> Column:
    """Null is outside too."""
    return ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))


def blank(column: str) -> Column:
    return text.is_blank(column)


def not_matching(column: str, pattern: str, unless: Column | None = None) -> Column:
    bad = ~text.full_match(column, pattern)
    return bad if unless is None else bad & ~F.coalesce(unless, F.lit(False))


def missing(column: str) -> Column:
    return F.col(column).isNull()


def not_in_reference(column: str, reference: DataFrame | None, reference_column: str):
    """Value unknown to a reference table; off where there is no table or it is empty."""

    def add(df: DataFrame, flag: str) -> DataFrame:
        if reference is None or reference.isEmpty():
            return df.withColumn(flag, F.lit(False))
        return flag_member(df, column, reference, reference_column, flag).withColumn(flag, ~F.col(flag))

    return add


def several_names(code: str, name: str, skip: Column | None = None):
    """One code with more than one name.

    Codes in conflict are found by an aggregation with two values per code; only
    those codes are joined back, so no group of rows is gathered.
    """

    def add(df: DataFrame, flag: str) -> DataFrame:
        counted = df.where(F.col(code).isNotNull())
        if skip is not None:
            counted = counted.where(~F.coalesce(skip, F.lit(False)))
        conflicts = (
            counted.groupBy(F.col(code).alias("_code"))
            .agg(F.min(name).alias("_lo"), F.max(name).alias("_hi"))
            .where("_lo <> _hi")
            .select("_code", F.lit(True).alias("_conflict"))
        )
        hit = F.col("_conflict").isNotNull()
        if skip is not None:
            hit = hit & ~F.coalesce(skip, F.lit(False))
        return df.join(conflicts, F.col(code) == F.col("_code"), "left").select(*df.columns, hit.alias(flag))

    return add


def repeated_key(keys: Sequence[str], order: Sequence[str]):
    """Every row of a key but one: the first in ``order``, any single one of rows that are equal in it."""

    def add(df: DataFrame, flag: str) -> DataFrame:
        return flag_repeats(df, keys, order, flag)

    return add
