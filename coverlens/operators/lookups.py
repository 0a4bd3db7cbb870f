"""Joins against dimensions and between tables.

No side is broadcast by hint: Spark broadcasts a side only after checking its
size, and beyond that it sorts and merges, splitting skewed partitions at run
time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def lookup_key(
    df: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    key: str,
    default: int = -1,
    alias: str | None = None,
) -> DataFrame:
    """Left lookup of a surrogate key; rows without a member get ``default``.

    ``on`` maps columns of ``df`` to columns of the dimension.  The dimension must
    have one row per natural key (its current rows).
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    small = dimension.select(
        *[F.col(d).alias(f"_d{i}") for i, d in enumerate(pairs.values())], F.col(key).alias("_sk")
    )
    condition = _all([F.col(c) == F.col(f"_d{i}") for i, c in enumerate(pairs)])
    found = F.coalesce(F.col("_sk"), F.lit(default).cast("bigint")).alias(alias or key)
    return df.join(small, condition, "left").select(*df.columns, found)


def left_measures(
    left: DataFrame, right: DataFrame, on: Sequence[str], measures: Sequence[str], default: int = 0
) -> DataFrame:
    """Left join of two aggregates; a measure that is missing on the right counts ``default``."""
    joined = left.join(right.select(*on, *measures), list(on), "left")
    return joined.withColumns({m: F.coalesce(F.col(m), F.lit(default).cast("bigint")) for m in measures})


def left_where(
    left: DataFrame, right: DataFrame, on: Sequence[str], right_filter: Column | str
) -> DataFrame:
    """Left join whose ON clause also holds a condition on the right side.

    Filtering the right side first is the same and reaches the files.
    """
    return left.join(right.where(right_filter), list(on), "left")


def without_match(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """NOT EXISTS on one or more keys."""
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    keys = right.select(*[F.col(r).alias(f"_r{i}") for i, r in enumerate(pairs.values())])
    return left.join(keys, _all([F.col(c) == F.col(f"_r{i}") for i, c in enumerate(pairs)]), "left_anti")


def same_or_blank(left: Column, right: Column) -> Column:
    """Equality in which null and the empty text are one value."""
    return F.coalesce(left, F.lit("")) == F.coalesce(right, F.lit(""))


def differs(left: Column, right: Column, text: bool) -> Column:
    """Change test: null equals null, and for text null equals blank."""
    return ~same_or_blank(left, right) if text else ~left.eqNullSafe(right)


def changed_rows(
    old: DataFrame, new: DataFrame, on: Sequence[str], compared: Sequence[str]
) -> DataFrame:
    """Rows present on both sides whose compared columns differ: keys, old_*, new_*."""
    text = {f.name for f in old.schema if f.dataType.typeName() == "string"}
    a = old.select(*on, *[F.col(c).alias(f"old_{c}") for c in compared])
    b = new.select(*on, *[F.col(c).alias(f"new_{c}") for c in compared])
    tests = [differs(F.col(f"old_{c}"), F.col(f"new_{c}"), c in text) for c in compared]
    return a.join(b, list(on)).where(reduce(lambda x, y: x | y, tests))


def flag_member(df: DataFrame, column: str, reference: DataFrame, reference_column: str, flag: str) -> DataFrame:
    """Add ``flag``: true where the value occurs in the reference."""
    known = reference.select(F.col(reference_column).alias("_ref")).where("_ref is not null").distinct()
    known = known.withColumn("_known", F.lit(True))
    return df.join(known, F.col(column) == F.col("_ref"), "left").select(
        *df.columns, F.col("_known").isNotNull().alias(flag)
    )


def foreign_key_violations(
    fact: DataFrame, dimension: DataFrame, on: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Key values of the fact that no dimension row has, with their row count.

    Keys are counted before the anti join, so it sees distinct keys only.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    present = fact.groupBy(*pairs).agg(F.count(F.lit(1)).alias("rows"))
    present = present.where(_all([F.col(c).isNotNull() for c in pairs]))
    return without_match(present, dimension, pairs)
