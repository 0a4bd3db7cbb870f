"""Sums at a grain and the checks that go with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_to_grain(df: DataFrame, grain: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add up rows that share the grain; null is a group of its own."""
    return df.groupBy(*grain).agg(*[F.sum(m).alias(m) for m in measures])


def grain_violations(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("rows_in_key")).where("rows_in_key > 1")


def conservation(source: DataFrame, target: DataFrame, measures: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """One row per measure: total in the source, total in the target, difference.

    A mapping names the target column per source column.
    """
    pairs = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}

    def totals(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
        sums = df.agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(columns)])
        entries = [F.struct(F.lit(m).alias("measure"), F.col(f"_t{i}").alias(side)) for i, m in enumerate(pairs)]
        return sums.select(F.inline(F.array(*entries)))

    left = totals(source, list(pairs), "source_total")
    right = totals(target, list(pairs.values()), "target_total")
    return left.join(right, "measure").withColumn(
        "difference", F.coalesce("source_total", F.lit(0)) - F.coalesce("target_total", F.lit(0))
    )


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for every column the number of null or empty texts."""
    return df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"{c}_blank") for c in columns])


def counts_by_category(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """Rows per category of a fixed list, in list order, 0 where none occur."""
    listed = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(categories)], f"position int, {column} string"
    )
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(counted, column, "left").select("position", column, F.coalesce("rows", F.lit(0)).alias("rows"))
