"""Duplicates: whole rows, and keyed ones where the first row stays.

None of these puts all rows of one key into one task.  Whole-row duplicates and
first rows are combined before the shuffle, and the repeat flag joins on the
row's own position, so a key that holds a third of the table stays spread out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.session import materialise


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def exact_duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: rows read, distinct rows, surplus copies; nulls compare equal."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("exact_duplicates"),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order; null keys form one group.

    The filter on the row number lets Spark cut each group to one row before the
    shuffle, so the size of a group does not matter.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank_in_key", F.row_number().over(w)).where("_rank_in_key = 1").drop("_rank_in_key")


def keep_first_counted(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_name: str
) -> DataFrame:
    """``keep_first`` plus the number of rows each key had, in the same shuffle."""
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias(rows_name)
    )
    return picked.select("_first.*", rows_name)


def repeats_removed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows ``keep_first`` drops."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("repeats_removed"),
    )


def flag_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """Add ``flag``: true for every row of a key but exactly one, the first in ``order``.

    Rows that are equal in key and order are told apart by a row number, so of identical copies one stays.  The
    numbered rows are written to the shared folder once: both sides of the join then see the same numbers, also
    after a retry.  The first position of each key comes from an aggregation; rows find it by key *and*
    position, so even a hot key is joined evenly.
    """
    placed = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "repeats")
    position = [*order, "_row"]
    firsts = placed.groupBy(*keys).agg(F.min(F.struct(*position)).alias("_first"))
    firsts = firsts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_first._row").alias("_first_row"),
        F.lit(True).alias("_is_first"),
    )
    condition = F.col("_row") == F.col("_first_row")
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(firsts, condition, "left").select(*df.columns, F.col("_is_first").isNull().alias(flag))
