"""Ranks, shares, previous values and top rows over aggregated frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.operators.rangecut import ranked_in_order


def with_previous(df: DataFrame, value: str, order: str, by: Sequence[str] = (), name: str = "previous") -> DataFrame:
    """Add the value of the preceding *loaded* period (a missing month is skipped over).

    Call it on aggregated rows: a group then has one row per period, which the
    calendar bounds, also where ``by`` is empty.
    """
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(order)))


def rank_within(df: DataFrame, by: Sequence[str], value: str, name: str, dense: bool = False) -> DataFrame:
    """Rank by descending value within small groups (states of a period, say)."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc())
    return df.withColumn(name, (F.dense_rank() if dense else F.rank()).over(w))


def rank_spread(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    rank: str | None = None,
    dense_rank: str | None = None,
    group_total: str | None = None,
) -> DataFrame:
    """Rank by descending value within groups of any size, exactly as a window would.

    A window puts a whole group into one task.  Here rows are cut by ranges of group and value, see ``rangecut``; the frame is read once,
    when this is called.  The total of a group is added up within tasks first; null groups have one as well.
    """
    found = ranked_in_order(df, by, value, "_rank", "_dense_rank")
    kept = [F.col(old).alias(new) for old, new in (("_rank", rank), ("_dense_rank", dense_rank)) if new]
    if not group_total:
        return found.select(*df.columns, *kept)
    # As one struct: structs with null fields are equal, so null groups find their total.
    grouped = found.withColumn("_group", F.struct(*by))
    totals = grouped.groupBy("_group").agg(F.sum(value).alias(group_total))
    return grouped.join(totals, "_group").select(*df.columns, *kept, group_total)


def top_n(df: DataFrame, n: int, *order: Column | str, drop_null: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; give a tie-break to make the cut repeatable."""
    rows = df.dropna(subset=list(drop_null)) if drop_null else df
    return rows.orderBy(*order).limit(n)


def top_by_stored_rank(df: DataFrame, rank: str, n: int) -> DataFrame:
    """Per group, the rows whose stored rank is at most ``n`` (ties included)."""
    return df.where(F.col(rank) <= n)


def share_of_top(df: DataFrame, n: int, order: Sequence[Column | str], share: str, name: str) -> DataFrame:
    """One row: the summed share of the ``n`` leading rows."""
    return top_n(df, n, *order).agg(F.sum(share).alias(name))


def latest(df: DataFrame, moment: str, tie_break: str) -> DataFrame:
    """The most recent row."""
    return df.orderBy(F.col(moment).desc(), F.col(tie_break).desc()).limit(1)
