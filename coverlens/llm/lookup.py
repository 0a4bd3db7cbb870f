"""Left joins whose hot keys do not meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOTTEST = 1000  # keys that are broadcast; no other key holds more than one in so many of the rows


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, spread: Column) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has one row per ``keys``; null where it has none.

    ``weight`` is a column of the table that says how many rows look a key up.  The ``HOTTEST`` keys are broadcast, a table of
    bounded size, and their rows skip the shuffled join: they go there under salts made of ``spread`` that meet nothing.  Keys are
    compared as equal when both are null.  ``table`` is read twice, so it should be a written one.
    """
    values = [c for c in table.columns if c not in keys and c != weight]

    def side(frame: DataFrame, mark: str) -> DataFrame:
        return frame.select(*[F.col(k).alias(f"{mark}{k}") for k in keys], F.struct(F.lit(1).alias("one"), *values).alias(f"{mark}of"))

    def met(mark: str) -> Column:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"{mark}{k}"))
        return same

    hot = side(table.orderBy(F.col(weight).desc()).limit(HOTTEST), "_hot_")
    found = rows.join(F.broadcast(hot), met("_hot_"), "left")
    found = found.withColumn("_salt", F.when(F.col("_hot_of").isNotNull(), F.xxhash64(spread)).otherwise(0))
    cold = side(table, "_cold_").withColumn("_none", F.lit(0).cast("long"))
    # A salt that happens to be 0 meets the same row of the table, so nothing depends on it.
    found = found.join(cold, met("_cold_") & (F.col("_salt") == F.col("_none")), "left")
    value = F.coalesce("_hot_of", "_cold_of")
    return found.select(*rows.columns, *[value[c].alias(c) for c in values])
