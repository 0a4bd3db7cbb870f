"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.session import materialise

STEPS = 1_000_000


def thinning(counted: DataFrame, kind: str, most: int) -> Column:
    """A filter on rows (doc_id, ``kind``) that leaves about twice ``most`` of each kind, by a hash of the id.

    ``counted`` holds the kinds of all rows.  A kind of no more rows than that is left whole, so what follows (a rank
    and a cut at ``most``) sees a bounded number of rows however many there are.
    """
    sizes = counted.groupBy(kind).agg(F.count("*").alias("n")).collect()  # one row per kind
    share = F.lit(STEPS)
    for row in sizes:
        if row["n"] > 2 * most:
            share = F.when(F.col(kind) == row[kind], F.lit(max(1, STEPS * 2 * most // row["n"]))).otherwise(share)
    return F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(STEPS)) < share


def drawn(docs: DataFrame, kinds: DataFrame, kind: str, most: dict, columns: list[str], least: int, chars: int) -> DataFrame:
    """Rows of ``docs`` with the columns of ``kinds`` and ``nth``: of each kind at most ``most[kind]`` ids, in the order of a hash of the id.

    ``kinds`` is (doc_id, ``kind``, others), one row per id.  Only texts of ``least`` to ``chars`` characters are drawn.  Ids are drawn first, so no text
    is shuffled before its id is chosen; the chosen ids are as many as ``most`` allows and are broadcast.  Of several
    texts of one id the one with the lowest hash is taken.
    """
    size = F.coalesce(F.length("text"), F.lit(0)).between(least, chars)
    few = kinds.where(thinning(kinds, kind, max(most.values())))
    ids = docs.where(size & F.col("doc_id").isNotNull()).select("doc_id").distinct().join(few, "doc_id")
    nth = F.row_number().over(Window.partitionBy(kind).orderBy(F.xxhash64("doc_id"), "doc_id"))
    bound = F.lit(0)
    for value, n in most.items():
        bound = F.when(F.col(kind) == value, n).otherwise(bound)
    chosen = materialise(ids.withColumn("nth", nth).where(F.col("nth") <= bound), "drawn-ids")
    names = [c for c in columns if c != "doc_id"]
    found = docs.where(size).select("doc_id", *names).join(F.broadcast(chosen), "doc_id")
    row = F.min_by(F.struct(*names), F.xxhash64("text")).alias("row")
    return found.groupBy(*chosen.columns).agg(row).select(*chosen.columns, "row.*")
