"""Rows known by their id and text, so that texts under one id, and null ids, are told apart.

Rows that agree in both are the same to every operator that reads nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = ("doc_id", "h", "g")


def text_hashes(text: Column | str = "text") -> tuple[Column, Column]:
    """Two hashes of a text as ``h`` and ``g``; of a null one too."""
    return F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")


def same_row(docs: DataFrame, known: DataFrame) -> Column:
    """Whether a row of ``docs`` is one of ``known`` (doc_id, h, g); columns of other names do not matter."""
    h, g = text_hashes(docs["text"])
    return docs["doc_id"].cast("long").eqNullSafe(known["doc_id"]) & (h == known["h"]) & (g == known["g"])


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows named in ``gone`` (doc_id, h, g)."""
    gone = gone.select(*ROW).distinct()
    return docs.join(gone, same_row(docs, gone), "left_anti")
