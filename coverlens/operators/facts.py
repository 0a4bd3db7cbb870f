"""Idempotent fact loads: upsert at the grain, with the actions counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.operators.lookups import same_or_blank

INSERT = "INSERT"
UPDATE = "UPDATE"
KEEP = "KEEP"


def upsert_fact(
    fact: DataFrame,
    staged: DataFrame,
    grain: Sequence[str],
    values: Sequence[str],
    blank_is_null: Sequence[str] = (),
    mode: str = "upsert",
) -> DataFrame:
    """The fact after the load, with the action taken per row in ``_action``.

    Matched rows take the staged values and keep their key texts; unmatched staged
    rows are inserted.  ``replace`` drops fact rows that the staged data no longer
    has, so call it with the touched periods only.  Both sides are unique at the
    grain, which is the join key, so there is no hot key here.
    """
    if mode not in ("upsert", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    old = fact.select(*grain, *values, F.lit(True).alias("_old"))
    new = staged.select(
        *[F.col(g).alias(f"_g_{g}") for g in grain],
        *[F.col(v).alias(f"_v_{v}") for v in values],
        F.lit(True).alias("_new"),
    )
    condition = None
    for g in grain:
        part = same_or_blank(F.col(g), F.col(f"_g_{g}")) if g in blank_is_null else F.col(g) == F.col(f"_g_{g}")
        condition = part if condition is None else condition & part
    merged = old.join(new, condition, "right" if mode == "replace" else "full")
    is_new = F.col("_new").isNotNull()
    is_old = F.col("_old").isNotNull()
    action = F.when(is_old & is_new, UPDATE).when(is_new, INSERT).otherwise(KEEP)
    return merged.select(
        *[F.when(is_old, F.col(g)).otherwise(F.col(f"_g_{g}")).alias(g) for g in grain],
        *[F.when(is_new, F.col(f"_v_{v}")).otherwise(F.col(v)).alias(v) for v in values],
        action.alias("_action"),
    )


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action."""
    return merged.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("rows"))


def network_members(facility: DataFrame, batch: DataFrame, natural_key: str) -> DataFrame:
    """Current facilities that occur in the batch, each once."""
    return (
        facility.where("is_current")
        .join(batch.select(natural_key), natural_key, "left_semi")
        .select("facility_sk", "facility_type_sk", "locality_sk")
    )
