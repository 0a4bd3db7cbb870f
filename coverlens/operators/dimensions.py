"""Dimension maintenance: key assignment, Type 1 and Type 2 upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.operators.lookups import differs

KEY_BUCKET_DIGITS = 3


def assign_keys(members: DataFrame, natural_key: Sequence[str], sk: str, start: Column | int = 0) -> DataFrame:
    """Number the members ``start+1, start+2, ...`` without gaps.

    Members (one row per natural key) are spread over 4096 buckets by the hash of
    their key and numbered inside; a 4096-row table of running counts lifts each
    bucket.  So no single task sorts them all, and the numbers depend on the keys
    alone, not on partitioning: a retried task gives the same ones.
    """
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key]))
    bucketed = members.withColumn("_bucket", F.substring(digest, 1, KEY_BUCKET_DIGITS))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    lifts = sizes.select(
        F.col("_bucket").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_lift")
    )
    inside = Window.partitionBy("_bucket").orderBy(*natural_key)
    base = F.lit(start) if isinstance(start, int) else start
    # At most 4096 rows by construction, hence the hint.
    numbered = bucketed.withColumn("_n", F.row_number().over(inside)).join(
        F.broadcast(lifts), F.col("_bucket") == F.col("_of")
    )
    return numbered.select(*members.columns, (base + F.col("_lift") + F.col("_n")).cast("bigint").alias(sk))


def highest_key(dimension: DataFrame, sk: str) -> Column:
    """The greatest key in use (0 if none) as a scalar subquery."""
    return dimension.agg(F.coalesce(F.greatest(F.max(sk), F.lit(0)), F.lit(0)).cast("bigint").alias("k")).scalar()


def with_unknown(dimension: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add the sentinel member if the dimension does not hold it yet."""
    spark = dimension.sparkSession
    row = tuple(values.get(f.name) for f in dimension.schema.fields)
    sentinel = spark.createDataFrame([row], dimension.schema)
    sk = next(iter(values))
    return dimension.unionByName(sentinel.join(dimension.select(sk), sk, "left_anti").select(*dimension.columns))


def upsert_type1(
    dimension: DataFrame,
    incoming: DataFrame,
    natural_key: Sequence[str],
    attributes: Sequence[str],
    sk: str,
    mode: str = "overwrite",
) -> DataFrame:
    """Keep existing keys, add new members; ``overwrite`` also refreshes attributes.

    ``incoming`` holds one row per natural key.  ``insert_only`` leaves existing
    members as they are.
    """
    if mode not in ("overwrite", "insert_only"):
        raise ValueError(f"unknown mode {mode!r}")
    fresh = incoming.select(*natural_key, *[F.col(a).alias(f"_new_{a}") for a in attributes], F.lit(True).alias("_in"))
    merged = dimension.join(fresh, list(natural_key), "full")
    kept = merged.where(F.col(sk).isNotNull())
    if mode == "overwrite":
        refreshed = {
            a: F.when(F.col("_in") & (F.col(sk) > 0), F.col(f"_new_{a}")).otherwise(F.col(a)) for a in attributes
        }
        kept = kept.withColumns(refreshed)
    added = merged.where(F.col(sk).isNull()).select(*natural_key, *[F.col(f"_new_{a}").alias(a) for a in attributes])
    numbered = assign_keys(added, natural_key, sk, highest_key(dimension, sk))
    columns = [sk, *natural_key, *attributes]
    return kept.select(*columns).unionByName(numbered.select(*columns))


def upsert_type2(
    dimension: DataFrame,
    incoming: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    others: Sequence[str],
    sk: str,
    effective: str | Column,
    refresh_others: bool = False,
    close_missing: bool = False,
) -> DataFrame:
    """Slowly changing dimension with versions.

    A change in a tracked attribute closes the current version on ``effective``
    and opens a new one; a second change on the same day replaces the version
    opened that day.  ``refresh_others`` overwrites untracked attributes of
    unchanged members; ``close_missing`` closes members that left the source.
    """
    day = F.lit(effective).cast("date") if isinstance(effective, str) else effective
    attributes = [*tracked, *others]
    text = {f.name for f in incoming.schema if f.dataType.typeName() == "string"}
    columns = [sk, natural_key, *attributes, "valid_from", "valid_to", "is_current"]

    history = dimension.where(~F.col("is_current")).select(*columns)
    # A load dated before a current version would close it before it began: such a load fails when it runs.
    too_late = F.concat(F.lit("version begins after the load's day, key "), F.col(natural_key).cast("string"))
    dated = F.when((F.col("valid_from") > day) & (F.col(sk) > 0), F.raise_error(too_late).cast("date")).otherwise(F.col("valid_from"))
    current = dimension.where("is_current").withColumn("valid_from", dated)
    fresh = incoming.select(
        F.col(natural_key).alias("_key"), *[F.col(a).alias(f"_new_{a}") for a in attributes]
    )
    merged = current.join(fresh, F.col(natural_key) == F.col("_key"), "full")
    changed = reduce(
        lambda a, b: a | b, [differs(F.col(a), F.col(f"_new_{a}"), a in text) for a in tracked]
    )
    state = (
        F.when(F.col(sk).isNull(), "new")
        .when(F.col("_key").isNull(), "missing")
        .when(changed & (F.col("valid_from") == day), "replaced")
        .when(changed, "changed")
        .otherwise("same")
    )
    merged = merged.withColumn("_state", state)

    closing = ["changed", "missing"] if close_missing else ["changed"]
    # The sentinel has no source row and never closes.
    closes = F.col("_state").isin(*closing) & (F.col(sk) > 0)
    rewritten = {a: F.when(F.col("_state") == "replaced", F.col(f"_new_{a}")).otherwise(F.col(a)) for a in tracked}
    takes_others = ["replaced", "same"] if refresh_others else ["replaced"]
    rewritten.update(
        {a: F.when(F.col("_state").isin(*takes_others), F.col(f"_new_{a}")).otherwise(F.col(a)) for a in others}
    )
    standing = (
        merged.where("_state <> 'new'")
        .withColumns(rewritten)
        .withColumns({"valid_to": F.when(closes, day).otherwise(F.col("valid_to")), "is_current": ~closes})
        .select(*columns)
    )
    opened = merged.where(F.col("_state").isin("new", "changed")).select(
        F.col("_key").alias(natural_key),
        *[F.col(f"_new_{a}").alias(a) for a in attributes],
        day.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    numbered = assign_keys(opened, [natural_key], sk, highest_key(dimension, sk))
    return history.unionByName(standing).unionByName(numbered.select(*columns))


def current_violations(dimension: DataFrame, natural_key: str) -> DataFrame:
    """Natural keys without exactly one current version."""
    counted = dimension.groupBy(natural_key).agg(F.count_if("is_current").alias("current_versions"))
    return counted.where("current_versions <> 1")
