"""Inventory of landed files: hash, size, time, period; each file registered once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.operators.lookups import without_match
from coverlens.sources.storage import list_files, with_sha256

LANDED_SUFFIXES = ("csv", "txt", "zip", "dbc")


def list_landed(spark: SparkSession, path: str, suffixes: Sequence[str] = LANDED_SUFFIXES) -> DataFrame:
    """(path, length, modificationTime, sha256) of the files with an accepted suffix; each is hashed block by block in its task."""
    suffix = F.lower(F.element_at(F.split("path", "[.]"), -1))
    return with_sha256(list_files(spark, path).where(suffix.isin([s.lower() for s in suffixes])))


def file_manifest(
    files: DataFrame, source: Column, period: Column, origin: Column | None = None
) -> DataFrame:
    """One row per file of a (path, modificationTime, length) frame with either its ``sha256`` or its ``content``.

    The origin marks where the file came from (its name by default); two files are
    the same delivery when path and origin agree.
    """
    name = F.element_at(F.split("path", "/"), -1)
    digest = F.col("sha256") if "sha256" in files.columns else F.sha2("content", 256).alias("sha256")
    return files.select(
        F.col("path"),
        source.alias("source"),
        (origin if origin is not None else F.concat(F.lit("manual:"), name)).alias("origin"),
        digest,
        F.col("length").alias("size_bytes"),
        F.date_trunc("second", "modificationTime").alias("landed_at"),
        period.cast("string").alias("period"),
    )


def not_registered(listing: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Files of the listing that the manifest does not hold with the same path and origin."""
    return listing if force else without_match(listing, manifest, ("path", "origin"))
