"""The business questions, each on top of a mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.functions.numbers import guarded_ratio, percent_of
from coverlens.operators.ranking import rank_spread, top_n, with_previous
from coverlens.plans import marts
from coverlens.plans.star import Star


def evolution(star: Star) -> DataFrame:
    """How do members develop by month?"""
    return marts.monthly_trend(star).select(
        "period_key", "period_label", "active_members", "change", "change_percent"
    ).orderBy("period_key")


def leading_states(star: Star, period: int, n: int = 10) -> DataFrame:
    """Which states have most members?"""
    rows = marts.by_state(star).where(F.col("period_key") == period)
    return top_n(rows, n, "state_rank", "state").select("state_name", "region", "active_members", "state_rank")


def thinnest_localities(star: Star, period: int, n: int = 20) -> DataFrame:
    """Which localities have fewest facilities for their members?"""
    rows = marts.members_per_facility(star).where((F.col("period_key") == period) & (F.col("facilities") > 0))
    return top_n(rows, n, F.desc("members_per_facility"), "state", "locality_code").select(
        "locality_name", "state_name", "active_members", "facilities", "members_per_facility"
    )


def national_ratio(star: Star, period: int) -> DataFrame:
    """Members per facility over the whole country."""
    rows = marts.members_per_facility(star).where(F.col("period_key") == period)
    sums = rows.agg(F.sum("active_members").alias("members"), F.sum("facilities").alias("facilities"))
    return sums.withColumn("ratio", guarded_ratio("members", "facilities"))


def _carrier_changes(star: Star) -> DataFrame:
    joined = marts._members(star, "carrier_sk").join(star.carrier.select("carrier_sk", "carrier_code", "legal_name"),
                                                     "carrier_sk")
    per_period = joined.groupBy("period_key", "carrier_code", "legal_name").agg(
        F.sum("active_members").alias("active_members")
    )
    changed = with_previous(per_period, "active_members", "period_key", ["carrier_code"], "previous_members")
    return changed.where(F.col("previous_members").isNotNull()).withColumn(
        "change", F.col("active_members") - F.col("previous_members")
    )


def fastest_growing(star: Star, n: int = 10) -> DataFrame:
    """Which carriers gained most between two loaded periods?"""
    return top_n(_carrier_changes(star), n, F.desc("change"), "period_key", "carrier_code")


def largest_losses(star: Star, n: int = 10) -> DataFrame:
    """Which carriers lost most?"""
    return top_n(_carrier_changes(star), n, F.asc("change"), "period_key", "carrier_code")


def critical_share(star: Star, period: int, attention: int = 2000, critical: int = 5000) -> DataFrame:
    """Share of localities in the critical class, per region."""
    rows = marts.coverage_class(star, attention, critical).where(F.col("period_key") == period)
    regions = rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("localities"),
        F.count_if(F.col("coverage") == marts.CRITICAL).alias("critical_localities"),
    )
    return regions.withColumn("critical_percent", percent_of("critical_localities", "localities"))


def national_change(star: Star, period: int) -> DataFrame:
    """Change of one period against the one loaded before."""
    return marts.change_of_period(star, period).select(
        "period_label", "active_members", "previous_members", "change_percent"
    )


def common_types(star: Star, period: int) -> DataFrame:
    """Facility types by frequency; the ranked frame has one row per type."""
    rows = marts.facilities_by_type(star).where(F.col("period_key") == period)
    totals = rows.groupBy("type_label").agg(F.sum("facilities").alias("facilities"))
    return rank_spread(totals.withColumn("_all", F.lit(1)), ["_all"], "facilities", rank="type_rank").drop("_all")


def rejects_by_rule(star: Star) -> DataFrame:
    """Violations per rule over all runs."""
    sums = marts.rule_history(star).groupBy("rule", "description", "severity").agg(
        F.sum("violated").alias("violated"), F.sum("evaluated").alias("evaluated")
    )
    return sums.withColumn("violated_percent", percent_of("violated", "evaluated"))


def stage_durations(star: Star) -> DataFrame:
    """Runs, mean and longest duration per stage, finished runs only."""
    done = marts.run_history(star).where(F.col("finished_at").isNotNull())
    return done.groupBy("stage").agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(F.col("duration_seconds").cast("double")).alias("mean_seconds"),
        F.max("duration_seconds").alias("longest_seconds"),
    )


def failure_rates(star: Star) -> DataFrame:
    """Share of failed runs per source."""
    known = marts.run_history(star).where(F.col("source").isNotNull())
    sums = known.groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "FAILED").alias("failed_runs")
    )
    return sums.withColumn("failed_percent", percent_of("failed_runs", "runs"))
