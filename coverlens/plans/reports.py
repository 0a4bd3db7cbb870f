"""The read API: mart reads, indicators, chart-ready frames, free exploration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions.numbers import percent_of
from coverlens.functions.text import joined_label
from coverlens.operators import profile
from coverlens.operators.grain import counts_by_category
from coverlens.operators.ranking import latest, share_of_top, top_by_stored_rank, top_n
from coverlens.operators.shape import require_columns
from coverlens.plans import marts
from coverlens.plans.star import Star
from coverlens.session import materialise
from coverlens.sources.datasets import capped

VALIDATE_STAGE = "validate_trusted"
LOAD_STAGE = "load"


def _of_period(df: DataFrame, period: int, state: str | None = None) -> DataFrame:
    rows = df.where(F.col("period_key") == period)
    return rows if state is None else rows.where(F.col("state") == state)


# Reads ---------------------------------------------------------------------


def trend(star: Star) -> DataFrame:
    return marts.monthly_trend(star).orderBy("period_key")


def states_of_period(star: Star, period: int) -> DataFrame:
    return _of_period(marts.by_state(star), period).orderBy("state_rank", "state")


def localities_of_period(star: Star, period: int, state: str | None = None) -> DataFrame:
    return _of_period(marts.by_locality(star), period, state).orderBy(F.desc("active_members"), "locality_code")


def carriers_of_period(star: Star, period: int) -> DataFrame:
    return marts.carrier_ranking(star, [period]).orderBy("carrier_rank", "carrier_code")


def available_periods(star: Star) -> DataFrame:
    """Loaded periods, newest first; taken from the key column alone."""
    keys = star.enrolment.select("period_key").distinct()
    return keys.withColumn("period_label", marts.period_label("period_key")).orderBy(F.desc("period_key"))


def available_states(star: Star) -> DataFrame:
    """States that have enrolment."""
    used = star.enrolment.select("locality_sk").distinct()
    return star.locality.join(used, "locality_sk", "left_semi").select("state", "state_name").distinct().orderBy(
        "state_name"
    )


def facility_localities(star: Star, period: int, state: str | None = None) -> DataFrame:
    rows = _of_period(marts.facilities_by_locality(star), period, state)
    return rows.orderBy(F.desc("facilities"), "locality_code")


def facility_types(star: Star, period: int) -> DataFrame:
    return _of_period(marts.facilities_by_type(star), period).orderBy(F.desc("facilities"), "type_code")


def ratios(star: Star, period: int, state: str | None = None) -> DataFrame:
    return _of_period(marts.members_per_facility(star), period, state)


def coverage(star: Star, period: int, state: str | None = None, **thresholds: int) -> DataFrame:
    return _of_period(marts.coverage_class(star, **thresholds), period, state)


def carrier_series(star: Star, carrier_code: str) -> DataFrame:
    """One carrier over all periods.  The fact is partitioned by period, so all of it is scanned and other carriers are dropped."""
    keys = star.carrier.where(F.col("carrier_code") == carrier_code).select("carrier_sk")
    rows = star.enrolment.join(keys, "carrier_sk", "left_semi")
    sums = rows.groupBy("period_key").agg(F.sum("active").alias("active_members"))
    return sums.withColumn("period_date", marts.period_date("period_key")).orderBy("period_key")


def regional_carriers(star: Star, period: int) -> DataFrame:
    return marts.carriers_by_region(star, [period]).orderBy("region", "region_rank", "carrier_code")


def recent_runs(star: Star, n: int = 200) -> DataFrame:
    return top_n(marts.run_history(star), n, F.desc("started_at"), F.desc("run_id"))


def most_violated(star: Star, n: int = 10) -> DataFrame:
    sums = marts.rule_history(star).groupBy("rule", "description", "severity").agg(
        F.sum("violated").alias("violated"), F.sum("evaluated").alias("evaluated")
    )
    return top_n(sums, n, F.desc("violated"), "rule", "severity")


def quality_totals(star: Star, stage: str = VALIDATE_STAGE, latest_run_only: bool = False) -> DataFrame:
    """Rows received, valid and rejected over the runs of a stage.

    ``latest_run_only`` counts a rerun period and source once.
    """
    runs = star.runs.where(F.col("stage") == stage)
    if latest_run_only:
        names = [c for c in runs.columns if c not in ("period", "source")]
        newest = runs.groupBy("period", "source").agg(F.max_by(F.struct(*names), "run_id").alias("r"))
        runs = newest.select("period", "source", "r.*")
    return runs.agg(
        F.sum("received").alias("received"),
        F.sum("valid").alias("valid"),
        F.sum("rejected").alias("rejected"),
        F.max("finished_at").alias("last_update"),
    )


def last_load(star: Star, stage: str = LOAD_STAGE) -> DataFrame:
    return latest(marts.run_history(star).where(F.col("stage") == stage), "started_at", "run_id")


# Indicators ----------------------------------------------------------------


def kpi_row(star: Star, period: int, include_unknown: bool = True, load_stage: str = LOAD_STAGE) -> DataFrame:
    """One row of headline figures; every figure is a scalar subquery, nothing is crossed."""
    summary = marts.state_summary(star, periods=[period])
    head = summary.agg(
        F.coalesce(F.sum("active_members"), F.lit(0)).alias("members"),
        F.coalesce(F.sum("facilities"), F.lit(0)).alias("facilities"),
        F.countDistinct("state").alias("states"),
    )
    sold = star.enrolment.where(F.col("period_key") == period).select("carrier_sk").distinct()
    if not include_unknown:
        sold = sold.where("carrier_sk <> -1")
    carriers = star.carrier.join(sold, "carrier_sk", "left_semi").agg(F.countDistinct("carrier_code").alias("carriers"))
    change = marts.change_of_period(star, period).select("change_percent")
    figures = head.select("*", carriers.scalar().alias("carriers"), change.scalar().alias("change_percent"))
    if star.runs is not None:
        run = last_load(star, load_stage)
        figures = figures.select(
            "*",
            run.select("finished_at").scalar().alias("last_update"),
            run.select("status").scalar().alias("last_status"),
        )
    ratio = F.when(F.col("facilities") != 0, F.round(F.col("members") / F.col("facilities"), 2))
    return figures.withColumn("members_per_facility", ratio)


def approval_percent(star: Star, stage: str = VALIDATE_STAGE) -> DataFrame:
    return quality_totals(star, stage).withColumn("approval_percent", percent_of("valid", "received"))


def without_facility(star: Star, period: int) -> DataFrame:
    """Localities that have members and no facility."""
    return ratios(star, period).where("facilities = 0 and active_members > 0").agg(
        F.count(F.lit(1)).alias("localities_without_facility")
    )


def leading_share(star: Star, period: int, n: int = 5) -> DataFrame:
    """Summed market share of the leading carriers."""
    rows = marts.carrier_ranking(star, [period])
    return share_of_top(rows, n, ["carrier_rank", "carrier_code"], "share_percent", "leading_share")


# Chart-ready frames --------------------------------------------------------


def chart_states(star: Star, period: int, n: int = 15) -> DataFrame:
    rows = _of_period(marts.by_state(star), period)
    return top_n(rows, n, "state_rank", "state").select("state_name", "active_members", "state_rank")


def chart_localities(star: Star, period: int, n: int = 20) -> DataFrame:
    rows = top_n(_of_period(marts.by_locality(star), period), n, F.desc("active_members"), "locality_code")
    return rows.select(joined_label(["locality_name", "state"]).alias("label"), "active_members")


def chart_carriers(star: Star, period: int, n: int = 15) -> DataFrame:
    rows = marts.carrier_ranking(star, [period])
    return top_n(rows, n, "carrier_rank", "carrier_code").select("legal_name", "active_members", "carrier_rank")


def chart_risk(star: Star, period: int, n: int = 20) -> DataFrame:
    """Localities with the highest ratio; those without one are left out."""
    rows = ratios(star, period)
    top = top_n(rows, n, F.desc("members_per_facility"), "locality_code", drop_null=["members_per_facility"])
    return top.select(joined_label(["locality_name", "state"]).alias("label"), "members_per_facility")


def chart_classes(star: Star, period: int, **thresholds: int) -> DataFrame:
    return counts_by_category(coverage(star, period, **thresholds), "coverage", marts.CLASSES)


def chart_region_leaders(star: Star, period: int, n: int = 1) -> DataFrame:
    rows = marts.carriers_by_region(star, [period])
    return top_by_stored_rank(rows, "region_rank", n).select("region", "legal_name", "active_members", "region_rank")


def chart_facility_states(star: Star, period: int, n: int = 15) -> DataFrame:
    rows = _of_period(marts.facilities_by_locality(star), period)
    states = rows.groupBy("state", "state_name").agg(F.sum("facilities").alias("facilities"))
    return top_n(states, n, F.desc("facilities"), "state")


def chart_status_timeline(star: Star, n: int = 200) -> DataFrame:
    rows = recent_runs(star, n).select("run_id", "started_at", "stage", "status")
    return rows.orderBy("started_at", "run_id")


def chart_approval(star: Star, n: int = 200) -> DataFrame:
    rows = recent_runs(star, n).select("run_id", "started_at", "approval_percent").dropna(subset=["approval_percent"])
    return rows.orderBy("started_at", "run_id")


# Exploration ---------------------------------------------------------------


def explore(
    mart: str,
    star: Star,
    filters: Mapping[str, Sequence[str]] | None = None,
    columns: Sequence[str] | None = None,
    order: str | Column | None = None,
    ascending: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """A listed mart, filtered, projected and sorted, all of its rows."""
    if mart not in marts.MARTS:
        raise KeyError(f"unknown mart {mart!r}; choose one of {sorted(marts.MARTS)}")
    rows = marts.MARTS[mart](star)
    for column, values in (filters or {}).items():
        rows = require_columns(rows, [column]).where(F.col(column).isin(*values))
    if order is not None:
        key = F.col(order) if isinstance(order, str) else order
        rows = rows.orderBy(key.asc() if ascending else key.desc(), *tie_break)
    return rows.select(*require_columns(rows, columns).select(*columns).columns) if columns else rows


def explore_capped(cap: int, *args: object, **options: object) -> tuple[DataFrame, bool]:
    """``explore`` cut to the first ``cap`` rows, and whether there were more."""
    return capped(explore(*args, **options), cap)


def filter_choice_rows(df: DataFrame, most: int = 200) -> DataFrame:
    """(column, value): the values of the text columns that have 2 to ``most`` of them; no more leave a column."""
    names = profile.text_columns(df)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in names]
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, value string")
    values = materialise(df.select(F.inline(F.array(*entries))).where("value is not null").distinct(), "choices")
    offered = values.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(2, most))
    return values.join(F.broadcast(offered.select("column")), "column")  # one row per column


def filter_choices(df: DataFrame, most: int = 200) -> dict[str, list[str]]:
    """The same as sorted lists, in the order of the columns."""
    found: dict[str, list[str]] = {}
    for row in filter_choice_rows(df, most).collect():
        found.setdefault(row["column"], []).append(row["value"])
    return {c: sorted(found[c]) for c in df.columns if c in found}
