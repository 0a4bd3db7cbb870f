"""The analytic marts.

All marts add up the fact by its surrogate keys *before* they join a dimension:
the fact is combined inside each task, a hot key costs nothing, and the joins and
windows above see dimension-sized rows.  Period attributes follow from the period
key, so the time dimension is not joined.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.functions.numbers import guarded_ratio, percent_change, percent_of
from coverlens.functions.periods import period_date, period_label
from coverlens.operators.lookups import left_measures
from coverlens.operators.ranking import rank_spread, rank_within, with_previous
from coverlens.plans.star import Star
from coverlens.session import materialise

# Coverage classes.
CRITICAL = "Cobertura crítica"
ATTENTION = "Atenção"
ADEQUATE = "Cobertura adequada"
CLASSES = (ADEQUATE, ATTENTION, CRITICAL)

PLACE = ("locality_code", "locality_name", "state", "state_name", "region")


def _members(star: Star, *keys: str, periods: list[int] | None = None) -> DataFrame:
    rows = star.enrolment if periods is None else star.enrolment.where(F.col("period_key").isin(*periods))
    return rows.groupBy("period_key", *keys).agg(F.sum("active").alias("active_members"))


def _facilities(star: Star, *keys: str) -> DataFrame:
    return star.network.groupBy("period_key", *keys).agg(F.sum("facilities").alias("facilities"))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("period_date", period_date("period_key"))


def change_of_period(star: Star, period: int) -> DataFrame:
    """``monthly_trend`` of one period: only its rows and those of the period loaded before it are read."""
    before = star.enrolment.where(F.col("period_key") < period).agg(F.max("period_key")).first()[0]
    trend = monthly_trend(star, [period] if before is None else [before, period])
    return trend.where(F.col("period_key") == period)


def monthly_trend(star: Star, periods: list[int] | None = None) -> DataFrame:
    """Active members per period, change against the period loaded before."""
    months = with_previous(_members(star, periods=periods), "active_members", "period_key", name="previous_members")
    return _dated(months).withColumns(
        {
            "period_label": period_label("period_key"),
            "change": F.col("active_members") - F.col("previous_members"),
            "change_percent": percent_change("active_members", "previous_members"),
        }
    )


def by_state(star: Star) -> DataFrame:
    """Active members per period and state, ranked inside the period."""
    joined = _members(star, "locality_sk").join(star.locality, "locality_sk")
    states = joined.groupBy("period_key", "state", "state_name", "region").agg(
        F.sum("active_members").alias("active_members")
    )
    return _dated(rank_within(states, ["period_key"], "active_members", "state_rank"))


def by_locality(star: Star) -> DataFrame:
    joined = _members(star, "locality_sk").join(star.locality, "locality_sk")
    return _dated(joined.groupBy("period_key", *PLACE).agg(F.sum("active_members").alias("active_members")))


def facilities_by_locality(star: Star) -> DataFrame:
    joined = _facilities(star, "locality_sk").join(star.locality, "locality_sk")
    return _dated(joined.groupBy("period_key", *PLACE).agg(F.sum("facilities").alias("facilities")))


def facilities_by_type(star: Star) -> DataFrame:
    joined = _facilities(star, "facility_type_sk").join(star.facility_type, "facility_type_sk")
    return _dated(
        joined.groupBy("period_key", "type_code", "type_label").agg(F.sum("facilities").alias("facilities"))
    )


def members_per_facility(star: Star) -> DataFrame:
    """Ratio per locality; a locality without facilities stays, with 0 and no ratio."""
    both = left_measures(
        by_locality(star), facilities_by_locality(star), ("period_key", "locality_code", "state"), ["facilities"]
    )
    return both.withColumn("members_per_facility", guarded_ratio("active_members", "facilities"))


def coverage_class(star: Star, attention: int = 2000, critical: int = 5000) -> DataFrame:
    """Exploratory class by members per facility; none at all is critical."""
    ratio = F.col("members_per_facility")
    label = (
        F.when(F.col("facilities") == 0, CRITICAL)
        .when(ratio >= critical, CRITICAL)
        .when(ratio >= attention, ATTENTION)
        .otherwise(ADEQUATE)
    )
    return members_per_facility(star).withColumn("coverage", label)


def carrier_ranking(star: Star, periods: list[int] | None = None) -> DataFrame:
    """Carriers per period by members, dense rank and share of the period's total.

    A period may hold every registered carrier, so the rank is the spread one.
    """
    joined = _members(star, "carrier_sk", periods=periods).join(star.carrier, "carrier_sk")
    carriers = joined.groupBy("period_key", "carrier_code", "legal_name", "kind").agg(
        F.sum("active_members").alias("active_members")
    )
    ranked = rank_spread(
        carriers, ["period_key"], "active_members", dense_rank="carrier_rank", group_total="_period_members"
    )
    return _dated(ranked.withColumn("share_percent", percent_of("active_members", "_period_members"))).drop(
        "_period_members"
    )


def state_growth(star: Star) -> DataFrame:
    """Change per state against the period loaded before."""
    states = by_state(star).drop("state_rank")
    grown = with_previous(states, "active_members", "period_key", ["state"], "previous_members")
    return grown.withColumn("change_percent", percent_change("active_members", "previous_members"))


def run_history(star: Star) -> DataFrame:
    """Stage runs with duration and the percentage of rows approved."""
    return star.runs.withColumn(
        "approval_percent", F.when(F.col("received") > 0, percent_of("valid", "received"))
    )


def rule_history(star: Star) -> DataFrame:
    """Rule results with the period and source of their run."""
    runs = star.runs.select("run_id", "period", "source")
    return star.rules.join(runs, "run_id").select(
        "run_id", "period", "source", "stage", "rule", "description", "severity",
        "evaluated", "accepted", "violated", "evaluated_at",
    )


def carriers_by_region(star: Star, periods: list[int] | None = None) -> DataFrame:
    """Carriers per period and region, ranked inside the region."""
    joined = _members(star, "carrier_sk", "locality_sk", periods=periods).join(star.locality.select("locality_sk", "region"), "locality_sk")
    regional = joined.groupBy("period_key", "region", "carrier_sk").agg(F.sum("active_members").alias("active_members"))
    named = regional.join(star.carrier.select("carrier_sk", "carrier_code", "legal_name"), "carrier_sk")
    carriers = named.groupBy("period_key", "region", "carrier_code", "legal_name").agg(
        F.sum("active_members").alias("active_members")
    )
    return _dated(rank_spread(carriers, ["period_key", "region"], "active_members", rank="region_rank"))


def state_summary(star: Star, facility_agg: str = "sum", periods: list[int] | None = None) -> DataFrame:
    """Members, facilities and ratio per period and state, without the unknown locality.

    Both facts are added up first and only then joined.  ``facility_agg="max"``
    takes the largest locality's facilities instead of the state's total.
    """
    places = star.locality.where("locality_sk <> -1").select("locality_sk", "state", "state_name", "region")
    enrolled, network = star.enrolment, star.network
    if periods is not None:
        enrolled = enrolled.where(F.col("period_key").isin(*periods))
        network = network.where(F.col("period_key").isin(*periods))
    members = enrolled.groupBy("period_key", "locality_sk").agg(F.sum("active").alias("active_members"))
    facilities = network.groupBy("period_key", "locality_sk").agg(F.sum("facilities").alias("facilities"))
    # Two thin aggregates stacked and added up again, in place of an outer join.
    stacked = members.unionByName(facilities, allowMissingColumns=True)
    local = stacked.groupBy("period_key", "locality_sk").agg(
        F.sum("active_members").alias("active_members"), F.sum("facilities").alias("facilities")
    )
    over_state = F.max("facilities") if facility_agg == "max" else F.sum("facilities")
    states = (
        local.join(places, "locality_sk")
        .groupBy("period_key", "state")
        .agg(
            F.max("state_name").alias("state_name"),
            F.max("region").alias("region"),
            F.coalesce(F.sum("active_members"), F.lit(0)).alias("active_members"),
            F.coalesce(over_state, F.lit(0)).alias("facilities"),
        )
        .where("active_members > 0 or facilities > 0")
    )
    return states.withColumn(
        "members_per_facility", guarded_ratio("active_members", "facilities", result_type="decimal(20,2)")
    )


MARTS = {
    "monthly_trend": monthly_trend,
    "by_state": by_state,
    "by_locality": by_locality,
    "facilities_by_locality": facilities_by_locality,
    "facilities_by_type": facilities_by_type,
    "members_per_facility": members_per_facility,
    "carrier_ranking": carrier_ranking,
    "coverage_class": coverage_class,
    "state_growth": state_growth,
    "run_history": run_history,
    "rule_history": rule_history,
    "carriers_by_region": carriers_by_region,
}

EXPORTED = (
    "monthly_trend",
    "by_state",
    "by_locality",
    "facilities_by_type",
    "members_per_facility",
    "carrier_ranking",
    "coverage_class",
    "run_history",
)


def exported_stars(star: Star) -> dict[str, Star]:
    """The star for each exported mart; facts are read once, added up at the grains the marts need, written and shared.

    A row of the sums belongs to one grouping set: marts by locality, the trend among them, read one, the others the other.
    """

    def sums(fact: DataFrame, key: str, measure: str) -> tuple[DataFrame, DataFrame]:
        sets = [["period_key", "locality_sk"], ["period_key", key]]
        both = fact.groupingSets(sets, "period_key", "locality_sk", key).agg(F.sum(measure).alias(measure), F.grouping_id().alias("_left_out"))
        written = materialise(both, "mart-sums")
        return (
            written.where("_left_out = 1").select("period_key", "locality_sk", measure),
            written.where("_left_out = 2").select("period_key", key, measure),
        )

    members, by_carrier = sums(star.enrolment, "carrier_sk", "active")
    facilities, by_type = sums(star.network, "facility_type_sk", "facilities")
    local = replace(star, enrolment=members, network=facilities)
    other = replace(star, enrolment=by_carrier, network=by_type)
    return {name: other if name in ("carrier_ranking", "facilities_by_type") else local for name in EXPORTED}


def register_views(star: Star, names: tuple[str, ...] | None = None) -> list[str]:
    """Make the marts available to SQL as temporary views; names of the views."""
    made = []
    for name in names or tuple(MARTS):
        needs_runs = name in ("run_history", "rule_history")
        if needs_runs and (star.runs is None or (name == "rule_history" and star.rules is None)):
            continue
        MARTS[name](star).createOrReplaceTempView(name)
        made.append(name)
    return made
