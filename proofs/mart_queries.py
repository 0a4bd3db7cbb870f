"""The marts and the business questions."""

from __future__ import annotations

from coverlens.plans import marts, questions
from proofs import sql
from proofs.registry import proof
from proofs.roles import ATTENTION, CRITICAL, PERIOD, star

PLACE = "locality_code, locality_name, state, state_name, region"
DATE = sql.period_date()

TREND = f"""{sql.ENROL}, t AS (
  SELECT period_key, CAST(sum(active) AS BIGINT) AS active_members FROM enrol GROUP BY 1),
trend AS (SELECT *, lag(active_members) OVER (ORDER BY period_key) AS previous_members FROM t)"""

STATES = f"""{sql.ENROL}, {sql.PLACES}, states AS (
  SELECT period_key, state, state_name, region, CAST(sum(active) AS BIGINT) AS active_members
  FROM enrol JOIN places USING (locality_sk) GROUP BY ALL)"""

RATIOS = f"""{sql.ENROL}, {sql.PLACES}, {sql.NETWORK}, {sql.MEMBERS}, {sql.FACILITIES}, ratios AS (
  SELECT m.*, coalesce(f.facilities, 0) AS facilities FROM members m
  LEFT JOIN facilities f USING (period_key, locality_code, state))"""
RATIO = sql.quotient("active_members", "facilities", 6)

CLASS = f"""CASE WHEN facilities = 0 OR {RATIO} >= {CRITICAL} THEN '{marts.CRITICAL}'
  WHEN {RATIO} >= {ATTENTION} THEN '{marts.ATTENTION}' ELSE '{marts.ADEQUATE}' END"""

CARRIERS = f"""{sql.ENROL}, carriers AS (
  SELECT period_key, CAST(carrier_sk AS VARCHAR) AS carrier_code, s_name AS legal_name,
    CAST(s_nationkey AS VARCHAR) AS kind, CAST(sum(active) AS BIGINT) AS active_members
  FROM enrol JOIN supplier ON carrier_sk = s_suppkey GROUP BY ALL)"""

RANKED = f"""{CARRIERS}, totals AS (
  SELECT period_key, CAST(sum(active_members) AS BIGINT) AS whole FROM carriers GROUP BY 1),
ranking AS (
  SELECT carriers.*, {DATE} AS period_date, {sql.percent("active_members", "whole")} AS share_percent,
    CAST(dense_rank() OVER (PARTITION BY period_key ORDER BY active_members DESC) AS INTEGER) AS carrier_rank
  FROM carriers JOIN totals USING (period_key))"""

REGIONAL = f"""{sql.ENROL}, regional AS (
  SELECT period_key, r_name AS region, CAST(carrier_sk AS VARCHAR) AS carrier_code, s_name AS legal_name,
    CAST(sum(active) AS BIGINT) AS active_members
  FROM enrol JOIN supplier ON carrier_sk = s_suppkey JOIN nation ON locality_sk // 5 = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY period_key, region ORDER BY active_members DESC) AS INTEGER)
  AS region_rank FROM regional)"""

RUN_ROWS = f"""{sql.RUNS}, history AS (
  SELECT *, CASE WHEN received > 0 THEN {sql.percent("valid", "received")} END AS approval_percent FROM runs)"""


@proof(
    "monthly_trend",
    f"""WITH {TREND} SELECT period_key, {DATE} AS period_date, {sql.period_label()} AS period_label, active_members,
  previous_members, active_members - previous_members AS change,
  {sql.change_percent("active_members", "previous_members")} AS change_percent FROM trend""",
)
def monthly_trend(spark, sf_dir):
    return marts.monthly_trend(star(spark, sf_dir, "enrolment"))


@proof(
    "by_state",
    f"""WITH {STATES} SELECT *, {DATE} AS period_date,
  CAST(rank() OVER (PARTITION BY period_key ORDER BY active_members DESC) AS INTEGER) AS state_rank FROM states""",
)
def by_state(spark, sf_dir):
    return marts.by_state(star(spark, sf_dir, "enrolment", "locality"))


@proof("by_locality", f"WITH {sql.ENROL}, {sql.PLACES}, {sql.MEMBERS} SELECT *, {DATE} AS period_date FROM members")
def by_locality(spark, sf_dir):
    return marts.by_locality(star(spark, sf_dir, "enrolment", "locality"))


@proof(
    "facilities_by_locality",
    f"WITH {sql.PLACES}, {sql.NETWORK}, {sql.FACILITIES} SELECT *, {DATE} AS period_date FROM facilities",
)
def facilities_by_locality(spark, sf_dir):
    return marts.facilities_by_locality(star(spark, sf_dir, "network", "locality"))


@proof(
    "facilities_by_type",
    f"""WITH {sql.NETWORK} SELECT period_key, {DATE} AS period_date, p_type AS type_code, 'Tipo ' || p_type AS type_label,
  count(*) AS facilities FROM network GROUP BY ALL""",
)
def facilities_by_type(spark, sf_dir):
    return marts.facilities_by_type(star(spark, sf_dir, "network", "facility_type"))


@proof(
    "members_per_facility",
    f"WITH {RATIOS} SELECT *, {DATE} AS period_date, {RATIO} AS members_per_facility FROM ratios",
)
def members_per_facility(spark, sf_dir):
    return marts.members_per_facility(star(spark, sf_dir, "enrolment", "network", "locality"))


@proof("carrier_ranking", f"WITH {RANKED} SELECT * FROM ranking")
def carrier_ranking(spark, sf_dir):
    return marts.carrier_ranking(star(spark, sf_dir, "enrolment", "carrier"))


@proof(
    "coverage_class",
    f"WITH {RATIOS} SELECT *, {DATE} AS period_date, {RATIO} AS members_per_facility, {CLASS} AS coverage FROM ratios",
)
def coverage_class(spark, sf_dir):
    return marts.coverage_class(star(spark, sf_dir, "enrolment", "network", "locality"), ATTENTION, CRITICAL)


@proof(
    "state_growth",
    f"""WITH {STATES}, g AS (
  SELECT *, lag(active_members) OVER (PARTITION BY state ORDER BY period_key) AS previous_members FROM states)
SELECT *, {DATE} AS period_date, {sql.change_percent("active_members", "previous_members")} AS change_percent FROM g""",
)
def state_growth(spark, sf_dir):
    return marts.state_growth(star(spark, sf_dir, "enrolment", "locality"))


@proof(
    "run_history",
    f"""WITH {RUN_ROWS} SELECT * REPLACE (strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at) FROM history""",
)
def run_history(spark, sf_dir):
    return marts.run_history(star(spark, sf_dir, "runs"))


@proof(
    "rule_history",
    f"""WITH {sql.RUNS}, {sql.RULES} SELECT r.run_id, period, source, r.stage, rule, description, severity, evaluated,
  accepted, violated, strftime(evaluated_at, '%Y-%m-%d %H:%M:%S') AS evaluated_at
FROM results r JOIN runs USING (run_id)""",
)
def rule_history(spark, sf_dir):
    return marts.rule_history(star(spark, sf_dir, "runs", "rules"))


@proof("carriers_by_region", f"WITH {REGIONAL} SELECT *, {DATE} AS period_date FROM ranked")
def carriers_by_region(spark, sf_dir):
    return marts.carriers_by_region(star(spark, sf_dir, "enrolment", "carrier", "locality"))


def _summary_sql(over: str) -> str:
    return f"""WITH {sql.ENROL}, {sql.NETWORK}, {sql.PLACES}, n AS (
  SELECT locality_sk, region AS r_name FROM places),
m AS (SELECT period_key, r_name, sum(active) AS active FROM enrol JOIN n USING (locality_sk) GROUP BY ALL),
l AS (SELECT period_key, r_name, locality_sk, count(*) AS k FROM network JOIN n USING (locality_sk) GROUP BY ALL),
f AS (SELECT period_key, r_name, {over}(k) AS k FROM l GROUP BY ALL),
s AS (SELECT coalesce(m.period_key, f.period_key) AS period_key, coalesce(m.r_name, f.r_name) AS state,
        CAST(coalesce(active, 0) AS BIGINT) AS active_members, CAST(coalesce(k, 0) AS BIGINT) AS facilities
      FROM m FULL JOIN f ON m.period_key = f.period_key AND m.r_name = f.r_name)
SELECT *, state AS state_name, state AS region, {sql.quotient("active_members", "facilities", 2)}
  AS members_per_facility FROM s WHERE active_members > 0 OR facilities > 0"""


@proof("state_summary", _summary_sql("sum"))
def state_summary(spark, sf_dir):
    return marts.state_summary(star(spark, sf_dir, "enrolment", "network", "locality", state_is_region=True))


@proof("state_summary_max", _summary_sql("max"))
def state_summary_max(spark, sf_dir):
    """The variant that takes the largest locality's facilities for the state."""
    parts = star(spark, sf_dir, "enrolment", "network", "locality", state_is_region=True)
    return marts.state_summary(parts, facility_agg="max")


# Business questions --------------------------------------------------------


@proof(
    "evolution",
    f"""WITH {TREND} SELECT period_key, {sql.period_label()} AS period_label, active_members,
  active_members - previous_members AS change, {sql.change_percent("active_members", "previous_members")}
  AS change_percent FROM trend""",
)
def evolution(spark, sf_dir):
    return questions.evolution(star(spark, sf_dir, "enrolment"))


@proof(
    "leading_states",
    f"""WITH {STATES}, r AS (
  SELECT *, CAST(rank() OVER (ORDER BY active_members DESC) AS INTEGER) AS state_rank FROM states
  WHERE period_key = {PERIOD})
SELECT state_name, region, active_members, state_rank FROM r ORDER BY state_rank, state LIMIT 10""",
)
def leading_states(spark, sf_dir):
    return questions.leading_states(star(spark, sf_dir, "enrolment", "locality"), PERIOD)


@proof(
    "thinnest_localities",
    f"""WITH {RATIOS} SELECT locality_name, state_name, active_members, facilities, {RATIO} AS members_per_facility
FROM ratios WHERE period_key = {PERIOD} AND facilities > 0
ORDER BY CAST(active_members AS DOUBLE) / facilities DESC, state, locality_code LIMIT 20""",
)
def thinnest_localities(spark, sf_dir):
    return questions.thinnest_localities(star(spark, sf_dir, "enrolment", "network", "locality"), PERIOD)


@proof(
    "national_ratio",
    f"""WITH {RATIOS}, s AS (SELECT CAST(sum(active_members) AS BIGINT) AS members,
  CAST(sum(facilities) AS BIGINT) AS facilities FROM ratios WHERE period_key = {PERIOD})
SELECT *, {sql.quotient("members", "facilities", 6)} AS ratio FROM s""",
)
def national_ratio(spark, sf_dir):
    return questions.national_ratio(star(spark, sf_dir, "enrolment", "network", "locality"), PERIOD)


CHANGES = f"""{CARRIERS}, changes AS (
  SELECT period_key, carrier_code, legal_name, active_members,
    lag(active_members) OVER (PARTITION BY carrier_code ORDER BY period_key) AS previous_members FROM carriers),
moved AS (SELECT *, active_members - previous_members AS change FROM changes WHERE previous_members IS NOT NULL)"""


@proof("fastest_growing", f"WITH {CHANGES} SELECT * FROM moved ORDER BY change DESC, period_key, carrier_code LIMIT 10")
def fastest_growing(spark, sf_dir):
    return questions.fastest_growing(star(spark, sf_dir, "enrolment", "carrier"))


@proof("largest_losses", f"WITH {CHANGES} SELECT * FROM moved ORDER BY change, period_key, carrier_code LIMIT 10")
def largest_losses(spark, sf_dir):
    return questions.largest_losses(star(spark, sf_dir, "enrolment", "carrier"))


@proof(
    "critical_share",
    f"""WITH {RATIOS}, c AS (SELECT region, {CLASS} AS coverage FROM ratios WHERE period_key = {PERIOD}),
s AS (SELECT region, count(*) AS localities, count(*) FILTER (coverage = '{marts.CRITICAL}') AS critical_localities
      FROM c GROUP BY 1)
SELECT *, {sql.percent("critical_localities", "localities")} AS critical_percent FROM s""",
)
def critical_share(spark, sf_dir):
    parts = star(spark, sf_dir, "enrolment", "network", "locality")
    return questions.critical_share(parts, PERIOD, ATTENTION, CRITICAL)


@proof(
    "national_change",
    f"""WITH {TREND} SELECT {sql.period_label()} AS period_label, active_members, previous_members,
  {sql.change_percent("active_members", "previous_members")} AS change_percent FROM trend
WHERE period_key = {PERIOD}""",
)
def national_change(spark, sf_dir):
    return questions.national_change(star(spark, sf_dir, "enrolment"), PERIOD)


@proof(
    "common_types",
    f"""WITH {sql.NETWORK} SELECT 'Tipo ' || p_type AS type_label, count(*) AS facilities,
  CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS type_rank FROM network
WHERE period_key = {PERIOD} GROUP BY p_type""",
)
def common_types(spark, sf_dir):
    return questions.common_types(star(spark, sf_dir, "network", "facility_type"), PERIOD)


RULE_SUMS = f"""{sql.RUNS}, {sql.RULES}, sums AS (
  SELECT rule, description, severity, CAST(sum(violated) AS BIGINT) AS violated,
    CAST(sum(evaluated) AS BIGINT) AS evaluated FROM results GROUP BY ALL)"""


@proof(
    "rejects_by_rule",
    f"WITH {RULE_SUMS} SELECT *, {sql.percent('violated', 'evaluated')} AS violated_percent FROM sums",
)
def rejects_by_rule(spark, sf_dir):
    return questions.rejects_by_rule(star(spark, sf_dir, "runs", "rules"))


@proof(
    "stage_durations",
    f"""WITH {sql.RUNS} SELECT stage, count(*) AS runs, avg(CAST(duration_seconds AS DOUBLE)) AS mean_seconds,
  max(duration_seconds) AS longest_seconds FROM runs WHERE finished_at IS NOT NULL GROUP BY 1""",
)
def stage_durations(spark, sf_dir):
    return questions.stage_durations(star(spark, sf_dir, "runs"))


@proof(
    "failure_rates",
    f"""WITH {sql.RUNS}, s AS (SELECT source, count(*) AS runs, count(*) FILTER (status = 'FAILED') AS failed_runs
  FROM runs GROUP BY 1) SELECT *, {sql.percent("failed_runs", "runs")} AS failed_percent FROM s""",
)
def failure_rates(spark, sf_dir):
    return questions.failure_rates(star(spark, sf_dir, "runs"))
