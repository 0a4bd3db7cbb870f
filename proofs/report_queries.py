"""The read API, indicators, chart-ready frames, exploration and profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.operators import profile
from coverlens.plans import marts, reports
from coverlens.plans.audit import fold_runs
from coverlens.session import materialise
from proofs import roles, sql
from proofs.mart_queries import (
    CARRIERS,
    CLASS,
    DATE,
    RANKED,
    RATIO,
    RATIOS,
    REGIONAL,
    RULE_SUMS,
    RUN_ROWS,
    STATES,
)
from proofs.registry import proof
from proofs.roles import ATTENTION, CRITICAL, PERIOD, star, table

STATE = "NATION_3"
RANKED_STATES = f"""{STATES}, r AS (SELECT *, {DATE} AS period_date,
  CAST(rank() OVER (PARTITION BY period_key ORDER BY active_members DESC) AS INTEGER) AS state_rank FROM states)"""


@proof("states_of_period", f"WITH {RANKED_STATES} SELECT * FROM r WHERE period_key = {PERIOD}")
def states_of_period(spark, sf_dir):
    return reports.states_of_period(star(spark, sf_dir, "enrolment", "locality"), PERIOD)


@proof(
    "localities_of_state",
    f"""WITH {sql.ENROL}, {sql.PLACES}, {sql.MEMBERS} SELECT *, {DATE} AS period_date FROM members
WHERE period_key = {PERIOD} AND state = '{STATE}'""",
)
def localities_of_state(spark, sf_dir):
    return reports.localities_of_period(star(spark, sf_dir, "enrolment", "locality"), PERIOD, STATE)


@proof("carriers_of_period", f"WITH {RANKED} SELECT * FROM ranking WHERE period_key = {PERIOD}")
def carriers_of_period(spark, sf_dir):
    return reports.carriers_of_period(star(spark, sf_dir, "enrolment", "carrier"), PERIOD)


@proof(
    "available_periods",
    f"""SELECT DISTINCT {sql.PERIOD} AS period_key, {sql.period_label(f"({sql.PERIOD})")} AS period_label
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def available_periods(spark, sf_dir):
    return reports.available_periods(star(spark, sf_dir, "enrolment"))


@proof(
    "available_states",
    f"WITH {sql.ENROL}, {sql.PLACES} SELECT DISTINCT state, state_name FROM enrol JOIN places USING (locality_sk)",
)
def available_states(spark, sf_dir):
    return reports.available_states(star(spark, sf_dir, "enrolment", "locality"))


@proof(
    "facility_localities",
    f"""WITH {sql.PLACES}, {sql.NETWORK}, {sql.FACILITIES} SELECT *, {DATE} AS period_date FROM facilities
WHERE period_key = {PERIOD}""",
)
def facility_localities(spark, sf_dir):
    return reports.facility_localities(star(spark, sf_dir, "network", "locality"), PERIOD)


@proof(
    "facility_types",
    f"""WITH {sql.NETWORK} SELECT period_key, {DATE} AS period_date, p_type AS type_code, 'Tipo ' || p_type AS type_label,
  count(*) AS facilities FROM network WHERE period_key = {PERIOD} GROUP BY ALL""",
)
def facility_types(spark, sf_dir):
    return reports.facility_types(star(spark, sf_dir, "network", "facility_type"), PERIOD)


@proof(
    "ratios_of_period",
    f"""WITH {RATIOS} SELECT *, {DATE} AS period_date, {RATIO} AS members_per_facility FROM ratios
WHERE period_key = {PERIOD}""",
)
def ratios_of_period(spark, sf_dir):
    return reports.ratios(star(spark, sf_dir, "enrolment", "network", "locality"), PERIOD)


@proof(
    "coverage_of_state",
    f"""WITH {RATIOS} SELECT *, {DATE} AS period_date, {RATIO} AS members_per_facility, {CLASS} AS coverage FROM ratios
WHERE period_key = {PERIOD} AND state = '{STATE}'""",
)
def coverage_of_state(spark, sf_dir):
    parts = star(spark, sf_dir, "enrolment", "network", "locality")
    return reports.coverage(parts, PERIOD, STATE, attention=ATTENTION, critical=CRITICAL)


@proof(
    "carrier_series",
    f"""WITH {CARRIERS} SELECT period_key, {DATE} AS period_date, active_members FROM carriers
WHERE carrier_code = '7'""",
)
def carrier_series(spark, sf_dir):
    return reports.carrier_series(star(spark, sf_dir, "enrolment", "carrier"), "7")


@proof("regional_carriers", f"WITH {REGIONAL} SELECT *, {DATE} AS period_date FROM ranked WHERE period_key = {PERIOD}")
def regional_carriers(spark, sf_dir):
    return reports.regional_carriers(star(spark, sf_dir, "enrolment", "carrier", "locality"), PERIOD)


TIMES = """REPLACE (strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at)"""


@proof(
    "recent_runs",
    f"WITH {RUN_ROWS} SELECT * {TIMES} FROM (SELECT * FROM history ORDER BY started_at DESC, run_id DESC LIMIT 200)",
)
def recent_runs(spark, sf_dir):
    return reports.recent_runs(star(spark, sf_dir, "runs"))


@proof("most_violated", f"WITH {RULE_SUMS} SELECT * FROM sums ORDER BY violated DESC, rule, severity LIMIT 10")
def most_violated(spark, sf_dir):
    return reports.most_violated(star(spark, sf_dir, "runs", "rules"))


TOTALS = """CAST(sum(received) AS BIGINT) AS received, CAST(sum(valid) AS BIGINT) AS valid,
  CAST(sum(rejected) AS BIGINT) AS rejected, strftime(max(finished_at), '%Y-%m-%d %H:%M:%S') AS last_update"""


@proof("quality_totals", f"WITH {sql.RUNS} SELECT {TOTALS} FROM runs WHERE stage = 'purchase'")
def quality_totals(spark, sf_dir):
    return reports.quality_totals(star(spark, sf_dir, "runs"), "purchase")


@proof(
    "quality_totals_latest",
    f"""WITH {sql.RUNS} SELECT {TOTALS} FROM (SELECT * FROM runs WHERE stage = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY period, source ORDER BY run_id DESC) = 1)""",
)
def quality_totals_latest(spark, sf_dir):
    """Reruns of one period and source counted once."""
    return reports.quality_totals(star(spark, sf_dir, "runs"), "purchase", latest_run_only=True)


@proof(
    "last_load",
    f"""WITH {RUN_ROWS} SELECT * {TIMES} FROM (SELECT * FROM history WHERE stage = 'click'
  ORDER BY started_at DESC, run_id DESC LIMIT 1)""",
)
def last_load(spark, sf_dir):
    return reports.last_load(star(spark, sf_dir, "runs"), "click")


@proof(
    "kpi_row",
    f"""WITH {RATIOS}, trend AS (
  SELECT period_key, sum(active) AS a, lag(sum(active)) OVER (ORDER BY period_key) AS p FROM enrol GROUP BY 1),
{sql.RUNS}, l AS (SELECT * FROM runs WHERE stage = 'click' ORDER BY started_at DESC, run_id DESC LIMIT 1),
h AS (SELECT (SELECT CAST(sum(active) AS BIGINT) FROM enrol WHERE period_key = {PERIOD}) AS members,
  (SELECT count(*) FROM network WHERE period_key = {PERIOD}) AS facilities,
  (SELECT count(DISTINCT region) FROM places JOIN enrol USING (locality_sk) WHERE period_key = {PERIOD}) AS states,
  (SELECT count(DISTINCT carrier_sk) FROM enrol WHERE period_key = {PERIOD}) AS carriers)
SELECT h.*, (SELECT {sql.change_percent("a", "p")} FROM trend WHERE period_key = {PERIOD}) AS change_percent,
  (SELECT strftime(finished_at, '%Y-%m-%d %H:%M:%S') FROM l) AS last_update, (SELECT status FROM l) AS last_status,
  round(CAST(members AS DOUBLE) / facilities, 2) AS members_per_facility FROM h""",
)
def kpi_row(spark, sf_dir):
    parts = star(
        spark, sf_dir, "enrolment", "network", "locality", "carrier", "runs", state_is_region=True
    )
    return reports.kpi_row(parts, PERIOD, load_stage="click")


@proof(
    "approval_percent",
    f"""WITH {sql.RUNS}, t AS (SELECT {TOTALS} FROM runs WHERE stage = 'purchase')
SELECT *, {sql.percent("valid", "received")} AS approval_percent FROM t""",
)
def approval_percent(spark, sf_dir):
    return reports.approval_percent(star(spark, sf_dir, "runs"), "purchase")


@proof(
    "zero_facility",
    f"""WITH {RATIOS} SELECT count(*) AS localities_without_facility FROM ratios
WHERE period_key = {PERIOD} AND facilities = 0 AND active_members > 0""",
)
def zero_facility(spark, sf_dir):
    return reports.without_facility(star(spark, sf_dir, "enrolment", "network", "locality"), PERIOD)


@proof(
    "leading_share",
    f"""WITH {RANKED} SELECT round(sum(share_percent), 2) AS leading_share FROM (
  SELECT share_percent FROM ranking WHERE period_key = {PERIOD} ORDER BY carrier_rank, carrier_code LIMIT 5)""",
)
def leading_share(spark, sf_dir):
    return reports.leading_share(star(spark, sf_dir, "enrolment", "carrier"), PERIOD)


@proof(
    "chart_states",
    f"""WITH {RANKED_STATES} SELECT state_name, active_members, state_rank FROM r WHERE period_key = {PERIOD}
ORDER BY state_rank, state LIMIT 15""",
)
def chart_states(spark, sf_dir):
    return reports.chart_states(star(spark, sf_dir, "enrolment", "locality"), PERIOD)


@proof(
    "chart_localities",
    f"""WITH {sql.ENROL}, {sql.PLACES}, {sql.MEMBERS} SELECT locality_name || ' / ' || state AS label, active_members
FROM members WHERE period_key = {PERIOD} ORDER BY active_members DESC, locality_code LIMIT 20""",
)
def chart_localities(spark, sf_dir):
    return reports.chart_localities(star(spark, sf_dir, "enrolment", "locality"), PERIOD)


@proof(
    "chart_carriers",
    f"""WITH {RANKED} SELECT legal_name, active_members, carrier_rank FROM ranking WHERE period_key = {PERIOD}
ORDER BY carrier_rank, carrier_code LIMIT 15""",
)
def chart_carriers(spark, sf_dir):
    return reports.chart_carriers(star(spark, sf_dir, "enrolment", "carrier"), PERIOD)


@proof(
    "chart_risk",
    f"""WITH {RATIOS} SELECT locality_name || ' / ' || state AS label, {RATIO} AS members_per_facility FROM ratios
WHERE period_key = {PERIOD} AND facilities > 0
ORDER BY CAST(active_members AS DOUBLE) / facilities DESC, locality_code LIMIT 20""",
)
def chart_risk(spark, sf_dir):
    return reports.chart_risk(star(spark, sf_dir, "enrolment", "network", "locality"), PERIOD)


@proof(
    "class_distribution",
    f"""WITH {RATIOS}, c AS (SELECT {CLASS} AS coverage FROM ratios WHERE period_key = {PERIOD}),
k AS (SELECT * FROM (VALUES (0, '{marts.ADEQUATE}'), (1, '{marts.ATTENTION}'), (2, '{marts.CRITICAL}')) t(position, coverage))
SELECT position, k.coverage, count(c.coverage) AS rows FROM k LEFT JOIN c ON c.coverage = k.coverage GROUP BY ALL""",
)
def class_distribution(spark, sf_dir):
    parts = star(spark, sf_dir, "enrolment", "network", "locality")
    return reports.chart_classes(parts, PERIOD, attention=ATTENTION, critical=CRITICAL)


@proof(
    "chart_region_leaders",
    f"""WITH {REGIONAL} SELECT region, legal_name, active_members, region_rank FROM ranked
WHERE period_key = {PERIOD} AND region_rank <= 2""",
)
def chart_region_leaders(spark, sf_dir):
    return reports.chart_region_leaders(star(spark, sf_dir, "enrolment", "carrier", "locality"), PERIOD, 2)


@proof(
    "chart_facility_states",
    f"""WITH {sql.PLACES}, {sql.NETWORK}, {sql.FACILITIES}
SELECT state, state_name, CAST(sum(facilities) AS BIGINT) AS facilities FROM facilities WHERE period_key = {PERIOD}
GROUP BY ALL ORDER BY facilities DESC, state LIMIT 15""",
)
def chart_facility_states(spark, sf_dir):
    return reports.chart_facility_states(star(spark, sf_dir, "network", "locality"), PERIOD)


LATEST = "(SELECT * FROM history ORDER BY started_at DESC, run_id DESC LIMIT 200)"


@proof(
    "chart_status_timeline",
    f"""WITH {RUN_ROWS} SELECT run_id, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, stage, status
FROM {LATEST}""",
)
def chart_status_timeline(spark, sf_dir):
    return reports.chart_status_timeline(star(spark, sf_dir, "runs"))


@proof(
    "chart_approval",
    f"""WITH {RUN_ROWS} SELECT run_id, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, approval_percent
FROM {LATEST} WHERE approval_percent IS NOT NULL""",
)
def chart_approval(spark, sf_dir):
    return reports.chart_approval(star(spark, sf_dir, "runs"))


@proof(
    "explore",
    f"""WITH {STATES}, g AS (
  SELECT *, lag(active_members) OVER (PARTITION BY state ORDER BY period_key) AS previous_members FROM states)
SELECT period_key, state_name, active_members, previous_members FROM g WHERE region IN ('ASIA', 'EUROPE')
ORDER BY active_members DESC, period_key, state LIMIT 500""",
)
def explore(spark, sf_dir):
    """A listed mart, filtered, sorted, capped and projected."""
    rows, _cut = reports.explore_capped(
        500,
        "state_growth",
        star(spark, sf_dir, "enrolment", "locality"),
        filters={"region": ["ASIA", "EUROPE"]},
        columns=["period_key", "state_name", "active_members", "previous_members"],
        order="active_members",
        tie_break=["period_key", "state"],
    )
    return rows


@proof(
    "explore_all",
    f"""WITH {STATES} SELECT period_key, state, active_members FROM states WHERE region IN ('ASIA', 'EUROPE')""",
)
def explore_all(spark, sf_dir):
    """All rows of a listed mart: nothing is cut unless a cap is named."""
    return reports.explore(
        "by_state",
        star(spark, sf_dir, "enrolment", "locality"),
        filters={"region": ["ASIA", "EUROPE"]},
        columns=["period_key", "state", "active_members"],
    )


# Profile -------------------------------------------------------------------


def _text_profile_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
  arg_min(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM lineitem JOIN part
  ON l_partkey = p_partkey WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in columns
    )


TEXTS = ("l_returnflag", "l_linestatus", "p_name", "p_brand", "p_type")


@proof("profile_texts", _text_profile_sql(TEXTS))
def profile_texts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type")
    return profile.profile_texts(lines.join(parts, "l_partkey"), TEXTS)


NUMBERS = ("l_quantity", "l_extendedprice", "l_linenumber", "l_discount")


@proof(
    "profile_numbers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  CAST(min({c}) AS DOUBLE) AS "min", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
  CAST(max({c}) AS DOUBLE) AS "max" FROM lineitem"""
        for c in NUMBERS
    ),
)
def profile_numbers(spark, sf_dir):
    result = profile.profile_numbers(table(spark, sf_dir, "lineitem"), NUMBERS)
    return result.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@proof(
    "null_counts",
    f"""WITH {RUN_ROWS} """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM history"
        for c in ("run_id", "stage", "finished_at", "duration_seconds", "approval_percent")
    ),
)
def null_counts(spark, sf_dir):
    rows = marts.run_history(star(spark, sf_dir, "runs"))
    return profile.null_counts(rows.select("run_id", "stage", "finished_at", "duration_seconds", "approval_percent"))


@proof(
    "iqr_outliers",
    f"""WITH {sql.ENROL}, g AS (
  SELECT period_key, carrier_sk, locality_sk, CAST(sum(active) AS BIGINT) AS active FROM enrol GROUP BY ALL),
f AS (SELECT quantile_cont(CAST(active AS DOUBLE), 0.25) AS a, quantile_cont(CAST(active AS DOUBLE), 0.75) AS b FROM g)
SELECT g.* FROM g, f WHERE active > b + 1.5 * (b - a)""",
)
def iqr_outliers(spark, sf_dir):
    cells = roles.enrolment(spark, sf_dir).groupBy("period_key", "carrier_sk", "locality_sk").agg(
        F.sum("active").alias("active")
    )
    # Read four times below, so written once.
    return profile.above_fence(materialise(cells, "cells"), "active")


@proof(
    "correlation",
    f"WITH {RATIOS} SELECT round(corr(active_members, facilities), 6) AS correlation FROM ratios",
)
def correlation(spark, sf_dir):
    rows = marts.members_per_facility(star(spark, sf_dir, "enrolment", "network", "locality"))
    found = profile.correlation(rows, "active_members", "facilities")
    return found.select(F.round("correlation", 6).alias("correlation"))


@proof(
    "unknown_share",
    f"""WITH {sql.ENROL} SELECT count(*) FILTER (s_acctbal < 0) AS unknown_rows, count(*) AS rows,
  CAST(coalesce(sum(active) FILTER (s_acctbal < 0), 0) AS BIGINT) AS unknown_members
FROM enrol JOIN supplier ON carrier_sk = s_suppkey""",
)
def unknown_share(spark, sf_dir):
    """Fact rows and members on the unknown carrier."""
    known = table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
    from coverlens.operators.lookups import lookup_key

    rows = lookup_key(roles.enrolment(spark, sf_dir), known, {"carrier_sk": "s_suppkey"}, "s_suppkey", alias="sk")
    unknown = F.col("sk") == -1
    return rows.agg(
        F.count_if(unknown).alias("unknown_rows"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(unknown, F.col("active"))), F.lit(0)).alias("unknown_members"),
    )


@proof(
    "distinct_counts",
    f"""WITH {sql.ENROL} SELECT count(DISTINCT carrier_sk) AS carriers, count(DISTINCT locality_sk) AS localities,
  count(DISTINCT period_key) AS periods FROM enrol""",
)
def distinct_counts(spark, sf_dir):
    """Distinct keys are formed once at the key grain, then counted per column."""
    keys = roles.enrolment(spark, sf_dir).select("carrier_sk", "locality_sk", "period_key").distinct()
    texts = keys.select(*[F.col(c).cast("string").alias(c) for c in keys.columns])
    found = profile.profile_texts(texts)
    one = [F.max(F.when(F.col("column") == c, F.col("unique"))).alias(n) for c, n in
           (("carrier_sk", "carriers"), ("locality_sk", "localities"), ("period_key", "periods"))]
    return found.agg(*one)


@proof(
    "folded_runs",
    """SELECT user_id AS run_id, count(*) FILTER (event_type <> 'error') AS starts,
  strftime(min(ts) FILTER (event_type <> 'error'), '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(max(ts) FILTER (event_type = 'error'), '%Y-%m-%d %H:%M:%S') AS finished_at,
  CAST(epoch(date_trunc('second', max(ts) FILTER (event_type = 'error'))) AS BIGINT) -
  CAST(epoch(date_trunc('second', min(ts) FILTER (event_type <> 'error'))) AS BIGINT) AS duration_seconds,
  arg_max(CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'RUNNING' END, ts) AS status,
  arg_max(event_id, ts) AS received FROM events GROUP BY 1""",
)
def folded_runs(spark, sf_dir):
    """Start and finish events folded to one row per run, newest state wins."""
    finish = F.col("event_type") == "error"
    none = F.lit(None).cast("string")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.when(finish, "finish").otherwise("start").alias("event"),
        F.col("ts").cast("timestamp").alias("event_at"),
        *[none.alias(c) for c in ("pipeline", "stage", "period", "source", "origin_file", "file_hash")],
        F.when(finish, "FAILED").otherwise("RUNNING").alias("status"),
        F.col("event_id").alias("received"),
        F.lit(None).cast("bigint").alias("valid"),
        F.lit(None).cast("bigint").alias("rejected"),
        none.alias("violated_rule"),
        none.alias("error_message"),
    )
    starts = events.groupBy("run_id").agg(F.count_if(F.col("event") == "start").alias("starts"))
    folded = fold_runs(events).join(starts, "run_id")
    return folded.select("run_id", "starts", "started_at", "finished_at", "duration_seconds", "status", "received")


