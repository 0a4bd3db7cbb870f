"""The rule engine and its rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.functions.periods import period_attributes
from coverlens.operators import quality as q
from coverlens.operators.dedupe import flag_repeats
from coverlens.plans import rulesets
from coverlens.session import scratch_path
from proofs import roles, sql
from proofs.registry import proof
from proofs.roles import table

STATE_CODES = ("EUROPE", "ASIA", "AFRICA", "AMERICA")
LIMIT = 45


def untidy_enrolment(spark, sf_dir):
    """Order lines as unchecked enrolment rows: negative counts, odd codes, unknown states and carriers."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    home = roles.places(spark, sf_dir).select("locality_sk", "region")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(home, F.col("c_nationkey") * roles.DISTRICTS == F.col("locality_sk"))
    )
    quantity = F.col("l_quantity").cast("bigint")
    return joined.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_suppkey").cast("string").alias("carrier_code"),
        F.when(F.col("c_nationkey") != 7, (F.col("c_nationkey") * 11111).cast("string")).alias("locality_code"),
        F.when(F.col("c_nationkey") == 3, F.col("c_mktsegment")).otherwise("one name").alias("locality_name"),
        F.when(F.col("region") == "MIDDLE EAST", "XX").otherwise(F.col("region")).alias("state"),
        F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("active"),
        F.lit(0).cast("bigint").alias("joined"),
        F.col("l_linenumber").cast("bigint").alias("cancelled"),
        F.when(F.col("o_orderstatus") != "P", F.lit(199801)).alias("period_key"),
    )


UNTIDY = """untidy AS (
  SELECT l_orderkey, l_partkey, CAST(l_suppkey AS VARCHAR) AS carrier_code,
    CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey * 11111 AS VARCHAR) END AS locality_code,
    CASE WHEN c_nationkey = 3 THEN c_mktsegment ELSE 'one name' END AS locality_name,
    CASE WHEN r_name = 'MIDDLE EAST' THEN 'XX' ELSE r_name END AS state,
    CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS active,
    CAST(l_linenumber AS BIGINT) AS cancelled,
    CASE WHEN o_orderstatus <> 'P' THEN 199801 END AS period_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
checked AS (
  SELECT *, active < 0 AS negative_count, active > 45 AS implausible_count,
    state NOT IN ('EUROPE', 'ASIA', 'AFRICA', 'AMERICA') AS invalid_state,
    coalesce(locality_code, '') = '' AS locality_missing,
    NOT coalesce(regexp_full_match(locality_code, '[0-9]{6,7}'), false) AND state <> 'XX' AS locality_format,
    period_key IS NULL AS period_missing,
    carrier_code NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal >= 0) AS carrier_unknown,
    state <> 'XX' AND coalesce(locality_code IN (
      SELECT locality_code FROM untidy WHERE state <> 'XX' AND locality_code IS NOT NULL
      GROUP BY 1 HAVING min(locality_name) <> max(locality_name)), false) AS locality_names
  FROM untidy),
decided AS (
  SELECT *, CASE WHEN negative_count THEN 'negative_count' WHEN implausible_count THEN 'implausible_count'
    WHEN invalid_state THEN 'invalid_state' WHEN locality_missing THEN 'locality_missing'
    WHEN period_missing THEN 'period_missing' END AS first_error FROM checked)"""

RULE_ROWS = (
    ("negative_count", "a member count is below zero", "ERROR"),
    ("implausible_count", "more than 45 active members in one cell", "ERROR"),
    ("invalid_state", "state code not in the list", "ERROR"),
    ("locality_missing", "no locality code", "ERROR"),
    ("locality_format", "locality code is not 6 or 7 digits", "WARNING"),
    ("period_missing", "no period", "ERROR"),
    ("carrier_unknown", "carrier code not in the register", "WARNING"),
    ("locality_names", "one locality code with several names", "WARNING"),
)
COUNTS_SQL = f"WITH {UNTIDY} " + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, '{d}' AS description, '{s}' AS severity, count(*) AS evaluated, "
    f"count(*) FILTER (NOT {n}) AS accepted, count(*) FILTER ({n}) AS violated FROM checked"
    for n, d, s in RULE_ROWS
)


def rules(spark, sf_dir):
    registered = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(
        F.col("s_suppkey").cast("string").alias("carrier_code")
    )
    return rulesets.enrolment_rules(registered, LIMIT, STATE_CODES)


@proof("rule_counts", COUNTS_SQL)
def rule_counts(spark, sf_dir):
    """All rules over all rows in one aggregation."""
    listed = rules(spark, sf_dir)
    return q.rule_counts(q.evaluate(untidy_enrolment(spark, sf_dir), listed), listed)


@proof(
    "validation_totals",
    f"WITH {UNTIDY} SELECT count(*) AS evaluated, count(*) FILTER (first_error IS NULL) AS accepted, "
    "count(first_error) AS rejected FROM decided",
)
def validation_totals(spark, sf_dir):
    return q.totals(q.evaluate(untidy_enrolment(spark, sf_dir), rules(spark, sf_dir)))


@proof(
    "rejects_first_rule",
    f"""WITH {UNTIDY} SELECT first_error AS rule, CASE first_error {" ".join(f"WHEN '{n}' THEN '{d}'" for n, d, _ in
    RULE_ROWS)} END AS reason, l_orderkey, l_partkey, carrier_code, active, state FROM decided
WHERE first_error IS NOT NULL""",
)
def rejects_first_rule(spark, sf_dir):
    rejected = q.rejected_rows(q.evaluate(untidy_enrolment(spark, sf_dir), rules(spark, sf_dir)))
    fields = ["l_orderkey", "l_partkey", "carrier_code", "active", "state"]
    return rejected.select("rule", "reason", *[f"record.{f}" for f in fields])


@proof(
    "accepted_rows",
    f"""WITH {UNTIDY} SELECT l_orderkey, l_partkey, carrier_code, locality_code, state, active, cancelled
FROM decided WHERE first_error IS NULL""",
)
def accepted_rows(spark, sf_dir):
    kept = q.accepted_rows(q.evaluate(untidy_enrolment(spark, sf_dir), rules(spark, sf_dir)))
    return kept.select("l_orderkey", "l_partkey", "carrier_code", "locality_code", "state", "active", "cancelled")


@proof("validate_written", COUNTS_SQL)
def validate_written(spark, sf_dir):
    """The validation job: rows written once, counters observed on the way."""
    outcome = q.validate(untidy_enrolment(spark, sf_dir), rules(spark, sf_dir), scratch_path(spark, "validated"))
    return outcome.counts


@proof(
    "unknown_reference",
    """SELECT l_suppkey, count(*) AS rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 2000) GROUP BY 1""",
)
def unknown_reference(spark, sf_dir):
    known = table(spark, sf_dir, "supplier").where("s_acctbal >= 2000")
    mark = q.not_in_reference("l_suppkey", known, "s_suppkey")
    flagged = mark(table(spark, sf_dir, "lineitem").select("l_suppkey"), "unknown")
    return flagged.where("unknown").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("rows"))


@proof(
    "name_conflict",
    """SELECT p_partkey, p_name, p_brand, count(*) OVER (PARTITION BY p_name) > 1 AND
  min(p_brand) OVER (PARTITION BY p_name) <> max(p_brand) OVER (PARTITION BY p_name) AS conflict FROM part""",
)
def name_conflict(spark, sf_dir):
    mark = q.several_names("p_name", "p_brand")
    return mark(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), "conflict")


ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@proof(
    "duplicate_flag",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(ORDER)}) > 1 AS repeated
FROM lineitem""",
)
def duplicate_flag(spark, sf_dir):
    flagged = flag_repeats(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ORDER, "repeated")
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "repeated")


@proof(
    "carrier_rules",
    """WITH r AS (SELECT *, CASE WHEN s_acctbal < 500 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS code,
    CASE WHEN s_acctbal > 9500 THEN NULL ELSE s_name END AS legal_name,
    lpad(CAST(s_suppkey AS VARCHAR), CASE WHEN s_acctbal > 5000 THEN 14 ELSE 9 END, '0') AS reg FROM supplier),
  f AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY s_suppkey) > 1 AS again FROM r)
SELECT 'carrier_code_missing' AS rule, count(*) FILTER (code = '') AS violated FROM f
UNION ALL SELECT 'legal_name_missing', count(*) FILTER (legal_name IS NULL) FROM f
UNION ALL SELECT 'registration_format', count(*) FILTER (NOT regexp_full_match(reg, '[0-9]{14}')) FROM f
UNION ALL SELECT 'carrier_repeated', count(*) FILTER (again) FROM f""",
)
def carrier_rules(spark, sf_dir):
    balance = F.col("s_acctbal")
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(balance < 500, "").otherwise(F.col("s_nationkey").cast("string")).alias("carrier_code"),
        F.when(balance <= 9500, F.col("s_name")).alias("legal_name"),
        F.when(balance > 5000, F.lpad(F.col("s_suppkey").cast("string"), 14, "0"))
        .otherwise(F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))
        .alias("registration_no"),
    )
    listed = rulesets.carrier_rules(order=["s_suppkey"])
    return q.rule_counts(q.evaluate(rows, listed), listed).select("rule", "violated")


@proof(
    "facility_rules",
    """WITH f AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1 AS again FROM part)
SELECT 'facility_code_missing' AS rule, count(*) FILTER (p_name IS NULL) AS violated FROM f
UNION ALL SELECT 'facility_name_missing', count(*) FILTER (p_size > 45) FROM f
UNION ALL SELECT 'type_missing', count(*) FILTER (p_type = 'PROMO') FROM f
UNION ALL SELECT 'facility_repeated', count(*) FILTER (again) FROM f
UNION ALL SELECT 'invalid_state', count(*) FILTER (p_brand <> 'Brand#2') FROM f""",
)
def facility_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("facility_code"),
        F.when(F.col("p_size") <= 45, F.col("p_brand")).otherwise("").alias("facility_name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("type_code"),
        F.col("p_brand").alias("state"),
    )
    listed = rulesets.facility_rules(order=["p_partkey"], state_codes=["Brand#2"])
    return q.rule_counts(q.evaluate(rows, listed), listed).select("rule", "violated")


@proof(
    "table_checks",
    f"""WITH {sql.ENROL}, {sql.RUNS}, {sql.RULES},
  d AS (SELECT DISTINCT {sql.PERIOD} AS period_key FROM orders),
  e AS (SELECT period_key, carrier_sk, sum(active) AS active, sum(joined - 3) AS joined, sum(cancelled) AS cancelled
        FROM enrol GROUP BY ALL)
SELECT 'month_range' AS rule, count(*) AS evaluated, 0::BIGINT AS violated FROM d
UNION ALL SELECT 'quarter_range', count(*), 0 FROM d UNION ALL SELECT 'half_range', count(*), 0 FROM d
UNION ALL SELECT 'active_negative', count(*), count(*) FILTER (active < 0) FROM e
UNION ALL SELECT 'joined_negative', count(*), count(*) FILTER (joined < 0) FROM e
UNION ALL SELECT 'cancelled_negative', count(*), count(*) FILTER (cancelled < 0) FROM e
UNION ALL SELECT 'status_domain', count(*), 0 FROM runs
UNION ALL SELECT 'result_negative', count(*), count(*) FILTER (accepted < 0) FROM results
UNION ALL SELECT 'severity_domain', count(*), 0 FROM results""",
)
def table_checks(spark, sf_dir):
    """The constraints of the loaded tables, as rules on the same engine."""
    keys = table(spark, sf_dir, "orders").select(roles.period_of_date("o_orderdate").alias("period_key")).distinct()
    fact = (
        roles.enrolment(spark, sf_dir)
        .groupBy("period_key", "carrier_sk")
        .agg(F.sum("active").alias("active"), F.sum(F.col("joined") - 3).alias("joined"), F.sum("cancelled").alias("cancelled"))
    )
    checks = [
        (period_attributes(keys), rulesets.time_checks()),
        (fact, rulesets.fact_checks()),
        (roles.runs(spark, sf_dir), rulesets.run_checks()),
        (roles.rule_results(spark, sf_dir), rulesets.result_checks()),
    ]
    counted = [q.rule_counts(q.evaluate(df, listed), listed) for df, listed in checks]
    stacked = counted[0]
    for more in counted[1:]:
        stacked = stacked.unionByName(more)
    return stacked.select("rule", "evaluated", "violated")




@proof(
    "repeated_identical",
    """WITH d AS (SELECT text FROM documents UNION ALL SELECT text FROM documents)
SELECT count(*) AS rows_read, count(DISTINCT text) AS accepted, count(*) - count(DISTINCT text) AS repeated FROM d""",
)
def repeated_identical(spark, sf_dir):
    """Copies that are equal in the rule's order too: exactly one of each stays."""
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("carrier_code"))
    rows = docs.unionAll(docs).withColumns({"legal_name": F.lit("same"), "registration_no": F.lit("00000000000000")})
    listed = rulesets.carrier_rules()
    flagged = q.evaluate(rows, listed)
    return q.totals(flagged).select(
        F.col("evaluated").alias("rows_read"), "accepted", F.col("rejected").alias("repeated")
    )
