"""Pieces of the comparison SQL: the role mapping and exact decimals."""

from __future__ import annotations

from coverlens.functions.periods import MONTH_NAMES
from coverlens.functions.text import WHITE_SPACE

PERIOD = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)"

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
LOCALITY = f"CAST(c_nationkey * 5 + list_position({list(SEGMENTS)}, c_mktsegment) - 1 AS BIGINT)"

ENROL = f"""enrol AS (
  SELECT {PERIOD} AS period_key, l_suppkey AS carrier_sk, {LOCALITY} AS locality_sk,
         l_returnflag AS sex, o_orderpriority AS age_band, l_linestatus AS tie_type, c_mktsegment AS segment,
         CAST(l_quantity AS BIGINT) AS active, CAST(round(l_discount * 100) AS BIGINT) AS joined,
         CAST(l_linenumber AS BIGINT) AS cancelled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

PLACES = """places AS (
  SELECT CAST(n_nationkey * 5 + d AS BIGINT) AS locality_sk, CAST(n_nationkey * 5 + d AS VARCHAR) AS locality_code,
         n_name || '/' || d AS locality_name, n_name AS state, n_name AS state_name, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey, range(5) district(d))"""

NETWORK = f"""network AS (
  SELECT DISTINCT {PERIOD} AS period_key, l_partkey, l_suppkey, p_type, s_nationkey * 5 + l_partkey % 5 AS locality_sk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

MEMBERS = """members AS (
  SELECT period_key, locality_code, locality_name, state, state_name, region,
         CAST(sum(active) AS BIGINT) AS active_members
  FROM enrol JOIN places USING (locality_sk) GROUP BY ALL)"""

FACILITIES = """facilities AS (
  SELECT period_key, locality_code, locality_name, state, state_name, region, count(*) AS facilities
  FROM network JOIN places USING (locality_sk) GROUP BY ALL)"""

RUNS = """runs AS (
  SELECT event_id AS run_id, 'coverage' AS pipeline, event_type AS stage, strftime(ts, '%Y-%m') AS period,
         'source ' || user_id AS source, date_trunc('second', ts) AS started_at,
         CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) + to_seconds(k) END AS finished_at,
         CASE WHEN event_type <> 'signup' THEN k END AS duration_seconds,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
         cents AS received, greatest(cents - k, 0) AS valid, least(cents, k) AS rejected
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(round(value * 100) AS BIGINT) AS cents FROM events))"""

RULES = """results AS (
  SELECT run_id, stage, started_at AS evaluated_at, rule, description, severity, received AS evaluated,
         received - violated AS accepted, violated
  FROM (SELECT *, 'negative_count' AS rule, 'below zero' AS description, 'ERROR' AS severity, rejected AS violated
        FROM runs
        UNION ALL
        SELECT *, 'carrier_unknown', 'not registered', 'WARNING', rejected // 2 FROM runs))"""


def period_date(key: str = "period_key") -> str:
    return f"(CAST({key} // 100 AS VARCHAR) || '-' || lpad(CAST({key} % 100 AS VARCHAR), 2, '0') || '-01')"


def month_name(key: str = "period_key", lower: bool = False) -> str:
    names = ", ".join(f"'{n.lower() if lower else n}'" for n in MONTH_NAMES)
    return f"([{names}])[{key} % 100]"


def period_label(key: str = "period_key") -> str:
    return f"({month_name(key)} || '/' || CAST({key} // 100 AS VARCHAR))"


def quotient(num: str, den: str, digits: int) -> str:
    """num / den rounded half away from zero to some digits, as a double; null for a zero divisor."""
    scale = 10**digits
    return (
        f"(CASE WHEN coalesce({den}, 0) <> 0 THEN CAST(sign({num}) * ((2 * {scale} * abs(CAST({num} AS HUGEINT)) "
        f"+ {den}) // (2 * {den})) AS DOUBLE) / {scale} END)"
    )


def percent(num: str, den: str) -> str:
    return quotient(f"(100 * CAST({num} AS HUGEINT))", den, 2)


def change_percent(cur: str, prev: str) -> str:
    return f"(CASE WHEN {prev} > 0 THEN {percent(f'({cur} - {prev})', prev)} END)"


def stripped(text: str) -> str:
    """``text`` without white space at its ends."""
    marks = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
    return f"trim({text}, {marks})"
