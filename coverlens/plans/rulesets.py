"""The rules of the three datasets and of the loaded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.operators import quality as q
from coverlens.operators.quality import ERROR, WARNING, Rule
from coverlens.plans.audit import STATUSES

# Fixed value: no cell of the grain plausibly holds more members.
PLAUSIBLE_MEMBERS = 500_000


def enrolment_rules(
    carriers: DataFrame | None = None,
    limit: int = PLAUSIBLE_MEMBERS,
    state_codes: Sequence[str] = layouts.STATE_CODES,
) -> list[Rule]:
    unknown = F.col("state") == layouts.UNKNOWN_STATE
    return [
        Rule("negative_count", "a member count is below zero", ERROR, q.negative(layouts.MEASURES)),
        Rule("implausible_count", f"more than {limit} active members in one cell", ERROR, q.above("active", limit)),
        Rule("invalid_state", "state code not in the list", ERROR, q.outside_domain("state", state_codes)),
        Rule("locality_missing", "no locality code", ERROR, q.blank("locality_code")),
        Rule("locality_format", "locality code is not 6 or 7 digits", WARNING,
             q.not_matching("locality_code", "[0-9]{6,7}", unless=unknown)),
        Rule("period_missing", "no period", ERROR, q.missing("period_key")),
        Rule("carrier_unknown", "carrier code not in the register", WARNING,
             q.not_in_reference("carrier_code", carriers, "carrier_code")),
        Rule("locality_names", "one locality code with several names", WARNING,
             q.several_names("locality_code", "locality_name", skip=unknown)),
    ]


def carrier_rules(order: Sequence[str] = ("legal_name", "registration_no")) -> list[Rule]:
    return [
        Rule("carrier_code_missing", "no carrier code", ERROR, q.blank("carrier_code")),
        Rule("legal_name_missing", "no legal name", ERROR, q.blank("legal_name")),
        Rule("registration_format", "registration number is not 14 digits", WARNING,
             q.not_matching("registration_no", "[0-9]{14}")),
        Rule("carrier_repeated", "carrier code occurs before", ERROR, q.repeated_key(["carrier_code"], order)),
    ]


def facility_rules(
    order: Sequence[str] = ("facility_name", "locality_code"), state_codes: Sequence[str] = layouts.STATE_CODES
) -> list[Rule]:
    return [
        Rule("facility_code_missing", "no facility code", ERROR, q.blank("facility_code")),
        Rule("facility_name_missing", "no facility name", ERROR, q.blank("facility_name")),
        Rule("type_missing", "no facility type", WARNING, q.blank("type_code")),
        Rule("facility_repeated", "facility code occurs before", ERROR, q.repeated_key(["facility_code"], order)),
        Rule("invalid_state", "state code not in the list", WARNING, q.outside_domain("state", state_codes)),
    ]


def _outside(column: str, low: int, high: int):
    return ~F.coalesce(F.col(column).between(low, high), F.lit(False))


def time_checks() -> list[Rule]:
    return [
        Rule("month_range", "month outside 1..12", ERROR, _outside("month", 1, 12)),
        Rule("quarter_range", "quarter outside 1..4", ERROR, _outside("quarter", 1, 4)),
        Rule("half_range", "half-year outside 1..2", ERROR, _outside("half", 1, 2)),
    ]


def fact_checks(measures: Sequence[str] = layouts.MEASURES) -> list[Rule]:
    return [Rule(f"{m}_negative", f"{m} is below zero", ERROR, q.negative([m])) for m in measures]


def network_checks() -> list[Rule]:
    return [Rule("facilities_not_positive", "facility count is not above zero", ERROR, F.col("facilities") <= 0)]


def run_checks() -> list[Rule]:
    return [Rule("status_domain", "status not in the list", ERROR, q.outside_domain("status", STATUSES))]


def result_checks() -> list[Rule]:
    counts = ["evaluated", "accepted", "violated"]
    return [
        Rule("result_negative", "a rule counter is below zero", ERROR, q.negative(counts)),
        Rule("severity_domain", "severity not in the list", ERROR, q.outside_domain("severity", (ERROR, WARNING))),
    ]
