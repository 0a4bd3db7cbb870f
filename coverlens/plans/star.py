"""The star schema the marts read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Star:
    """Frames of the warehouse; a mart touches only the ones it needs.

    enrolment: period_key, carrier_sk, locality_sk, sex, age_band, tie_type,
    segment, active, joined, cancelled.
    network: period_key, facility_sk, facility_type_sk, locality_sk, facilities.
    locality: locality_sk, locality_code, locality_name, state, state_name, region.
    carrier: carrier_sk, carrier_code, legal_name, kind, ...
    facility_type: facility_type_sk, type_code, type_label.
    runs: one row per stage run.  rules: one row per run and rule.
    """

    enrolment: DataFrame | None = None
    network: DataFrame | None = None
    locality: DataFrame | None = None
    carrier: DataFrame | None = None
    facility_type: DataFrame | None = None
    runs: DataFrame | None = None
    rules: DataFrame | None = None
