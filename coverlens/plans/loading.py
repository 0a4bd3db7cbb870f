"""Cleaned datasets into the star: dimensions, keys, facts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.functions.periods import period_attributes
from coverlens.operators import dedupe, dimensions, facts
from coverlens.operators.grain import sum_to_grain
from coverlens.operators.lookups import lookup_key
from coverlens.sources.datasets import Prepared, PublishedTable, publish

CARRIER_TRACKED = ("legal_name", "kind", "seat_state")
CARRIER_OTHERS = ("registration_no", "trade_name", "seat_locality", "registered_on")
FACILITY_TRACKED = ("facility_name", "facility_type_sk", "locality_sk")

SCHEMAS = {
    "locality": "locality_sk long, locality_code string, locality_name string, state string, state_name string, "
    "region string",
    "carrier": "carrier_sk long, carrier_code string, legal_name string, kind string, seat_state string, "
    "registration_no string, trade_name string, seat_locality string, registered_on date, valid_from date, "
    "valid_to date, is_current boolean",
    "facility_type": "facility_type_sk long, type_code string, type_label string",
    "facility": "facility_sk long, facility_code string, facility_name string, facility_type_sk long, "
    "locality_sk long, valid_from date, valid_to date, is_current boolean",
    "time": "period_key int, period_date date, year int, month int, month_name string, quarter int, half int, "
    "period_label string",
    "enrolment": "carrier_sk long, locality_sk long, sex string, age_band string, tie_type string, segment string, "
    "active long, joined long, cancelled long, run_id long, period_key int",
    "network": "facility_sk long, facility_type_sk long, locality_sk long, facilities long, run_id long, "
    "period_key int",
    "state_summary": "state string, state_name string, region string, active_members long, facilities long, "
    "members_per_facility decimal(20,2), period_key int",
}


def _sentinel(name: str) -> dict[str, object]:
    import datetime

    always = datetime.date(1900, 1, 1)
    none = layouts.NOT_INFORMED
    return {
        "locality": {"locality_sk": -1, "locality_code": "0000000", "locality_name": none,
                     "state": layouts.UNKNOWN_STATE, "state_name": none, "region": none},
        "carrier": {"carrier_sk": -1, "carrier_code": "000000", "legal_name": none, "valid_from": always,
                    "is_current": True},
        "facility_type": {"facility_type_sk": -1, "type_code": "-1", "type_label": none},
        "facility": {"facility_sk": -1, "facility_code": "0000000", "facility_name": none, "facility_type_sk": -1,
                     "locality_sk": -1, "valid_from": always, "is_current": True},
    }[name]


def time_members(periods: DataFrame) -> DataFrame:
    """Time dimension rows for the distinct periods of a frame."""
    return period_attributes(periods.select("period_key").distinct())


def locality_members(batch: DataFrame, states: DataFrame) -> DataFrame:
    """Distinct localities of a batch with state name and region; unknown ones are left to the sentinel."""
    known = batch.where(
        (F.col("state") != layouts.UNKNOWN_STATE) & F.col("locality_code").isNotNull() & (F.col("locality_code") != "")
    ).select("locality_code", "state", "locality_name")
    one = dedupe.keep_first(known, ["locality_code", "state"], ["locality_name"])
    return (
        one.join(states, "state", "left")
        .fillna(layouts.NOT_INFORMED, ["state_name", "region"])
        .select("locality_code", "state", "locality_name", "state_name", "region")
    )


def type_members(batch: DataFrame) -> DataFrame:
    """Distinct facility types with a label; a missing code is left to the sentinel."""
    known = batch.where(F.col("type_code").isNotNull() & (F.col("type_code") != "")).select("type_code", "type_label")
    one = dedupe.keep_first(known, ["type_code"], [F.col("type_label").asc_nulls_last()])
    label = F.coalesce(F.nullif(F.col("type_label"), F.lit("")), F.concat(F.lit("Tipo "), F.col("type_code")))
    return one.withColumn("type_label", label)


def resolve_enrolment(batch: DataFrame, carriers: DataFrame, localities: DataFrame) -> DataFrame:
    """Surrogate keys in place of codes, added up again.

    Unknown codes share the key -1, so rows that were distinct before may meet at
    the surrogate grain; without the second sum they would collide.
    """
    current = carriers.where("is_current")
    keyed = lookup_key(batch, current, ["carrier_code"], "carrier_sk", layouts.UNKNOWN_KEY)
    keyed = lookup_key(keyed, localities, ["locality_code", "state"], "locality_sk", layouts.UNKNOWN_KEY)
    return sum_to_grain(keyed, layouts.ENROLMENT_FACT_GRAIN, layouts.MEASURES)


def resolve_facilities(batch: DataFrame, types: DataFrame, localities: DataFrame) -> DataFrame:
    """Facilities with the keys of their type and locality, -1 where unknown."""
    keyed = lookup_key(batch, types, ["type_code"], "facility_type_sk", layouts.UNKNOWN_KEY)
    keyed = lookup_key(keyed, localities, ["locality_code", "state"], "locality_sk", layouts.UNKNOWN_KEY)
    return keyed.select("facility_code", "facility_name", "facility_type_sk", "locality_sk")


class LoadMismatch(RuntimeError):
    """Updated plus inserted rows differ from the staged ones."""


@dataclass(frozen=True)
class LoadCounts:
    updated: int
    inserted: int


class Warehouse:
    """The published tables of the star below one root.

    They share one log.  A load writes all its tables first and publishes them with
    one record, so a load that fails leaves neither dimensions nor facts behind.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        facts_by_period = ("enrolment", "network", "state_summary")
        self.tables = {
            name: PublishedTable(
                spark, f"{self.root}/{name}", "period_key" if name in facts_by_period else None,
                f"{self.root}/published", name,
            )
            for name in SCHEMAS
        }
        self._written: dict[str, Prepared] | None = None

    @contextmanager
    def _one_load(self) -> Iterator[None]:
        """Tables written inside are published together at the end, or not at all."""
        self._written = {}
        try:
            yield
            publish(list(self._written.values()))
        finally:
            self._written = None

    def _write(self, name: str, rows: DataFrame, periods: list[int] | None = None) -> None:
        self._written[name] = self.tables[name].prepare(rows, periods)

    def read(self, name: str, periods: list[int] | None = None) -> DataFrame:
        """A table's published rows; empty with the right columns before the first load.

        Within a load, a dimension it has written is read as written.
        """
        if self._written and name in self._written and self.tables[name].part_column is None:
            return self.spark.read.parquet(self._written[name].target)
        found = self.tables[name].read(periods)
        if found is not None:
            return found
        empty = self.spark.createDataFrame([], SCHEMAS[name])
        if name in ("locality", "carrier", "facility_type", "facility"):
            return dimensions.with_unknown(empty, _sentinel(name))
        return empty

    def load_carriers(self, carriers: DataFrame, effective: str, **options: bool) -> None:
        with self._one_load():
            loaded = dimensions.upsert_type2(
                self.read("carrier"), carriers, "carrier_code", CARRIER_TRACKED, CARRIER_OTHERS, "carrier_sk",
                effective, **options,
            )
            self._write("carrier", loaded)

    def _add_period(self, period: int) -> None:
        have = self.read("time")
        wanted = self.spark.createDataFrame([(period,)], "period_key int")
        new = time_members(wanted).join(have, "period_key", "left_anti")
        if not new.isEmpty():
            self._write("time", have.unionByName(new))

    def _add_localities(self, batch: DataFrame, mode: str) -> None:
        members = locality_members(batch, layouts.states(self.spark))
        attributes = ["locality_name", "state_name", "region"]
        loaded = dimensions.upsert_type1(
            self.read("locality"), members, ["locality_code", "state"], attributes, "locality_sk", mode
        )
        self._write("locality", loaded.select(*layouts.LOCALITY_COLUMNS))

    def load_network(
        self, facilities: DataFrame, period: int, run_id: int, effective: str, dim_mode: str = "overwrite",
        fact_mode: str = "upsert",
    ) -> LoadCounts:
        """Types, localities, facility versions, then the network fact of the period."""
        with self._one_load():
            self._add_period(period)
            self._add_localities(facilities, dim_mode)
            types = dimensions.upsert_type1(
                self.read("facility_type"), type_members(facilities), ["type_code"], ["type_label"], "facility_type_sk",
                dim_mode,
            )
            self._write("facility_type", types)
            resolved = resolve_facilities(facilities, self.read("facility_type"), self.read("locality"))
            versions = dimensions.upsert_type2(
                self.read("facility"), resolved, "facility_code", FACILITY_TRACKED, (), "facility_sk", effective
            )
            self._write("facility", versions)
            staged = facts.network_members(self.read("facility"), facilities, "facility_code").select(
                F.lit(period).alias("period_key"),
                "facility_sk",
                "facility_type_sk",
                "locality_sk",
                F.lit(1).cast("bigint").alias("facilities"),
                F.lit(run_id).cast("bigint").alias("run_id"),
            )
            values = ["facility_type_sk", "locality_sk", "facilities", "run_id"]
            return self._upsert("network", staged, period, ["period_key", "facility_sk"], values, (), fact_mode)

    def load_enrolment(
        self, enrolment: DataFrame, period: int, run_id: int, dim_mode: str = "overwrite", fact_mode: str = "upsert"
    ) -> LoadCounts:
        """Localities, keys, second sum, then the enrolment fact of the period."""
        with self._one_load():
            self._add_period(period)
            self._add_localities(enrolment, dim_mode)
            staged = resolve_enrolment(enrolment, self.read("carrier"), self.read("locality")).withColumn(
                "run_id", F.lit(run_id).cast("bigint")
            )
            values = [*layouts.MEASURES, "run_id"]
            return self._upsert(
                "enrolment", staged, period, layouts.ENROLMENT_FACT_GRAIN, values, layouts.BLANK_IS_NULL, fact_mode
            )

    def _upsert(self, name, staged, period, grain, values, blank_is_null, mode) -> LoadCounts:
        """Merge one period, write it once, check the counters, publish.

        The merged rows are written with their action, counted from that copy and
        only then published, so a mismatch publishes nothing.
        """
        from coverlens.session import materialise

        staged = materialise(staged, f"staged-{name}")
        merged = facts.upsert_fact(self.read(name, [period]), staged, grain, values, blank_is_null, mode)
        merged = materialise(merged, f"merged-{name}")
        counts = {r["action"]: r["rows"] for r in facts.action_counts(merged).collect()}
        done = LoadCounts(counts.get(facts.UPDATE, 0), counts.get(facts.INSERT, 0))
        expected = staged.count()
        if done.updated + done.inserted != expected:
            raise LoadMismatch(f"{name}: {expected} rows staged, {done.updated} updated + {done.inserted} inserted")
        self._write(name, merged.drop("_action"), [period])
        return done

    def load_state_summary(self, period: int, facility_agg: str = "sum") -> None:
        from coverlens.plans.marts import state_summary
        from coverlens.plans.star import Star

        star = Star(self.read("enrolment", [period]), self.read("network", [period]), self.read("locality"))
        rows = state_summary(star, facility_agg, [period])
        with self._one_load():
            self._write("state_summary", rows, [period])

    def star(self, runs: DataFrame | None = None, rules: DataFrame | None = None):
        from coverlens.plans.star import Star

        return Star(
            self.read("enrolment"), self.read("network"), self.read("locality"), self.read("carrier"),
            self.read("facility_type"), runs, rules,
        )
