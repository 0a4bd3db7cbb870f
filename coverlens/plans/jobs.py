"""The stage list: each stage runs on its own and again; a failed one stops the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.functions.periods import format_period, parse_period
from coverlens.operators.quality import validate
from coverlens.plans import cleaning, marts, rulesets
from coverlens.plans.audit import FAILED, PARTIAL, SUCCESS, RunLog, outcome_status
from coverlens.plans.loading import Warehouse
from coverlens.sources import archives, datasets, delimited, manifest

# The names of the stages, in their order.
STAGES = (
    "extract",
    "validate_raw",
    "transform",
    "validate_trusted",
    "load",
    "aggregate",
    "refresh_views",
    "export_analytics",
)
SOURCES = ("enrolment", "carriers", "facilities")
PROBLEMS_SHOWN = 20
#: Bytes of a row group of unpacked archives, so that the rows of a large one are read by several tasks.
STAGED_GROUP = 8 << 20


@dataclass
class StageReport:
    stage: str
    source: str | None
    status: str
    counters: dict[str, int] = field(default_factory=dict)
    error: str | None = None


class Pipeline:
    """Monthly run over ``root``.

    Landed files lie in ``raw/enrolment/<period>``, ``raw/carriers/
    snapshot_date=<day>`` and ``raw/facilities/<period>``.
    """

    def __init__(self, spark: SparkSession, root: str, period: str, effective: str, sources=SOURCES):
        self.spark, self.root = spark, root.rstrip("/")
        self.period_key, self.effective, self.sources = parse_period(period), effective, tuple(sources)
        self.log = RunLog(spark, f"{self.root}/audit")
        self.warehouse = Warehouse(spark, f"{self.root}/warehouse")
        self.reports: list[StageReport] = []

    # Paths

    def raw(self, source: str) -> str:
        return f"{self.root}/raw/{source}" + ("" if source == "carriers" else f"/{self.period_key}")

    def trusted(self, source: str) -> str:
        return f"{self.root}/trusted/{source}/{self.period_key}"

    def validated(self, source: str) -> str:
        return f"{self.root}/validated/{source}/{self.period_key}"

    # Running

    def run(self, stage: str = "all", force: bool = False) -> bool:
        """Run one stage or all in order; false as soon as a stage fails."""
        names = STAGES if stage == "all" else (stage,)
        for name in names:
            if not self._stage(name, force):
                return False
        return True

    def _stage(self, name: str, force: bool) -> bool:
        steps: dict[str, Callable[[str], StageReport]] = {
            "extract": lambda s: self._extract(s, force),
            "validate_raw": self._validate_raw,
            "transform": self._transform,
            "validate_trusted": self._validate,
            "load": self._load,
        }
        whole: dict[str, Callable[[], StageReport]] = {
            "aggregate": self._aggregate,
            "refresh_views": self._views,
            "export_analytics": self._export,
        }
        if name in whole:
            return self._logged(name, None, whole[name])
        # Carriers come first: later sources look their codes up.
        ordered = [s for s in ("carriers", "facilities", "enrolment") if s in self.sources]
        return all([self._logged(name, s, lambda s=s: steps[name](s)) for s in ordered])

    def _logged(self, stage: str, source: str | None, step: Callable[[], StageReport]) -> bool:
        run_id = self.log.start(stage, format_period(self.period_key), source)
        self._run_id = run_id
        try:
            report = step()
        except (OSError, ValueError, RuntimeError, PySparkException) as problem:
            report = StageReport(stage, source, FAILED, error=str(problem))
        known = {k: v for k, v in report.counters.items() if k in ("received", "valid", "rejected")}
        self.log.finish(run_id, report.status, error_message=report.error, **known)
        self.reports.append(report)
        return report.status in (SUCCESS, PARTIAL)

    # Stages

    def _extract(self, source: str, force: bool) -> StageReport:
        """Register landed files that the manifest does not hold yet."""
        suffixes = {"enrolment": ("zip",), "carriers": ("csv",)}.get(source, manifest.LANDED_SUFFIXES)
        listing = manifest.file_manifest(
            manifest.list_landed(self.spark, self.raw(source), suffixes),
            F.lit(source),
            F.lit(format_period(self.period_key)),
        )
        path = f"{self.root}/manifest"
        try:
            known = datasets.read_dataset(self.spark, path, listing.schema)
            fresh = manifest.not_registered(listing, known, force)
        except datasets.DatasetMissing:
            fresh = listing
        fresh = datasets.stage_batch(fresh, f"{self.root}/staging/manifest-{source}")
        landed = listing.select("path").count()
        if landed == 0:
            raise datasets.DatasetMissing(f"no landed file of {source} below {self.raw(source)}")
        fresh.write.mode("append").parquet(path)
        return StageReport("extract", source, SUCCESS, {"received": landed, "valid": landed, "new": fresh.count()})

    def _validate_raw(self, source: str) -> StageReport:
        if source != "enrolment":
            return StageReport("validate_raw", source, SUCCESS)
        checked = datasets.stage_batch(archives.check_landed_archives(self.spark, self.raw(source)), f"{self.root}/staging/archives")
        row = checked.agg(F.count(F.lit(1)).alias("files"), F.count("problem").alias("bad")).first()
        # The report names some; all are in the staged table.
        shown = checked.where("problem is not null").orderBy("path").limit(PROBLEMS_SHOWN).collect()
        text = "; ".join(f"{r['path']}: {r['problem']}" for r in shown)
        counters = {"received": row["files"], "valid": row["files"] - row["bad"], "rejected": row["bad"]}
        return StageReport("validate_raw", source, FAILED if row["bad"] else SUCCESS, counters, text or None)

    def _transform(self, source: str) -> StageReport:
        counters: dict[str, int] = {}
        failed = 0
        if source == "enrolment":
            unpacked = archives.read_archives(self.spark, self.raw(source), layouts.ENROLMENT_COLUMNS).drop(archives.POSITION)
            # Unpacked once; the status rows and the data rows both come from this copy.
            landed = datasets.stage_batch(unpacked, f"{self.root}/staging/enrolment", STAGED_GROUP)
            failed = archives.failed_files(landed).count()
            rows = archives.readable_rows(landed)
            if rows.isEmpty():
                raise ValueError(f"no readable archive below {self.raw(source)}")
            cleaned = cleaning.clean_enrolment(rows, self.period_key)
        elif source == "carriers":
            every = delimited.read_delimited(self.spark, self.raw(source))
            cleaned = cleaning.clean_carriers(delimited.latest_snapshot(every).drop("snapshot_date"))
        else:
            cleaned = cleaning.clean_facilities(
                delimited.read_detected(self.spark, self.raw(source)), self.period_key
            )
        cleaned.frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.trusted(source))
        counters.update(cleaned.statistics(), files_ignored=failed)
        counters.update(received=counters["rows_read"], valid=counters["rows_written"])
        return StageReport("transform", source, outcome_status(counters["rows_written"], failed), counters)

    def _validate(self, source: str) -> StageReport:
        rows = datasets.read_dataset(self.spark, self.trusted(source))
        if source == "carriers":
            rules = rulesets.carrier_rules()
        elif source == "facilities":
            rules = rulesets.facility_rules()
        else:
            try:
                known = self._accepted("carriers")
            except datasets.DatasetMissing:
                known = None
            rules = rulesets.enrolment_rules(known)
        outcome = validate(rows, rules, self.validated(source))
        records = datasets.reject_records(outcome.rejected, self._run_id, source, self.period_key)
        if outcome.rejected_count:
            datasets.write_reject_lines(records, f"{self.root}/rejected")
            datasets.reject_table_rows(records).write.mode("append").parquet(f"{self.root}/reject_table")
        self.log.rule_results(self._run_id, "validate_trusted", outcome.counts)
        counters = {
            "received": outcome.evaluated,
            "valid": outcome.accepted_count,
            "rejected": outcome.rejected_count,
        }
        return StageReport("validate_trusted", source, SUCCESS if outcome.accepted_count else FAILED, counters)

    def _accepted(self, source: str):
        stored = datasets.read_dataset(self.spark, self.validated(source))
        return stored.where("not _rejected").drop("_rejected", "_first_error", "_first_reason")

    def _load(self, source: str) -> StageReport:
        rows = self._accepted(source)
        if source == "carriers":
            self.warehouse.load_carriers(rows, self.effective)
            return StageReport("load", source, SUCCESS, {"valid": rows.count()})
        if source == "facilities":
            done = self.warehouse.load_network(rows, self.period_key, self._run_id, self.effective)
        else:
            done = self.warehouse.load_enrolment(rows, self.period_key, self._run_id)
        counters = {"received": rows.count(), "valid": done.updated + done.inserted}
        return StageReport("load", source, SUCCESS, counters | {"updated": done.updated, "inserted": done.inserted})

    def _aggregate(self) -> StageReport:
        self.warehouse.load_state_summary(self.period_key)
        rows = self.warehouse.read("state_summary", [self.period_key]).count()
        return StageReport("aggregate", None, SUCCESS, {"valid": rows})

    def star(self):
        return self.warehouse.star(self.log.runs(), self.log.rules())

    def _views(self) -> StageReport:
        made = marts.register_views(self.star())
        return StageReport("refresh_views", None, SUCCESS, {"valid": len(made)})

    def _export(self) -> StageReport:
        frames = {name: marts.MARTS[name](star) for name, star in marts.exported_stars(self.star()).items()}
        written = datasets.export_marts(frames, f"{self.root}/analytics", self.period_key)
        return StageReport("export_analytics", None, SUCCESS, {"valid": len(written)})
