"""Run audit as an append-only event table, folded to one row per run."""

from __future__ import annotations

import time
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.layouts import RUN_SCHEMA
from coverlens.sources.datasets import DatasetMissing, read_dataset

RUNNING, SUCCESS, PARTIAL, FAILED = "RUNNING", "SUCCESS", "PARTIAL", "FAILED"
STATUSES = (RUNNING, SUCCESS, PARTIAL, FAILED)


def outcome_status(accepted: int, rejected: int) -> str:
    """Some of both is a partial success; only rejects is a failure."""
    if rejected and accepted:
        return PARTIAL
    return FAILED if rejected else SUCCESS


def fold_runs(events: DataFrame) -> DataFrame:
    """Start and finish events to one row per run.

    Text of the start event, counters and status of the newest event.
    """
    newest = F.struct("event_at", F.when(F.col("event") == "finish", 1).otherwise(0))
    last = ("status", "received", "valid", "rejected", "violated_rule", "error_message")
    started = F.when(F.col("event") == "start", F.col("event_at"))
    finished = F.when(F.col("event") == "finish", F.col("event_at"))
    folded = events.groupBy("run_id").agg(
        *[F.max(c).alias(c) for c in ("pipeline", "stage", "period", "source", "origin_file", "file_hash")],
        F.date_trunc("second", F.min(started)).alias("started_at"),
        F.date_trunc("second", F.max(finished)).alias("finished_at"),
        *[F.max_by(c, newest).alias(c) for c in last],
    )
    return folded.withColumn(
        "duration_seconds", F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")
    )


class RunLog:
    """Writes the two events of every stage run, and the rule results."""

    def __init__(self, spark: SparkSession, root: str, pipeline: str = "coverage"):
        self.spark, self.root, self.pipeline = spark, root.rstrip("/"), pipeline
        self._last = 0

    def _append(self, values: Mapping[str, object]) -> None:
        row = tuple(values.get(f.name) for f in RUN_SCHEMA.fields)
        self.spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/events")

    def start(self, stage: str, period: str | None = None, source: str | None = None, **more: object) -> int:
        # The clock in microseconds; never the same twice in one driver.
        self._last = max(self._last + 1, time.time_ns() // 1000)
        self._append(
            {"run_id": self._last, "event": "start", "event_at": datetime.now(UTC), "pipeline": self.pipeline,
             "stage": stage, "period": period, "source": source, "status": RUNNING, **more}
        )
        return self._last

    def finish(self, run_id: int, status: str, **counters: object) -> None:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}")
        self._append(
            {"run_id": run_id, "event": "finish", "event_at": datetime.now(UTC), "status": status, **counters}
        )

    def rule_results(self, run_id: int, stage: str, counts: DataFrame) -> None:
        rows = counts.select(
            F.lit(run_id).cast("bigint").alias("run_id"),
            F.lit(stage).alias("stage"),
            "rule", "description", "severity", "evaluated", "accepted", "violated",
            F.current_timestamp().alias("evaluated_at"),
        )
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/rules")

    def runs(self) -> DataFrame:
        return fold_runs(read_dataset(self.spark, f"{self.root}/events", RUN_SCHEMA))

    def rules(self) -> DataFrame | None:
        try:
            return read_dataset(self.spark, f"{self.root}/rules")
        except DatasetMissing:
            return None
