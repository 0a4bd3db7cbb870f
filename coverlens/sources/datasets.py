"""Parquet datasets: period partitions, versioned tables, exports, rejects."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.session import materialise
from coverlens.sources.commitlog import KEPT_SECONDS, CommitLog, Part, State, vacuum


class DatasetMissing(FileNotFoundError):
    """The dataset or period was not written yet."""


def by_part(df: DataFrame, part_column: str) -> DataFrame:
    """Bring the rows of a part together for writing.

    Spark balances the result at run time: a part with most of the rows is split
    over tasks, small parts share one, and no part is scattered over every task.
    """
    return df.hint("rebalance", F.col(part_column))


def write_period(df: DataFrame, path: str, period_column: str = "period_key") -> None:
    """Overwrite the periods the frame holds; other periods stay."""
    (
        by_part(df, period_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period_column)
        .parquet(path)
    )


def read_dataset(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise DatasetMissing(f"nothing written at {path}; run the stage before") from problem
        raise


def read_period(spark: SparkSession, path: str, period: int, period_column: str = "period_key") -> DataFrame:
    """One period of a dataset; only its directory is read."""
    rows = read_dataset(spark, path).where(F.col(period_column) == period)
    if rows.isEmpty():
        raise DatasetMissing(f"period {period} not written at {path}")
    return rows


class ConcurrentLoad(RuntimeError):
    """Another load replaced the same parts while this one was written."""


@dataclass(frozen=True)
class Prepared:
    """A written version of a table that no reader sees yet; ``seen`` holds the versions its parts had before."""

    table: PublishedTable
    seen: dict[str, int]
    target: str
    lines: list[Part]
    note: str | None


class PublishedTable:
    """A table whose readers see whole loads only.

    A load writes new files beside the old ones and is then published by one entry of a log (``CommitLog``); readers take the newest
    line of each part.  A load that dies half way has published nothing, and a rerun publishes again.  Of two loads that
    replace the same part at once one is refused.  Tables that are loaded together share a log (``log``, with a ``name`` for
    each) and are published together.
    """

    def __init__(
        self, spark: SparkSession, root: str, part_column: str | None = None, log: str | None = None, name: str = ""
    ):
        self.spark, self.root, self.part_column = spark, root.rstrip("/"), part_column
        self.log, self.name = CommitLog(log or f"{self.root}/published"), name

    def _newest(self) -> dict[str, Part]:
        return self.log.state().of(self.name)

    def last_version(self) -> int:
        return max((line.version for line in self._newest().values()), default=0)

    def exists(self) -> bool:
        return bool(self._newest())

    def read(self, parts: Sequence[int | str] | None = None) -> DataFrame | None:
        """The published rows, of all or the named parts; None if there are none."""
        newest = self._newest()
        wanted = newest if parts is None else {str(p): newest[str(p)] for p in parts if str(p) in newest}
        filled = {p: line.folder for p, line in wanted.items() if line.filled}
        if not filled:
            return None
        if self.part_column is None:
            return self.spark.read.parquet(f"{self.root}/data/version={filled['all']}")
        paths = [f"{self.root}/data/version={v}/{self.part_column}={p}" for p, v in filled.items()]
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths).drop("version")

    def has_note(self, note: str) -> bool:
        """Whether a load with this note was published."""
        return self.log.has_note(note)

    def write(self, df: DataFrame, parts: Sequence[int | str] | None = None, note: str | None = None) -> int:
        """Write the frame as a new version and publish it; see ``prepare``."""
        prepared = self.prepare(df, parts, note)
        publish([prepared])
        return prepared.lines[0].version if prepared.lines else self.last_version()

    def prepare(self, df: DataFrame, parts: Sequence[int | str] | None = None, note: str | None = None) -> Prepared:
        """Write the frame as a new version that ``publish`` makes visible.

        A partitioned table needs the names of the parts this load replaces; one
        without rows is published as empty.
        """
        newest = self._newest()
        version = max((line.version for line in newest.values()), default=0) + 1
        # A folder of its own: another writer's files are never touched.
        folder = f"{version}-{uuid.uuid4().hex}"
        target = f"{self.root}/data/version={folder}"
        placed = df if self.part_column is None else by_part(df, self.part_column)
        writer = placed.write.mode("errorifexists")
        if self.part_column is None:
            writer.parquet(target)
            filled = {"all": True}
        else:
            if parts is None:
                raise ValueError("name the parts this load replaces")
            writer.partitionBy(self.part_column).parquet(target)
            found = self.spark.read.schema(df.schema).parquet(target).select(self.part_column).distinct().collect()
            present = {str(r[0]) for r in found}
            filled = {str(p): str(p) in present for p in parts}
        lines = [Part(self.name, part, version, has_rows, folder) for part, has_rows in filled.items()]
        seen = {part: newest[part].version if part in newest else 0 for part in filled}
        return Prepared(self, seen, target, lines, note)

    def vacuum(self, older_than: float = KEPT_SECONDS) -> int:
        """Delete versions that no reader can reach any more, after so many seconds, and log entries that the log's state covers."""
        self.log.tidy(older_than)
        return vacuum(self.root, {line.folder for line in self._newest().values()}, older_than)


def publish(load: Sequence[Prepared]) -> None:
    """Make all tables of a load visible at once, by one entry of their common log.

    Fails if another load published one of the parts since this one read them; loads of other parts do not matter.
    """
    if not load:
        return
    log = load[0].table.log
    if {p.table.log.path for p in load} != {log.path}:
        raise ValueError("tables published together share one log")
    notes = {p.note for p in load if p.note is not None}
    if len(notes) > 1:
        raise ValueError("a load has one note")

    def lines(state: State) -> list[Part]:
        for prepared in load:
            now = state.of(prepared.table.name)
            for part, version in prepared.seen.items():
                if (now[part].version if part in now else 0) != version:
                    raise ConcurrentLoad(f"another load replaced part {part} at {prepared.table.root} meanwhile; run this one again")
        return [line for prepared in load for line in prepared.lines]

    log.append(lines, *notes)


def reject_records(
    rejected: DataFrame, run_id: int, dataset: str, period: int, rejected_at: Column | None = None
) -> DataFrame:
    """Rejected records (rule, reason, record) with the run's context."""
    return rejected.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.lit(dataset).alias("dataset"),
        F.lit(period).alias("period_key"),
        "rule",
        "reason",
        "record",
        (rejected_at if rejected_at is not None else F.current_timestamp()).alias("rejected_at"),
    )


def write_reject_lines(records: DataFrame, path: str) -> None:
    """JSON lines per dataset, period and run, each file gzipped; a rerun of one run replaces its lines."""
    (
        records.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("ignoreNullFields", False)
        .partitionBy("dataset", "period_key", "run_id")
        .json(path)
    )


def reject_table_rows(records: DataFrame) -> DataFrame:
    """The record as JSON text, for a table with one payload column."""
    payload = F.to_json(F.col("record"), {"ignoreNullFields": "false"})
    return records.select("run_id", "dataset", "rule", "reason", payload.alias("record_json"), "rejected_at")


def stage_batch(df: DataFrame, path: str, group_bytes: int | None = None) -> DataFrame:
    """Replace the staging copy of a batch and read it back.

    Tasks share a file by its row groups, so where files are few and large, name smaller groups.
    """
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int = 5000) -> None:
    """Replace a warehouse staging table (truncate, then batched inserts)."""
    (
        df.write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=dict(properties))
    )


def export_marts(marts: Mapping[str, DataFrame], path: str, period: int) -> list[str]:
    """One Parquet snapshot per mart below the period's directory."""
    written = []
    for name, frame in marts.items():
        target = f"{path.rstrip('/')}/period={period}/mart={name}"
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
        written.append(target)
    return written


def query_mart(
    spark: SparkSession, sql: str, args: Mapping[str, object] | None = None, cap: int | None = None
) -> tuple[DataFrame, bool]:
    """Bound parameters; the frame and whether rows were cut.  Nothing is cut unless a cap is named."""
    rows = spark.sql(sql, args=dict(args or {}))
    return (rows, False) if cap is None else capped(rows, cap)


def capped(rows: DataFrame, cap: int) -> tuple[DataFrame, bool]:
    """The first ``cap`` rows and whether there were more; the plan runs once, and no more than ``cap + 1`` rows are kept."""
    kept = materialise(rows.limit(cap + 1), "capped")
    return kept.limit(cap), kept.count() > cap
