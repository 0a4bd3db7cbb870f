"""A register of deliveries by content: a file counts once whatever its name, and a changed file of the same name counts again.

The source lists what changed since the last run and hashes each file in its task.  A batch is joined with the register, which knows every
hash and the names it came under.  The register is a table that outlives checkpoints: a stream that starts with a new checkpoint goes on from it.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from coverlens.session import materialise
from coverlens.sources.storage import BLOCK, locate

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library

SOURCE = "landed_files"
FILES = "path string, length long, modified long, sha256 string"
DELIVERIES = "sha256 string, path string, length long, modified long, status string, first_path string"
NEW, REPEATED = "new", "repeated"
#: Files that land within so many microseconds of the newest one seen are listed again: clocks of writers differ.
SLACK = 60_000_000
TASK_FILES = 500


class LandedFiles(DataSource):
    """A stream of (path, length, modified, sha256) of the files below ``path``; ``modified`` counts microseconds."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return FILES

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return LandedReader(self.options["path"])


class Listed(InputPartition):
    def __init__(self, files: list[tuple[str, int, int]]) -> None:
        self.files = files


class LandedReader(DataSourceStreamReader):
    """Offsets are times of change; files that share one with those seen come again and are known by their content."""

    def __init__(self, path: str) -> None:
        self.path = path

    def _files(self) -> list[tuple[str, int, int]]:
        system, place = locate(self.path)
        found = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
        prefix = len(place.rstrip("/")) + 1
        return [
            (f.path[prefix:], f.size, f.mtime_ns // 1000)
            for f in found
            if f.is_file and not f.base_name.startswith((".", "_")) and not f.base_name.endswith(".partial")
        ]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"modified": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"modified": max((f[2] for f in self._files()), default=0)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        changed = sorted(f for f in self._files() if start["modified"] - SLACK < f[2] <= end["modified"])
        return [Listed(changed[i : i + TASK_FILES]) for i in range(0, len(changed), TASK_FILES)]

    def read(self, partition: Listed) -> Iterator[pa.RecordBatch]:
        system, folder = locate(self.path)
        rows = []
        for name, size, modified in partition.files:
            state = hashlib.sha256()
            try:
                with system.open_input_stream(f"{folder.rstrip('/')}/{name}", compression=None) as file:
                    while block := file.read(BLOCK):
                        state.update(block)
            except FileNotFoundError:  # replaced or taken away since it was listed; a new one has a later time
                continue
            rows.append((name, size, modified, state.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "length", "modified", "sha256"]
        )

    def commit(self, end: dict) -> None:
        """Nothing is kept besides the offset."""


def read_register(spark: SparkSession, register: str) -> DataFrame:
    """The deliveries so far; empty before the first."""
    return _deliveries(spark, register).drop("stream", "batch")


def _deliveries(spark: SparkSession, register: str) -> DataFrame:
    schema = f"{DELIVERIES}, stream string, batch long"
    try:
        return spark.read.schema(schema).parquet(register)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def by_content(files: DataFrame, known: DataFrame) -> DataFrame:
    """Deliveries among ``files`` that ``known`` does not hold: the first of a hash is new, any other repeats it.

    A file listed again with the same content and time is no delivery.  First names are found by aggregation, so copies of one
    content are not gathered in one task.  ``files`` is read twice.
    """
    fresh = files.join(known.select("sha256", "path", "modified"), ["sha256", "path", "modified"], "left_anti")
    first = fresh.groupBy("sha256").agg(F.min(F.struct("modified", "path")).alias("_first"))
    before = known.groupBy("sha256").agg(F.min("first_path").alias("_before"))
    first = first.join(before, "sha256", "left")
    is_new = F.col("_before").isNull() & (F.col("path") == F.col("_first.path")) & (F.col("modified") == F.col("_first.modified"))
    return fresh.join(first, "sha256").select(
        "sha256", "path", "length", "modified",
        F.when(is_new, NEW).otherwise(REPEATED).alias("status"),
        F.coalesce("_before", "_first.path").alias("first_path"),
    )


def register_deliveries(spark: SparkSession, landed: str, register: str, checkpoint: str, stream: str) -> None:
    """Add what has landed since the last call to the register, then stop.

    ``stream`` names the checkpoint in the register: a batch that Spark repeats after a failure replaces its own rows.  A new
    checkpoint needs a new name; so does one that an earlier version, with a keyed state, has written.
    """
    spark.dataSource.register(LandedFiles)

    def add(batch: DataFrame, number: int) -> None:
        own = (F.col("stream") == stream) & (F.col("batch") == number)
        known = _deliveries(batch.sparkSession, register).where(~own)
        found = by_content(materialise(batch, "landed"), known)
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{register}/stream={stream}/batch={number}")

    files = spark.readStream.format(SOURCE).load(landed)
    query = files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
