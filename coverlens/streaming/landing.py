"""Each landed file once: the checkpoint of the file source is the register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    **options: object,
) -> DataFrame:
    """A stream of the files below a path; bound the batch size for a first run over a large backlog."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest_new_files(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append everything that has landed since the last call, then stop.

    The Parquet sink keeps its own commit log, so a batch that is repeated after a
    failure appears once.  Processing a file again needs a new checkpoint.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()


def each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``apply(batch, batch_id)`` on everything that has landed, then stop."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
