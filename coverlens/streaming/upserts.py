"""Incremental fact upserts, idempotent by batch number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from coverlens.operators.facts import upsert_fact
from coverlens.operators.grain import sum_to_grain
from coverlens.sources.datasets import PublishedTable


class BatchUpsert:
    """``foreachBatch`` target that merges batches into a published, period-partitioned table.

    The stream's name and the batch number go into the table's log with the load.  A
    batch that Spark repeats after a failure finds itself there and does nothing.  Each
    checkpoint numbers its batches from 0, so each needs a name of its own: two streams
    into one table, or a new checkpoint to process files again, must not share one.
    Only the periods of the batch are read and rewritten.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        grain: Sequence[str],
        measures: Sequence[str],
        part: str = "period_key",
        blank_is_null: Sequence[str] = (),
        accumulate: bool = False,
        *,
        stream: str,
    ):
        self.table = PublishedTable(spark, root, part)
        self.stream = stream
        self.spark, self.root, self.part = spark, root.rstrip("/"), part
        self.grain, self.measures = list(grain), list(measures)
        self.blank_is_null, self.accumulate = tuple(blank_is_null), accumulate

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        note = f"stream={self.stream} batch={batch_id}"
        if self.table.has_note(note):
            return
        staged = sum_to_grain(batch, self.grain, self.measures)
        # One short row per period of the batch.
        parts = [r[0] for r in batch.select(self.part).distinct().collect()]
        if not parts:
            return
        fact = self.table.read(parts)
        if fact is None:
            merged = staged
        elif self.accumulate:
            merged = sum_to_grain(fact.unionByName(staged), self.grain, self.measures)
        else:
            merged = upsert_fact(fact, staged, self.grain, self.measures, self.blank_is_null).drop("_action")
        self.table.write(merged, parts, note=note)

    def result(self) -> DataFrame | None:
        return self.table.read()
