"""Packing documents into sequences by minimum bin slack.

Documents become token ids and an end id; only those longer than a sequence are cut.  Which pieces share a sequence depends
on lengths alone, so the plan is made from the histogram of lengths (at most ``capacity`` numbers, whatever the input).
Per sequence the longest length left is placed, and subset sums of the lengths left, kept as a bit set, give the
fullest combination with it; that combination is taken out as often as the histogram has it.  Each step uses up a length, so
the plan has at most ``capacity`` patterns.  Pieces then find their place by their rank among those of their length:
ranks are counted per task, and a task's start comes from counts per (length, task).  No length's pieces meet in one task.

Null and empty texts are one end id.  Ties, repeated rows and repeated ids are pieces of their own.  An empty table
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.tokens import ID, encoder, groups
from coverlens.session import materialise

CAPACITY = 4096


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, none more often than it is there, whose sum is the largest that fits: subset sums in a bit set."""
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, lot = min(counts[length], room // length), 1
        while left:
            lot = min(lot, left)
            steps.append((length, lot, reached))
            reached |= (reached << (length * lot)) & mask
            left, lot = left - lot, lot * 2
        if reached >> room & 1:
            break
    total, taken = reached.bit_length() - 1, []
    for length, lot, before in reversed(steps):
        if not before >> total & 1:  # only with this lot
            taken += [length] * lot
            total -= length * lot
    return taken


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences), longest first."""
    left, patterns = {k: n for k, n in histogram.items() if n}, []
    while left:
        top = max(left)
        left[top] -= 1
        chosen = [top, *fullest({k: n for k, n in left.items() if n}, capacity - top)]
        left[top] += 1
        need = defaultdict(int)
        for length in chosen:
            need[length] += 1
        times = min(left[length] // n for length, n in need.items())
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        patterns.append((chosen, times))
    return patterns


def _slots(patterns: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length: rows of (first rank, first sequence, offset) in rank order."""
    slots, used, base = defaultdict(list), defaultdict(int), 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            slots[length].append((used[length], base, offset))
            used[length] += times
            offset += length
        base += times
    return {k: np.array(v, dtype=np.int64) for k, v in slots.items()}


def _pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces with their task and their rank among the task's pieces of the same length."""
    end = np.array([end_id], dtype=ID).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                rows = []
                for doc, found in zip(ids[a:b], encoder(tokenizer).encode(texts[a:b]), strict=True):
                    found = memoryview(found + end)
                    step = capacity * ID.itemsize
                    for piece, at in enumerate(range(0, len(found), step)):
                        part = found[at : at + step]
                        length = len(part) // ID.itemsize
                        rows.append((doc, piece, at // ID.itemsize, length, zlib.crc32(part), task, seen[length]))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, ", ".join(f"{n} long" for n in names))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece of ``docs`` (doc_id, text)."""
    pieces = materialise(_pieces(docs, tokenizer, end_id, capacity), "packing-pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("rows"))
    per_task = materialise(per_task, "packing-counts")
    lengths = per_task.groupBy("length").agg(F.sum("rows").alias("rows")).collect()  # at most ``capacity`` rows
    slots = docs.sparkSession.sparkContext.broadcast(_slots(plan({r["length"]: r["rows"] for r in lengths}, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("lead"))
    ranked = pieces.join(starts, ["length", "task"]).withColumn("rank", F.col("lead") + F.col("nth"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), dtype=np.int64)
        sizes, ranks = length.to_numpy(), rank.to_numpy()
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[order])) + 1
        for rows in np.split(order, edges) if len(order) else []:
            table = slots.value[int(sizes[rows[0]])]
            at = table[np.searchsorted(table[:, 0], ranks[rows], side="right") - 1]
            out[rows, 0] = at[:, 1] + ranks[rows] - at[:, 0]
            out[rows, 1] = at[:, 2]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("at", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
