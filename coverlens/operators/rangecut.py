"""Groups of any size in order: one range shuffle, running places inside the tasks, carried over the tasks' borders.

Rows are sorted over all tasks by group, falling value and a hash of the row, so that neither a large group nor many equal
values stay in one task.  Each task numbers its rows as it streams over them; two short rows a task tell what crosses its borders, and the driver
adds them up, one step per task.  The sorted rows are written, so the input is read once and a lost executor repeats only its own tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library

# Added by a task: its number, whether it is the task's first or last row, whether its group may have begun before the
# task, and its place, the place of the first equal value and the number of greater values within the task's part of the group.
MARKS = ("_task", "_first", "_final", "_open", "_row", "_tie", "_step")
MARK_TYPES = "_task int, _first boolean, _final boolean, _open boolean, _row long, _tie long, _step long"


def _changes(column: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Where a value differs from the one before it; missing values are alike, so are values that are not numbers."""
    if before is None:
        out = np.ones(len(column), bool)
        if len(column) > 1:
            out[1:] = _changes(column.slice(1), column.slice(0, len(column) - 1))
        return out
    if len(before) != len(column):
        before = pa.concat_arrays([before, column.slice(0, len(column) - 1)])
    same = pc.fill_null(pc.equal(column, before), False)
    same = pc.or_(same, pc.and_(pc.is_null(column), pc.is_null(before)))
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.and_(pc.fill_null(pc.is_nan(column), False), pc.fill_null(pc.is_nan(before), False)))
    return ~same.to_numpy(zero_copy_only=False)


def number_rows(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Add the marks to the sorted rows of a task; the first ``groups`` columns are the group, the next one the value."""
    task = TaskContext.get().partitionId()
    last: list[pa.Array] | None = None
    seen, row, tie, step = 0, -1, 0, 0
    filled = (b for b in batches if b.num_rows)
    batch = next(filled, None)
    while batch is not None:
        later = next(filled, None)
        n = batch.num_rows
        keys = [batch.column(i) for i in range(groups + 1)]
        changed = [_changes(c, None if last is None else last[i]) for i, c in enumerate(keys)]
        starts = np.logical_or.reduce(changed[:-1])
        steps = starts | changed[-1]
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(starts, at, -1))
        rows = np.where(start >= 0, at - start, at + row + 1)
        first_equal = np.maximum.accumulate(np.where(steps, at, -1))
        ties = np.where(first_equal >= 0, rows[np.maximum(first_equal, 0)], tie)
        counted = np.cumsum(steps)
        places = np.where(start >= 0, counted - counted[np.maximum(start, 0)], counted + step)
        group = seen + np.cumsum(starts)
        marks = [
            pa.array(np.full(n, task, np.int32)), pa.array((at == 0) & (last is None)), pa.array((at == n - 1) & (later is None)),
            pa.array(group == 1), pa.array(rows), pa.array(ties), pa.array(places),
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, *marks], names=[*batch.schema.names, *MARKS])
        last = [c.slice(n - 1) for c in keys]
        seen, row, tie, step = int(group[-1]), int(rows[-1]), int(ties[-1]), int(places[-1])
        batch = later


def _alike(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))


def _carried(edges: list, by: Sequence[str], value: str) -> list[tuple[int, int, int, int | None]]:
    """(task, rows, steps, tie) that each task's first group has before the task; ``tie`` if its first value began there too."""
    first = {e["_task"]: e for e in edges if e["_first"]}
    final = {e["_task"]: e for e in edges if e["_final"]}
    out = []
    group = held = None
    rows = steps = tie = 0
    for task in sorted(first):
        opening, closing = first[task], final[task]
        goes_on = group is not None and _alike(group, tuple(opening[c] for c in by))
        equal = goes_on and _alike((held,), (opening[value],))
        before = rows if goes_on else 0
        above = steps + (0 if equal else 1) if goes_on else 0
        out.append((task, before, above, tie if equal else None))
        if closing["_open"]:
            tie = tie if equal and closing["_step"] == 0 else before + closing["_tie"]
            rows, steps = before + closing["_row"] + 1, above + closing["_step"]
        else:
            rows, steps, tie = closing["_row"] + 1, closing["_step"], closing["_tie"]
        group, held = tuple(closing[c] for c in by), closing[value]
    return out


def ranked_in_order(df: DataFrame, by: Sequence[str], value: str, rank: str, dense_rank: str) -> DataFrame:
    """Add the rank and the dense rank by falling value within the groups; missing values come last."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in df.columns if c not in (*by, value)]
    spread = F.xxhash64(*[f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, T.MapType | T.VariantType)])
    order = [*[F.col(f"`{c}`") for c in by], F.col(f"`{value}`").desc(), spread]
    keys = [c for c in by if c != value]
    shown = df.select(*[F.col(f"`{c}`") for c in (*keys, value, *names)])
    schema = T.StructType([*shown.schema.fields, *T.StructType.fromDDL(MARK_TYPES).fields])
    groups = len(keys)
    sorted_rows = shown.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    cut = materialise(sorted_rows.mapInArrow(lambda batches: number_rows(batches, groups), schema), "range-cut")
    edges = cut.where("_first or _final").select(*keys, value, *MARKS).collect()  # two rows a task
    borders = df.sparkSession.createDataFrame(_carried(edges, keys, value), "_task int, _rows long, _steps long, _held long")
    placed = cut.join(F.broadcast(borders), "_task")  # one row a task
    inherits = F.col("_open") & (F.col("_step") == 0) & F.col("_held").isNotNull()
    tie = F.when(inherits, F.col("_held")).when(F.col("_open"), F.col("_rows") + F.col("_tie")).otherwise(F.col("_tie"))
    step = F.when(F.col("_open"), F.col("_steps") + F.col("_step")).otherwise(F.col("_step"))
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns], (tie + 1).cast("int").alias(rank), (step + 1).cast("int").alias(dense_rank)
    )
