"""Prefix sums along linked lists that are spread over many tasks.

A list is a frame of ``LINK`` rows: an element (``conv``, ``pos``), the element after it (null for the last), and two weights.  Each element has
at most one predecessor.  Elements that follow each other within a task are joined to chains there (``contract``); what remains is halved
by rounds of coin tosses, in which an element that shows tails is spliced out by a predecessor that shows heads (``list_prefixes``),
until at most ``SOLO`` are left for one task; then the spliced ones get their sums back, round by round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.session import materialise

SOLO = 200_000
LINK = "conv long, pos long, next_conv long, next_pos long, leaf long, saved long"


def places(conv: np.ndarray, pos: np.ndarray, want_conv: np.ndarray, want_pos: np.ndarray) -> np.ndarray:
    """The row of each wanted (conv, pos), -1 if there is none."""
    if not len(conv) or not len(want_conv):
        return np.full(len(want_conv), -1, np.int64)
    names, code = np.unique(conv, return_inverse=True)
    wide = int(max(pos.max(), want_pos.max())) + 1
    key = code * wide + pos
    order = np.argsort(key)
    at = np.minimum(np.searchsorted(names, want_conv), len(names) - 1)
    wanted = at * wide + want_pos
    row = np.minimum(np.searchsorted(key[order], wanted), len(key) - 1)
    row = order[row]
    return np.where((names[at] == want_conv) & (want_pos >= 0) & (key[row] == wanted), row, -1)


def walk(after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element the first of its list and the sums up to and with it; ``after`` holds rows, -1 at an end."""
    before = np.full(len(after), -1, np.int64)
    linked = after >= 0
    before[after[linked]] = np.flatnonzero(linked)
    head, sums = np.arange(len(after)), weights.copy()
    while True:
        rows = np.flatnonzero(before >= 0)
        if not len(rows):
            return head, sums
        up = before[rows]
        sums[rows], head[rows], before[rows] = sums[rows] + sums[up], head[up], before[up]


def links(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> list[np.ndarray]:
    """A task's rows as arrays; a missing value is -1."""
    parts = [[b.column(n).fill_null(-1).to_numpy(zero_copy_only=False) for n in names] for b in batches]
    return [np.concatenate([np.zeros(0, np.int64), *[p[i] for p in parts]]).astype(np.int64) for i in range(len(names))]


def _solve(elements: DataFrame) -> DataFrame:
    """(conv, pos, leaf, saved): the sums before each element, in one task."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, pos, next_conv, next_pos, leaf, saved = links(batches, ("conv", "pos", "next_conv", "next_pos", "leaf", "saved"))
        own = np.stack([leaf, saved], axis=1)
        _, sums = walk(places(conv, pos, next_conv, next_pos), own)
        columns = [conv, pos, *(sums - own).T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["conv", "pos", "leaf", "saved"])

    return elements.coalesce(1).mapInArrow(solve, "conv long, pos long, leaf long, saved long")


def list_prefixes(elements: DataFrame, solo: int = SOLO) -> DataFrame:
    """(conv, pos, leaf, saved): the sums of the weights before each element of a written frame of ``LINK`` rows; written."""
    rounds = []
    left = elements.select("conv", "pos", "next_conv", "next_pos", "leaf", "saved")
    while left.count() > solo:
        # Each round moves at most half of what is left, and takes a quarter of it out on average.
        def tails(conv: str, pos: str, nth: int = len(rounds)):
            return F.xxhash64(F.lit(nth), conv, pos) % 2 != 0

        splices = ~tails("conv", "pos") & F.col("next_conv").isNotNull() & tails("next_conv", "next_pos")
        by = left.where(splices).select(
            F.col("conv").alias("by_conv"), F.col("pos").alias("by_pos"), F.col("next_conv").alias("conv"), F.col("next_pos").alias("pos"),
            F.col("leaf").alias("by_leaf"), F.col("saved").alias("by_saved"),
        )
        met = left.where(tails("conv", "pos")).join(by, ["conv", "pos"], "left")
        whole = left.where(~tails("conv", "pos") & ~splices)
        state = materialise(met.unionByName(whole, allowMissingColumns=True), "ranking-round")
        taken = F.col("by_conv").isNotNull()
        rounds.append(state.where(taken).select("conv", "pos", "by_conv", "by_pos", "by_leaf", "by_saved"))
        spliced = state.where(taken).select(
            F.col("by_conv").alias("conv"), F.col("by_pos").alias("pos"), "next_conv", "next_pos",
            (F.col("by_leaf") + F.col("leaf")).alias("leaf"), (F.col("by_saved") + F.col("saved")).alias("saved"),
        )
        left = state.where(~taken).select(*left.columns).unionByName(spliced)
    known = materialise(_solve(left), "ranking-solved")
    for taken in reversed(rounds):
        base = known.select(F.col("conv").alias("by_conv"), F.col("pos").alias("by_pos"), "leaf", "saved")
        back = taken.join(base, ["by_conv", "by_pos"]).select(
            "conv", "pos", (F.col("leaf") + F.col("by_leaf")).alias("leaf"), (F.col("saved") + F.col("by_saved")).alias("saved")
        )
        known = known.unionByName(materialise(back, "ranking-back"))
    return known
