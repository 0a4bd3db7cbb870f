"""Frame profile: counts, most frequent values, exact quantiles, outliers, correlation.

Nothing here gathers a column's values in one task: texts are counted by value
first, and quantiles are found by counting values by ever longer prefixes of their bits.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
QUARTILES = (0.25, 0.5, 0.75)
DIGIT = 16  # bits of a pass of the selection


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.simpleString().split("(")[0] in NUMERIC]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() == "string"]


def _long(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(cast).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*entries)))


def profile_texts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: non-null rows, distinct values, most frequent value and its count."""
    values = _long(df, columns or text_columns(df), "string")
    counted = values.groupBy("column", "value").agg(F.count("value").alias("n"))
    best = F.struct(F.col("n"), F.col("value"))
    return counted.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("value").alias("unique"),
        # Most frequent first, then the smallest text, so the answer is repeatable.
        F.min_by("value", F.struct(-best["n"], best["value"])).alias("top"),
        F.max("n").alias("freq"),
    )


def with_ordered_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a double as a whole number of 64 bits in the same order: its bits, negative for negative values.

    Exponent and mantissa come from exact divisions by powers of two.  Both zeros are one key, not-a-number is the highest.
    The steps are columns of their own, so the logarithm and the power are taken once a value.
    """
    size = F.abs(F.col(value))
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)).cast("int")
    staged = df.withColumn("_guess", guess).withColumn("_power", F.pow(F.lit(2.0), F.col("_guess")))
    low, high = F.col("_power") > size, F.col("_power") * 2 <= size  # the logarithm may be one off
    exponent = F.col("_guess") - low.cast("int") + high.cast("int")
    power = F.col("_power") * F.when(low, 0.5).when(high, 2.0).otherwise(1.0)
    special = F.lit(2047 << 52)
    bits = (
        F.when(F.isnan(value), special + F.lit(1 << 51))
        .when(size == float("inf"), special)
        .when(size < F.lit(2.0**-1022), (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .otherwise(F.shiftleft((exponent + 1023).cast("long"), 52) + ((size / power - 1.0) * F.lit(2.0**52)).cast("long"))
    )
    return staged.withColumn(name, F.when(F.col(value) < 0, -bits).otherwise(bits)).drop("_guess", "_power")


def value_of_key(key: int) -> float:
    size = struct.unpack(">d", abs(key).to_bytes(8, "big"))[0]
    return -size if key < 0 else size


def select_ranks(df: DataFrame, wanted: Mapping[str, Callable[[int], Sequence[int]]]) -> dict[str, dict[int, float]]:
    """Exact order statistics: per column, the values at the ranks (from 0) that its function names for the number of values.

    Radix selection: a pass counts values by the next ``DIGIT`` bits of their ordered keys, only among values that share the bits
    found so far with a wanted rank.  Once those are no more than the prefixes of a pass, the next pass takes all bits that are left.  Counts
    combine within tasks, so no value is shuffled or sorted, and four passes suffice whatever the data.  The driver gets one row per
    prefix that occurs: 2 to the power of ``DIGIT`` per column and open prefix at most.
    """
    names = list(wanted)
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    # Per column: prefix -> (values before it, ranks in it); the whole column is one prefix at first.
    spans: dict[str, dict[int, tuple[int, list[int] | None]]] = {c: {0: (0, None)} for c in names}
    known, left = 64, None  # bits that are not found yet, values that share the found ones
    while opened := [c for c in names if spans[c]]:
        shift = 0 if left is not None and left <= 1 << DIGIT else known - DIGIT
        entries = [F.struct(F.lit(names.index(c)).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in opened]
        # Keys are made after the columns stand below each other, so the generated code holds them once.
        values = df.select(F.inline(F.array(*entries))).where("value is not null")
        keys = with_ordered_key(values, "value", "key").drop("value")
        if known < 64:
            inside = F.lit(False)
            for c in opened:
                inside = inside | ((F.col("column") == names.index(c)) & F.shiftright("key", known).isin(list(spans[c])))
            keys = keys.where(inside)
        counted = keys.groupBy("column", F.shiftright("key", shift).alias("prefix"))
        rows = counted.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        groups: dict[tuple[int, int], list] = {}
        for r in rows:
            above = 0 if known == 64 else r["prefix"] >> (known - shift)
            groups.setdefault((r["column"], above), []).append(r)
        known, left = shift, 0
        for c in opened:
            later: dict[int, tuple[int, list[int] | None]] = {}
            for prefix, (before, ranks) in spans[c].items():
                parts = sorted(groups.get((names.index(c), prefix), ()), key=lambda r: r["prefix"])
                if ranks is None:
                    total = sum(r["n"] for r in parts)
                    ranks = sorted(set(wanted[c](total))) if total else []
                for r in parts:
                    here = [k for k in ranks if before <= k < before + r["n"]]
                    if here and r["low"] == r["high"]:
                        found[c].update(dict.fromkeys(here, value_of_key(r["low"])))
                    elif here:
                        later[r["prefix"]] = (before, here)
                        left += r["n"]
                    before += r["n"]
            spans[c] = later
    return found


def _quantiles(df: DataFrame, names: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float]]:
    totals: dict[str, int] = {}

    def ranks_of(name: str) -> Callable[[int], list[int]]:
        def ranks(total: int) -> list[int]:
            totals[name] = total
            return [k for p in probabilities for k in (math.floor((total - 1) * p), math.ceil((total - 1) * p))]

        return ranks

    found = select_ranks(df, {c: ranks_of(c) for c in names})
    out = {}
    for c in (c for c in names if found[c]):
        places = [(totals[c] - 1) * p for p in probabilities]
        low, high = ([found[c][f(at)] for at in places] for f in (math.floor, math.ceil))
        out[c] = [a if a == b else a + (b - a) * (at - math.floor(at)) for a, b, at in zip(low, high, places, strict=True)]
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str] | None = None, probabilities: Sequence[float] = QUARTILES
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per column that has values, ``quantiles`` in order.

    See ``select_ranks``: up to four passes over the frame, so hand over a written one where it is costly.
    """
    rows = list(_quantiles(df, list(columns or numeric_columns(df)), probabilities).items())
    return df.sparkSession.createDataFrame(rows, "column string, quantiles array<double>")


def profile_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min, quartiles, max."""
    names = list(columns or numeric_columns(df))
    basics = []
    for i, c in enumerate(names):
        v = F.col(f"`{c}`").cast("double")
        basics += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    quartiles = _quantiles(df, names, QUARTILES)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{m}{i}").alias(n) for m, n in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"))],
            *[F.lit(quartiles[c][k] if c in quartiles else None).cast("double").alias(q) for k, q in enumerate(("q25", "q50", "q75"))],
            F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(names)
    ]
    return df.agg(*basics).select(F.inline(F.array(*entries)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, from one aggregation."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*entries)))


def upper_fence(df: DataFrame, column: str, factor: float = 1.5) -> Column:
    """Third quartile plus ``factor`` interquartile ranges; null without values."""
    found = exact_quantiles(df, [column], (0.25, 0.75)).first()
    if found is None:
        return F.lit(None).cast("double")
    low, high = found["quantiles"]
    return F.lit(high + (high - low) * factor)


def above_fence(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """The rows beyond the upper fence."""
    return df.where(F.col(column).cast("double") > upper_fence(df, column, factor))


def correlation(df: DataFrame, a: str, b: str, name: str = "correlation") -> DataFrame:
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name))
