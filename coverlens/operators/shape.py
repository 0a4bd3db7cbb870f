"""Column-set operators: required columns, renames, defaults, unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions import text


class LayoutError(ValueError):
    """The input does not have the columns the job needs."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise LayoutError(f"unexpected layout of {what}: missing columns {missing}, found {df.columns}")
    return df


def keep_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the mapped columns, under their new names; all of them must exist."""
    require_columns(df, names)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def rename_known(df: DataFrame, names: Mapping[str, str], required: Iterable[str] = ()) -> DataFrame:
    """Rename the mapped columns that exist; others keep their name.

    Where several existing columns map to one target, the first non-null wins.
    """
    sources: dict[str, list[str]] = {}
    for column in df.columns:
        sources.setdefault(names.get(column, column), []).append(column)
    order = {old: i for i, old in enumerate(names)}
    picked = []
    for target, origins in sources.items():
        origins = sorted(origins, key=lambda o: order.get(o, len(order)))
        value = F.col(f"`{origins[0]}`") if len(origins) == 1 else F.coalesce(*[F.col(f"`{o}`") for o in origins])
        picked.append(value.alias(target))
    return require_columns(df.select(*picked), required)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that are absent."""
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.snake_name(c) for c in df.columns])


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip the named text columns that exist."""
    present = {c: text.strip(c) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def tokens_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the usual "no value" texts of delimited files into nulls."""
    names = list(columns) if columns else [f.name for f in df.schema if f.dataType.typeName() == "string"]
    return df.withColumns({c: text.tokens_to_null(F.col(f"`{c}`")) for c in names})


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def assert_absent(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail if a column that must not leave the raw layer is still there."""
    present = [c for c in columns if c in df.columns]
    if present:
        raise LayoutError(f"columns that must be dropped are still present: {present}")
    return df
