"""Delimited text: fixed or detected separator, dated snapshots, export."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.operators.shape import stack_by_name, tokens_to_null
from coverlens.sources.storage import list_files, read_openings

SEPARATORS = (";", ",", "\t", "|")
SNIFFED = 1 << 16  # bytes of a file that are read to find its dialect
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library

# Where a row came from; ordering by the three is the order of the lines.
ORIGIN = ("_file", "_block", "_position")


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    separator: str = ";",
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """All columns as text, nothing inferred; the usual "no value" texts become null.

    Give ``columns`` to spare the read of the header.  Set ``multi_line`` to false
    where no field holds a line break: large files are then split over tasks.
    """
    reader = spark.read.option("header", True).option("sep", separator).option("encoding", "UTF-8")
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    rows = reader.csv(path)
    names = rows.columns
    placed = rows.select(
        *[F.col(f"`{c}`") for c in names],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
    )
    return tokens_to_null(placed, [f.name for f in rows.schema if f.dataType.typeName() == "string"])


def count_separators(line: Column | str, separators: Sequence[str] = SEPARATORS) -> Column:
    """The separator that occurs most often in a header line (first listed on a tie)."""
    c = F.col(line) if isinstance(line, str) else line
    counts = [F.struct((F.length(c) - F.length(F.replace(c, F.lit(s)))).alias("n"), F.lit(-i).alias("o"),
                       F.lit(s).alias("s")) for i, s in enumerate(separators)]
    return F.array_max(F.array(*counts))["s"]


def sniff(opening: bytes, whole: bool, separators: Sequence[str] = SEPARATORS) -> tuple[str, list[str]] | None:
    """(separator, names of the header) of a file's first bytes, None if they hold no line.

    Quoted separators and line breaks are no separators or ends of rows.  The separator under which most of the sampled rows have as many
    fields as the header wins, then the one with more fields, then the one listed first; the row that the sample
    cuts off does not count.
    """
    text = opening.decode("utf-8-sig", "replace")
    if not text.strip():
        return None
    best = None
    for order, separator in enumerate(separators):
        try:
            rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=separator) if r]
        except csv.Error:  # a quoted field that does not end here, a zero byte
            continue
        header, body = rows[0], rows[1:] if whole else rows[1:-1]
        alike = sum(len(r) == len(header) for r in body) / len(body) if body else 1.0
        score = (len(header) > 1, alike, len(header), -order)
        if best is None or score > best[0]:
            best = (score, separator, header)
    return best[1:] if best else None


def detect_separators(spark: SparkSession, path: str, pattern: str = "*.{csv,txt}", block: int = SNIFFED) -> DataFrame:
    """(file, header, separator) per file with a header; ``header`` holds the names.

    Tasks open each file and read its first ``block`` bytes, nothing else of it.
    """
    suffixes = re.fullmatch(r"\*\.\{(.*)\}", pattern)
    files = list_files(spark, path, "*" if suffixes else pattern)
    if suffixes:
        suffix = F.lower(F.element_at(F.split("path", "[.]"), -1))
        files = files.where(suffix.isin([s.lower() for s in suffixes[1].split(",")]))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, openings = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [sniff(o, n <= len(o)) for n, o in zip(lengths, openings, strict=True)]
            heads = pa.array([f and f[1] for f in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), heads, pa.array([f and f[0] for f in found], pa.string())], names=["file", "header", "separator"])

    opened = read_openings(files, block)
    return opened.mapInArrow(detect, "file string, header array<string>, separator string").where("separator is not null")


def read_detected(spark: SparkSession, path: str, pattern: str = "*.{csv,txt}") -> DataFrame:
    """Files of mixed separators and columns, matched by column name.

    Files with the same header are one scan, so the plan grows with the number of
    layouts, not of files.
    """
    found = detect_separators(spark, path, pattern).groupBy("separator", "header").agg(F.collect_list("file").alias("files"))
    layouts = [(r["separator"], r["header"], sorted(r["files"])) for r in found.collect()]
    if not layouts:
        raise FileNotFoundError(f"no delimited file with a header below {path}")
    return stack_by_name([read_delimited(spark, files, sep, header) for sep, header, files in sorted(layouts)])


def latest_snapshot(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot; the newest date is a scalar subquery, so other partitions are pruned."""
    newest = df.agg(F.max(column).alias("d")).scalar()
    return df.where(F.col(column) == newest)


def write_delimited(df: DataFrame, path: str, separator: str = ",", mark: bool = False) -> None:
    """Export with a header, UTF-8; quotes are doubled and no text is trimmed.  ``mark`` puts the byte-order mark first in each file."""
    if mark:
        first, *others = df.columns
        df = df.select(F.col(first).alias("\ufeff" + first), *others)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", separator)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
