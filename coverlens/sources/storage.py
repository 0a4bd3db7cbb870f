"""Files opened by tasks: listing without content, range reads, hashing in constant memory, writing.

Spark lists the files and deals them to tasks; a task opens its own by their path, so a file is never a row and has no size limit.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator
from fnmatch import fnmatch
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the place on it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlsplit(path).path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files below a path, empty ones too, whose name fits a pattern in either case.

    The driver lists the folders directly below the path; tasks list what lies in them, so file names stay with the tasks.  The
    path may end in wildcards for the names below a folder.
    """
    root, wild = path, "*"
    if "*" in path:
        root, rest = path[: path.index("*")].rsplit("/", 1)
        wild = f"*/{rest}{path[path.index('*') :]}*"
    system, place = locate(root)
    if system.get_file_info(place).type == fs.FileType.NotFound:
        raise FileNotFoundError(f"nothing at {root}")
    prefix = "file:" if isinstance(system, fs.LocalFileSystem) else f"{root.split('://', 1)[0]}://"

    def fits(file: fs.FileInfo) -> bool:
        name = file.path.rsplit("/", 1)[-1]
        hidden = name.startswith((".", "_")) or name.endswith(".partial")
        return file.is_file and not hidden and fnmatch(name.lower(), pattern.lower()) and fnmatch(file.path, wild)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, deep in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here, at = locate(folder)
                found = [f for f in here.get_file_info(fs.FileSelector(at, recursive=deep)) if fits(f)]
                columns = [pa.array([prefix + f.path for f in found], pa.string()), pa.array([f.size for f in found], pa.int64()),
                           pa.array([f.mtime for f in found], pa.timestamp("us", "UTC"))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "modificationTime"])

    below = system.get_file_info(fs.FileSelector(place))
    folders = [(root, False)] + [(prefix + f.path, True) for f in below if f.type == fs.FileType.Directory]
    tasks = spark.createDataFrame(folders, "path string, deep boolean").repartition(min(len(folders), 200))
    return tasks.mapInArrow(listed, "path string, length long, modificationTime timestamp")


def read_openings(files: DataFrame, size: int) -> DataFrame:
    """(path, length, opening): the first ``size`` bytes of each file; what follows is not read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, place = locate(path)
                with system.open_input_file(place) as file:
                    found.append(file.read(size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=["path", "length", "opening"])

    return _dealt(files.select("path", "length")).mapInArrow(read, "path string, length long, opening binary")


def with_sha256(files: DataFrame) -> DataFrame:
    """(path, length, modificationTime, sha256): each file is hashed block by block where it lies."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, place = locate(path)
                state = hashlib.sha256()
                with system.open_input_stream(place, compression=None) as file:
                    while block := file.read(BLOCK):
                        state.update(block)
                found.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["path", "length", "modificationTime", "sha256"])

    rows = _dealt(files.select("path", "length", "modificationTime"))
    return rows.mapInArrow(digest, "path string, length long, modificationTime timestamp, sha256 string")


def write_files(rows: DataFrame, folder: str) -> int:
    """Write each row (path, content) as a file below the folder; a repeated task replaces its files whole.  The number of files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                system, place = locate(f"{folder.rstrip('/')}/{path.as_py()}")
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                partial = f"{place}.{uuid.uuid4().hex}.partial"
                with system.open_output_stream(partial, compression=None) as file:
                    file.write(content.as_py() or b"")
                system.move(partial, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    written = rows.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(write, "files long")
    return written.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def _dealt(files: DataFrame) -> DataFrame:
    """Files dealt to tasks by their names: a scan of a listing would leave many small files to a few tasks."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("path"))
