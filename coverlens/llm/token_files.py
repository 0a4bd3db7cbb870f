"""Token ids as flat binary files.

A dataset is a folder of ``NNNNN.bin`` (unsigned little-endian ids, one document after another, each closed by an end id;
16 bits wide if every id of the vocabulary and the end id fit, else 32), ``NNNNN.idx`` (64-bit document offsets within its .bin,
counted in ids, one more than documents), ``NNNNN.ids`` (the documents' ids, each with a 1, or 0 and a 0 for a null one) and a manifest table of one row per file with its number of documents and ids, the
bytes of an id (``width``) and its base: how many ids the files before it hold.  Documents stand in
ascending ``doc_id`` order over all files; a document's global offset is its file's base plus its local one, so no pass
over ids is needed to place a file.

Null and empty texts are their end id alone.  Texts of equal ids stand in the order of a hash of the text.  An empty table gives an empty manifest.  Other columns are
ignored.  Null ids sort first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverlens.llm.files import FlatFile, mapped
from coverlens.llm.tokens import ID, encoder, groups
from coverlens.session import materialise, scratch_path

OFFSET = np.dtype("<i8")


def narrowest(largest: int) -> np.dtype:
    """The unsigned type of a file whose ids go up to ``largest``."""
    return np.dtype("<u2") if largest <= np.iinfo("<u2").max else ID


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) to ``folder`` and return the manifest: part, n_docs, n_tokens, width, base."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, flat, offsets, ids = encoder(tokenizer).encode, None, [0], [np.zeros((0, 2), OFFSET)]
        kind = narrowest(max(encoder(tokenizer).largest, end_id))
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in batches:
            if flat is None:
                flat = FlatFile(f"{folder}/{part:05d}.bin")
            texts = batch.column(1).to_pylist()
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids.append(np.stack([batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), known], axis=1).astype(OFFSET))
            for a, b in groups(texts):
                for found in encode(texts[a:b]):
                    flat.write(np.frombuffer(found, ID).astype(kind).tobytes() + end)
                    offsets.append(offsets[-1] + len(found) // ID.itemsize + 1)
        if flat is None:
            return
        flat.close()
        for name, values in (("idx", np.array(offsets, OFFSET)), ("ids", np.concatenate(ids))):
            beside = FlatFile(f"{folder}/{part:05d}.{name}")
            beside.write(values.tobytes())
            beside.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([len(offsets) - 1]), pa.array([offsets[-1]]), pa.array([kind.itemsize], pa.int32())],
            names=["part", "n_docs", "n_tokens", "width"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange(partitions, "doc_id") if partitions else rows.repartitionByRange("doc_id")
    # The order is total but for equal rows, so a repeated task writes the same files.
    parts = dealt.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(write, "part long, n_docs long, n_tokens long, width int")
    parts = materialise(parts, "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, one file a row of the manifest, from the mapped files."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, base, width in zip(frame["part"], frame["base"], frame["width"], strict=True):
                ids = mapped(f"{folder}/{part:05d}.bin", np.dtype(f"<u{width}"))
                at = mapped(f"{folder}/{part:05d}.idx", OFFSET)
                names = mapped(f"{folder}/{part:05d}.ids", OFFSET).reshape(-1, 2)
                for a in range(0, len(names), 10_000):
                    rows = range(a, min(a + 10_000, len(names)))
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.arrays.IntegerArray(names[rows.start : rows.stop, 0].copy(), names[rows.start : rows.stop, 1] == 0),
                            "start": base + np.asarray(at[rows.start : rows.stop]),
                            "n_tokens": np.diff(at[rows.start : rows.stop + 1]),
                            "ids_crc32": [zlib.crc32(ids[at[i] : at[i + 1]].astype(ID)) for i in rows],
                        }
                    )

    files = manifest.count()
    dealt = manifest.select("part", "base", "width").coalesce(1).repartition(max(files, 1))  # a file a task
    return dealt.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the files, by default to a fresh shared folder, and describe each document as read back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    manifest = materialise(write_token_files(docs, folder, tokenizer, end_id), "token-manifest")
    return read_token_files(spark, folder, manifest)
