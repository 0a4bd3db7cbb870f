"""The corpus pipeline: documents through toxicity, line and document deduplication, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written to the shared folder and
read back.  All but the last return the columns of documents.  Filters know a row by its id and text: a clean text stays though another
under its id goes, and rows without an id are judged like others.  An empty table stays empty; null texts pass every filter and
are packed as an end id.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from coverlens.llm.decontamination import without_leaks
from coverlens.llm.line_dedup import drop_repeated_lines
from coverlens.llm.ngram_join import keep_one
from coverlens.llm.packing import pack
from coverlens.llm.queries import WORD_TOKENIZER, table
from coverlens.llm.ship import ship
from coverlens.llm.toxicity import without_toxic
from coverlens.session import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not take for toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones."""
    return drop_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in training sequences."""
    ship(spark)
    return pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the network, the alignment or the tokens; each stage is tested against a plain version of it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
