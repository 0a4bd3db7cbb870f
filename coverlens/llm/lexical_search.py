"""Ranked lexical search: the terms of all items are looked for in the whole texts by one automaton, without an index of documents.

Terms are the longest runs of letters, digits and bytes beyond ASCII; only A-Z are lower-cased.  Items are dealt into blocks of at
most ``BLOCK_BYTES`` bytes of text (a longer item is a block of its own).  Per block the automaton of its terms, each guarded by a blank on
both sides so that it matches whole terms alone, is broadcast.  A first scan of the documents counts documents and terms, a second
one counts each text's terms again, maps the automaton's outputs to the items that hold them, sums the scores and keeps the best rows
of each item in the task.  The best of the tasks are then ranked, first within groups of tasks, then among all.

A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``, a document's measure ``m = 75 + 25 n N div L``, its score the sum of
``weight * (10^9 tf div (1000 tf + 12 m))`` over the item's terms, repeats included, in whole numbers.

Null and empty texts have no terms: such documents do not count and such items have no rows.  Rows of documents count one by one, also when they repeat
or share an id; a null id is kept and stands before others on ties.  Equal rows of items count once, other texts under the same id
are ranked apart.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverlens.session import materialise

BLOCK_BYTES = 1 << 22  # text of the items of one automaton
CELLS = 1 << 21  # scores held at once: documents times items
EXACT = 1 << 53  # sums below it are exact in doubles
FOLDS = 256  # groups of tasks whose best rows are ranked first
_TERM = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: Bytes of terms stay (A-Z lower-cased), all others become blanks.
CLEAN = bytes(c if c in _TERM else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(CLEAN).split()


def guarded(terms: list[bytes]) -> ahocorasick.Automaton:
    """An automaton over bytes that gives the place of each whole term it meets."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for place, term in enumerate(terms):
        automaton.add_word(f" {term.decode('latin-1')} ", place)
    automaton.make_automaton()
    return automaton


def occurrences(automaton: ahocorasick.Automaton, text: bytes) -> tuple[list[int], int]:
    """The places of the terms met in a text, with repeats, and the number of all its terms."""
    clean = text.translate(CLEAN)
    return [place for _, place in automaton.iter(f" {clean.decode('latin-1')} ")], len(clean.split())


def item_blocks(items: DataFrame) -> DataFrame:
    """(block, item_id, text) of the distinct items, written: blocks within a task's rows are cut at the bound."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            names = []
            for text in batch.column(1):
                size = len(text.as_py()) + 64
                if held and held + size > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += size
                names.append(f"{task}-{block}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *batch.columns], names=["block", "item_id", "text"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text <> ''").distinct()
    rows = rows.select("item_id", F.col("text").cast("binary").alias("text")).coalesce(8)
    return materialise(rows.mapInArrow(deal, "block string, item_id long, text binary"), "search-items")


class Postings:
    """The items' terms and, term by term, the items that hold them and how often."""

    def __init__(self, ids: list[int | None], texts: list[bytes]) -> None:
        self.ids = pa.array(ids, pa.int64())
        counts = [Counter(terms_of(text)) for text in texts]
        self.items = len(texts)
        self.longest = max((c.total() for c in counts), default=0)
        self.terms = sorted(set().union(*counts)) if counts else []
        place = {term: i for i, term in enumerate(self.terms)}
        flat = sorted((place[term], item, n) for item, c in enumerate(counts) for term, n in c.items())
        table = np.array(flat, np.int64).reshape(-1, 3)
        self.first = np.searchsorted(table[:, 0], np.arange(len(self.terms) + 1))
        self.item, self.times = table[:, 1], table[:, 2]


def _statistics(texts: DataFrame, automaton, size: int) -> tuple[int, int, np.ndarray]:
    """The number of documents with terms, of all their terms, and of documents that hold each term of the block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for text in batch.column(1):
                places, n = occurrences(automaton.value, text.as_py())
                holding[np.fromiter(set(places), np.int64)] += 1
                documents += n > 0
                total += n
        met = np.flatnonzero(holding)
        place = np.concatenate([met, [-1, -2]])
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.concatenate([holding[met], [documents, total]]))], names=["place", "n"])

    found = texts.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    known = {row["place"]: row["n"] for row in found.collect()}  # one row per term of the block
    held = np.array([known.get(i, 0) for i in range(size)], np.int64)
    return known.get(-1, 0), known.get(-2, 0), held


class Best:
    """The best rows of each item seen so far: highest score first, then null ids, then ascending ids."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(items, np.int64)  # a score below it cannot enter
        self.rows = np.zeros((4, 0), np.int64)  # item, -score, id is known, id

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        rows = np.stack([item, -scores[doc, item], known[doc].astype(np.int64), ids[doc]])
        rows = np.concatenate([self.rows, rows], axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        first = np.searchsorted(rows[0], rows[0])
        nth = np.arange(rows.shape[1]) - first
        self.rows = rows[:, nth < self.k]
        full = rows[:, nth == self.k - 1]
        self.least[full[0]] = -full[1]


def block_scores(hits: list[list[int]], lengths: np.ndarray, documents: int, total: int, weight: np.ndarray, index: Postings) -> np.ndarray:
    """The scores of some documents (rows) for all items of the block (columns)."""
    measure = np.array([75 + 25 * int(n) * documents // total if n else 0 for n in lengths], np.int64)
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    met = np.concatenate([np.zeros(0, np.int64), *[np.array(h, np.int64) for h in hits if h]])
    code, tf = np.unique(row * max(len(index.terms), 1) + met, return_counts=True)
    row, term = np.divmod(code, max(len(index.terms), 1))
    part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * measure[row]))
    n = index.first[term + 1] - index.first[term]
    out = np.zeros((len(hits), index.items), np.int64)
    exact = int(index.longest) * 1_000_000 * int(weight.max(initial=0)) < EXACT
    ends = np.cumsum(n)
    start = 0
    while start < len(term):  # as many terms at once as a bounded list of postings allows
        stop = max(int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CELLS, "right")), start + 1)
        size = n[start:stop]
        at = np.repeat(index.first[term[start:stop]] - np.cumsum(size) + size, size) + np.arange(size.sum())
        cell = np.repeat(row[start:stop], size) * index.items + index.item[at]
        value = np.repeat(part[start:stop], size) * index.times[at]
        if exact:
            out += np.bincount(cell, value, out.size).astype(np.int64).reshape(out.shape)
        else:
            np.add.at(out.reshape(-1), cell, value)
        start = stop
    return out


def _ranked_block(texts: DataFrame, block: list, k: int) -> DataFrame:
    """(item_no, item_id, doc_id, score): the best rows of the items of one block, written."""
    context = texts.sparkSession.sparkContext
    index = Postings([row["item_id"] for row in block], [bytes(row["text"]) for row in block])
    automaton = context.broadcast(guarded(index.terms))
    documents, total, held = _statistics(texts, automaton, len(index.terms))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in held], np.int64)
    shared = context.broadcast((index, weight))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, factors = shared.value
        best = Best(found.items, k)
        step = max(CELLS // max(found.items, 1), 1)
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                seen = [occurrences(automaton.value, text.as_py()) for text in part.column(1)]
                lengths = np.array([n for _, n in seen], np.int64)
                scores = block_scores([places for places, _ in seen], lengths, documents, total, factors, found)
                ids = part.column(0)
                best.add(scores, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False))
        item, score, known, doc = best.rows
        columns = [pa.array(item), found.ids.take(pa.array(item)), pa.array(doc, mask=known == 0), pa.array(-score)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_no", "item_id", "doc_id", "score"])

    found = texts.mapInArrow(scan, "item_no long, item_id long, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    # Each task brings its best k of each item; groups of tasks are ranked before all are, so no item meets all tasks' rows at once.
    found = found.withColumn("fold", F.pmod(F.spark_partition_id(), F.lit(FOLDS)))
    first = F.row_number().over(Window.partitionBy("item_no", "fold").orderBy(*order))
    found = found.withColumn("nth", first).where(F.col("nth") <= k).drop("nth", "fold")
    last = F.row_number().over(Window.partitionBy("item_no").orderBy(*order))
    ranked = found.withColumn("rank", last).where(F.col("rank") <= k)
    out = materialise(ranked.select("item_id", "rank", "doc_id", "score"), "search-block")
    for used in (automaton, shared):
        used.destroy()
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, text)."""
    texts = docs.where("text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    dealt = item_blocks(items)
    out = dealt.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for row in dealt.select("block").distinct().collect():  # one row per block of items
        out = out.unionByName(_ranked_block(texts, dealt.where(F.col("block") == row["block"]).collect(), k))
    return out
