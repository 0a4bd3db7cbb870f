"""Benchmark decontamination: n-gram seeds, a bound on words, then Smith-Waterman alignment.

Test items and texts are words of letters and digits, lower-cased.  Every run of ``SEED`` words of an item is a seed (shorter items: all their
words), however common it is.  One pass finds seeds in the texts and joins the passages around them to their items.  A passage that holds too few of
the item's words to reach the threshold is passed over (the alignment cannot score more than its equal words); the others are aligned word by word (local
alignment, match 2, mismatch and gap -1), so edited copies score too.  The score is the best alignment's share of the item's own; ``LEAST`` or more is a
leak.  No frequency decides, so neither the number of texts nor how often an item leaked changes what is found.  A copy of which no ``SEED`` words in a
row are left (an item of less than ``SEED`` words: not all of them) is not found.

Items are processed in blocks of about ``BLOCK_CHARS`` characters: a block's seeds and words are what a task is sent, however large the benchmark; texts
are read once a block.  Nothing is shuffled.  Null and empty texts and items match nothing.  Repeated items each report;
repeated rows each get their rows.  Very long texts are searched whole.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.bytehash import ALPHANUMERIC, grams, words
from coverlens.llm.rows import ROW, text_hashes, without
from coverlens.session import materialise

SEED = 4
LEAST = 0.6
BLOCK_CHARS = 4_000_000
MATCH, OTHER, GAP = 2, -1, -1


class Seeds:
    """Sorted seed hashes of some items, with where each stands in them."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.items: list[np.ndarray] = []
        hashes, item, at = [], [], []
        for block in words(pa.array([t for _, t in items], pa.string()), ALPHANUMERIC):
            bounds = block.bounds()
            for k in range(block.rows):
                word = block.hash[bounds[k] : bounds[k + 1]]
                found = grams(word, min(SEED, len(word))) if len(word) else word
                hashes.append(found)
                item.append(np.full(len(found), len(self.items)))
                at.append(np.arange(len(found)))
                self.items.append(word)
        hash_, item_, at_ = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((hashes, np.uint64), (item, np.int64), (at, np.int64)))
        order = np.argsort(hash_, kind="stable")
        self.hash, self.item, self.at = hash_[order], item_[order], at_[order]
        self.keys = np.unique(self.hash)
        self.sizes = sorted({min(SEED, len(w)) for w in self.items if len(w)})
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, word position and key of every seed in a block of texts."""
        rows, places, keys = [], [], []
        for n in self.sizes:
            found = grams(block.hash, n)
            at = np.flatnonzero(self.filter[(found >> np.uint64(44)).astype(np.int64)])
            at = at[block.row[at] == block.row[at + n - 1]]
            key = np.minimum(np.searchsorted(self.keys, found[at]), max(len(self.keys) - 1, 0))
            sure = self.keys[key] == found[at] if len(self.keys) else np.zeros(0, dtype=bool)
            rows.append(block.row[at[sure]])
            places.append(at[sure])
            keys.append(key[sure])
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (rows, places, keys))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best local score, and the passage's words from and to."""
    n = len(passage)
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    slope = np.arange(n + 1) * -GAP
    best = (0, 0, 0)
    for word in item:
        fit = np.where(passage == word, MATCH, OTHER)
        diagonal, above = score[:-1] + fit, score[1:] + GAP
        inner = np.maximum(np.maximum(diagonal, above), 0)
        begins = np.where(inner == 0, np.arange(1, n + 1), np.where(diagonal >= above, start[:-1], start[1:]))
        flat = np.r_[0, inner] + slope
        # A gap along the passage: the best so far, less its length.
        top = np.maximum.accumulate(flat)
        from_ = np.maximum.accumulate(np.where(flat == top, np.arange(n + 1), 0))
        score = top - slope
        start = np.r_[0, begins][from_]
        at = int(np.argmax(score))
        if score[at] > best[0]:
            best = (int(score[at]), int(start[at]), at)
    return best


def _leaks(seeds: Seeds, block, least: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, first word, last word) of the best alignment of each pair that reaches the threshold."""
    rows, places, keys = seeds.hits(block)
    bounds = block.bounds()
    first, last = np.searchsorted(seeds.hash, seeds.keys[keys]), np.searchsorted(seeds.hash, seeds.keys[keys], side="right")
    spans: dict[tuple[int, int], list] = defaultdict(list)
    for row, place, a, b in zip(rows.tolist(), places.tolist(), first.tolist(), last.tolist(), strict=True):
        for k in range(a, b):
            item = int(seeds.item[k])
            long, at = len(seeds.items[item]), int(seeds.at[k])
            slack = long // 2 + 2  # words that an edited copy may have more
            spans[row, item].append((max(place - at - slack, int(bounds[row])), min(place - at + long + slack, int(bounds[row + 1]))))
    for (row, item), windows in sorted(spans.items()):
        windows.sort()
        best, (a, b) = (0.0, 0, 0), windows[0]
        for c, d in [*windows[1:], (1 << 62, 0)]:
            if c <= b and d - a <= 8 * len(seeds.items[item]) + 64:
                b = max(b, d)
                continue
            words_, passage = seeds.items[item], block.hash[a:b]
            if np.isin(words_, passage).sum() / len(words_) >= least:  # else no alignment can reach the threshold
                found, x, y = align(words_, passage)
                share = found / (MATCH * len(words_))
                if share > best[0]:
                    best = (share, a + x - int(bounds[row]), a + y - int(bounds[row]))
            a, b = c, d
        if best[0] >= least and best[0] > 0:
            yield row, item, *best


def _block(docs: DataFrame, items: list[tuple[int, str]], least: float) -> DataFrame:
    chosen = docs.select(F.col("doc_id").cast("long"), "text", *text_hashes())
    kept = docs.sparkSession.sparkContext.broadcast(Seeds(items))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, h, g = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for block in words(batch.column(1), ALPHANUMERIC):
                found = []
                for r, i, s, a, b in _leaks(kept.value, block, least):
                    row = block.first + r
                    found.append((ids[row], h[row], g[row], kept.value.ids[i], s, a, b))
                columns = list(zip(*found, strict=True)) or [[]] * 7
                kinds = (*[pa.int64()] * 4, pa.float64(), pa.int64(), pa.int64())
                names = [*ROW, "item_id", "score", "first_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    found = materialise(chosen.mapInArrow(search, f"doc_id long, h long, g long, {FOUND}"), "leaks")
    kept.destroy()  # one block's seeds are held at a time
    return found


FOUND = "item_id long, score double, first_word long, end_word long"


def _found(docs: DataFrame, benchmark: DataFrame, least: float) -> DataFrame:
    items = benchmark.where(F.length("text") > 0).select(F.col("item_id").cast("long"), "text")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // BLOCK_CHARS)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    parts = [
        _block(docs, [(r["item_id"], r["text"]) for r in dealt.where(F.col("block") == b).orderBy("item_id", "text").collect()], least)
        for b in range(blocks)
    ]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"doc_id long, h long, g long, {FOUND}")
    return reduce(DataFrame.unionByName, parts)


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): the passage of each text that best aligns with each leaked item."""
    return _found(docs, benchmark, least).drop("h", "g")


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows whose text holds no leaked item; another text under the same id stays, null ids are judged like others."""
    return without(docs, _found(docs, benchmark, least))
