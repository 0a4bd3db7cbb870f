"""Language identification: known words first, character n-grams for the rest.

A word that the training texts hold often enough is scored by the logarithm of its share in each language.  Any other word falls
back to its character n-grams, longest first: of the first length at which it has a known n-gram, the mean score of those counts; a
word without any is passed over.  A text's language is the one of the largest sum; the score is that language's share
of the posterior with the sum tempered to ``EVIDENCE`` words, so that long texts are not all certain.

Fitted on a bounded sample: at most ``TRAIN_DOCS`` texts of each language in the order of a hash of their ids, whole texts of at most
``TRAIN_CHARS``.  Tables keep the ``VOCABULARY`` commonest words and n-grams of each length, so what is sent to tasks is bounded too.
All rows and whole texts are scored.  Texts that are null or without letters are ``und`` with score 0; so is every text if
nothing could be learned.  A text with letters but no known sign takes the commonest language.  Repeated rows score alike; other columns are
ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.bytehash import LETTERS, words
from coverlens.llm.sampling import thinning
from coverlens.llm.wordfeatures import char_grams, distinct

TRAIN_DOCS = 1000
TRAIN_CHARS = 20_000
VOCABULARY = 40_000
LENGTHS = (5, 4, 3, 2, 1)  # of n-grams, in bytes
LEAST = 3  # occurrences that make a word known
EVIDENCE = 12.0
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Table:
    """Sorted hashes and a row of language scores for each."""

    keys: np.ndarray
    scores: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the hashes, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: Table
    grams: dict[int, Table]

    def word_scores(self, block, chosen: np.ndarray) -> np.ndarray:
        """Scores of the chosen words; zero rows for words without a known sign."""
        out = np.zeros((len(chosen), len(self.languages)))
        rows = self.words.find(block.hash[chosen])
        out[rows >= 0] = self.words.scores[rows[rows >= 0]]
        left = np.flatnonzero(rows < 0)
        for n in LENGTHS:
            if not len(left):
                break
            hashes, owner = char_grams(block, chosen[left], n)
            rows = self.grams[n].find(hashes)
            owner, rows = owner[rows >= 0], rows[rows >= 0]
            known = np.bincount(owner, minlength=len(left))
            for k in range(len(self.languages)):
                total = np.bincount(owner, self.grams[n].scores[rows, k], len(left))
                out[left, k] = total / np.maximum(known, 1)
            left = left[known == 0]
        return out


def training_sample(labelled: DataFrame, most: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> DataFrame:
    """(text, lang): at most ``most`` texts of each language."""
    marked = labelled.where(F.col("lang").isNotNull())
    usable = marked.where(thinning(marked, "lang", most) & F.length("text").between(1, chars)).select("doc_id", "text", "lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return usable.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most).select("text", "lang")


def _counts(hashes: np.ndarray, lang: np.ndarray, languages: int, least: int) -> Table:
    keys, back = np.unique(hashes, return_inverse=True)
    counts = np.bincount(back * languages + lang, minlength=len(keys) * languages).reshape(-1, languages).astype(float)
    total = counts.sum(axis=1)
    keep = np.flatnonzero(total >= least)
    if len(keep) > VOCABULARY:
        keep = np.sort(keep[np.lexsort((keys[keep], -total[keep]))[:VOCABULARY]])
    share = (counts[keep] + 0.1) / (counts.sum(axis=0) + 0.1 * len(keys))
    scores = np.log(share)
    return Table(keys[keep], scores - scores.mean(axis=1, keepdims=True))


def fit(texts: list[str], langs: list[str]) -> Model | None:
    languages = sorted(set(langs))
    if not languages:
        return None
    of = np.array([languages.index(x) for x in langs])
    word, word_lang = [], []
    grams: dict[int, list] = {n: [] for n in LENGTHS}
    for block in words(pa.array(texts, pa.string()), LETTERS):
        lang = of[block.first + block.row]
        word.append(block.hash)
        word_lang.append(lang)
        # n-grams count once a distinct word of the block: common words are known as words.
        _, first, _ = distinct(block.hash + lang.astype(np.uint64))
        for n in LENGTHS:
            found, owner = char_grams(block, first, n)
            grams[n].append((found, lang[first][owner]))
    joined = {n: tuple(np.concatenate(x) for x in zip(*v, strict=True)) for n, v in grams.items()}
    return Model(
        languages,
        np.bincount(of, minlength=len(languages)) / len(of),
        _counts(np.concatenate(word), np.concatenate(word_lang), len(languages), LEAST),
        {n: _counts(h, x, len(languages), 1) for n, (h, x) in joined.items()},
    )


def has_letters(texts: list[str | None]) -> np.ndarray:
    return np.array([bool(t) and _LETTER.search(t) is not None for t in texts], dtype=bool)


def predict(model: Model | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    lettered = has_letters(column.to_pylist())
    lang, score = np.full(len(column), UNKNOWN, dtype=object), np.zeros(len(column))
    if model is None:
        return lang, score
    for block in words(column, LETTERS):
        _, first, back = distinct(block.hash)
        each = model.word_scores(block, first)
        known = np.any(each != 0, axis=1).astype(float)[back]
        sums = np.stack([np.bincount(block.row, each[back, k], block.rows) for k in range(each.shape[1])], axis=1)
        signs = np.bincount(block.row, known, block.rows)
        temper = np.minimum(1, EVIDENCE / np.maximum(signs, 1))
        logits = sums * temper[:, None] + np.log(model.prior)
        best = np.argmax(np.where(signs[:, None] > 0, sums, model.prior), axis=1)
        shares = np.exp(logits - logits.max(axis=1, keepdims=True))
        rows = slice(block.first, block.first + block.rows)
        lang[rows] = np.array(model.languages, dtype=object)[best]
        score[rows] = shares[np.arange(block.rows), best] / shares.sum(axis=1)
    return np.where(lettered, lang, UNKNOWN), np.where(lettered, score, 0.0)


def _fitted(sample: DataFrame) -> Model | None:
    """One task fits the model, as the sample is bounded, and only the model leaves it."""

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["text", "lang"])]).sort_values(["lang", "text"])
        yield pd.DataFrame({"model": [pickle.dumps(fit(rows["text"].tolist(), rows["lang"].tolist()))]})

    made = sample.coalesce(1).mapInPandas(learn, "model binary").first()
    return None if made is None else pickle.loads(made["model"])


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs`` (doc_id, text), learned from ``labelled`` (doc_id, text, lang)."""
    held = docs.sparkSession.sparkContext.broadcast(_fitted(training_sample(labelled)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, sure = predict(held.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(sure)], names=["doc_id", "lang_pred", "score"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, lang_pred string, score double")
