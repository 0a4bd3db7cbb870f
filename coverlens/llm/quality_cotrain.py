"""Quality scores by co-training two views of a document.

The content view sees counts of the text (characters by kind, words, lines, repetition, common byte pairs); the metadata view sees the
page's data (source, language, recorded length) and nothing of the text.  Each is a logistic regression.  Both start from the
labelled rows of a bounded sample; over ``ROUNDS`` rounds each adds the ``EXCHANGED`` unlabelled rows it is surest of, in the labels' proportion, to the
other's training rows, if it is surer than ``CONFIDENT``.  Each view is then calibrated on labelled rows kept out of training
(Platt scaling), and a document's log-odds are the calibrated ones' sum less the prior counted twice, each weighted by
its information on those rows.

The sample: at most ``LABELLED`` labelled and ``UNLABELLED`` other ids in the order of a hash of the id, of texts of at most ``CHARS`` characters.
Every row and its whole text is scored.  Null and empty texts have zero content counts; null metadata is a value of its own.  Without labels of both kinds every score is the share
of good labels (0.5 if none).  Repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.bytehash import ALPHANUMERIC, LETTERS, NOT_SPACE, blocks, mix, table, text_bytes, words
from coverlens.llm.sampling import drawn

LABELLED, UNLABELLED = 4000, 8000
CHARS = 20_000  # longer texts are not drawn into the sample
ROUNDS, EXCHANGED, CONFIDENT = 5, 200, 0.9
PAIRS = 64  # hashed byte pairs of the content view
BUCKETS = 128  # hashed metadata values
KINDS = (
    LETTERS, table(b"0123456789"), table(bytes(range(65, 91))), ~NOT_SPACE, table(b".,;:?"), table(b"!"),
    ~ALPHANUMERIC & NOT_SPACE, table(b"\n"), table(bytes(range(128, 256))),
)
CONTENT = len(KINDS) + 5 + PAIRS
_PAIR = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.int64)


def content(column: pa.Array) -> np.ndarray:
    """The content view of each text."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(column), CONTENT), np.float32)
    for first, last in blocks(offsets):
        at = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        row = np.repeat(np.arange(last - first), np.diff(at))
        n = np.maximum(np.diff(at), 1)
        bytes_of = np.bincount(row * 256 + part, minlength=(last - first) * 256).reshape(-1, 256)
        code = _PAIR[part[:-1].astype(np.int64) * 256 + part[1:]] if len(part) > 1 else np.zeros(0, np.int64)
        pairs = np.bincount(row[: len(code)] * PAIRS + code, minlength=(last - first) * PAIRS).reshape(-1, PAIRS)
        out[first:last, : len(KINDS)] = bytes_of @ np.stack(KINDS, axis=1).astype(float) / n[:, None]
        out[first:last, len(KINDS) + 5 :] = np.sqrt(pairs / n[:, None])
    for block in words(column, NOT_SPACE):
        n = np.maximum(np.bincount(block.row, minlength=block.rows), 1)
        length = (block.end - block.start).astype(float)
        mean = np.bincount(block.row, length, block.rows) / n
        deviation = np.sqrt(np.maximum(np.bincount(block.row, length * length, block.rows) / n - mean * mean, 0))
        _, once = np.unique(mix(block.hash + block.row.astype(np.uint64)), return_index=True)
        single = np.bincount(block.row, length == 1, block.rows) / n
        extra = [np.log1p(n) / 10, mean / 10, deviation / 10, np.bincount(block.row[once], minlength=block.rows) / n, single]
        out[block.first : block.first + block.rows, len(KINDS) : len(KINDS) + 5] = np.stack(extra, axis=1)
    return out


def metadata(frame: pd.DataFrame) -> np.ndarray:
    """The metadata view of each row: hashed source and language, and the recorded length."""
    out = np.zeros((len(frame), BUCKETS + 2), np.float32)
    for column in ("source", "lang"):
        for i, value in enumerate(frame[column]):
            out[i, xxhash.xxh3_64_intdigest(f"{column}={value if isinstance(value, str) else ''}") % BUCKETS] += 1
    size = frame["n_chars"].to_numpy(dtype=float, na_value=np.nan)
    out[:, BUCKETS] = np.log1p(np.clip(np.nan_to_num(size), 0, None)) / 10
    out[:, BUCKETS + 1] = np.isnan(size)
    return out


@dataclass
class View:
    """A logistic regression over standardised features, with its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    trust: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


def _chance(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> tuple[np.ndarray, float]:
    """Newton's method with a ridge on the weights."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _chance(z @ w)
        hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _fit_view(x: np.ndarray, y: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    weights, bias = regression((x - mean) / scale, y)
    return View(mean, scale, weights, bias)


def co_train(views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> list[View]:
    """Fit both views; rows of ``pool`` have no labels."""
    kept_out = np.arange(len(y)) % 4 == 0
    if len(set(y[kept_out])) < 2 or len(set(y[~kept_out])) < 2:
        kept_out = np.zeros(len(y), dtype=bool)
    base = y[~kept_out].mean()
    xs, ys = [v[~kept_out] for v in views], [y[~kept_out], y[~kept_out]]
    free = [np.ones(len(pool[0]), dtype=bool) for _ in views]
    fitted = [_fit_view(x, t) for x, t in zip(xs, ys, strict=True)]
    for _ in range(ROUNDS):
        given = False
        for k, other in ((0, 1), (1, 0)):
            p = _chance(fitted[k].raw(pool[k]))
            for label, sure, most in ((1.0, p, round(EXCHANGED * base)), (0.0, 1 - p, round(EXCHANGED * (1 - base)))):
                best = np.argsort(-np.where(free[other], sure, -1), kind="stable")[:most]
                best = best[free[other][best] & (sure[best] >= CONFIDENT)]
                free[other][best] = False
                given = given or len(best) > 0
                xs[other] = np.concatenate([xs[other], pool[other][best]])
                ys[other] = np.concatenate([ys[other], np.full(len(best), label)])
        if not given:
            break
        fitted = [_fit_view(x, t) for x, t in zip(xs, ys, strict=True)]
    judged = kept_out if kept_out.any() else np.ones(len(y), dtype=bool)
    for view, x in zip(fitted, views, strict=True):
        weights, view.shift = regression(view.raw(x[judged])[:, None], y[judged], ridge=0.1)
        view.slope = max(float(weights[0]), 0.0)
        p = np.clip(_chance(view.log_odds(x[judged])), 1e-6, 1 - 1e-6)
        prior = np.clip(y[judged].mean(), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[judged] * np.log(p) + (1 - y[judged]) * np.log(1 - p))
        entropy = -(prior * np.log(prior) + (1 - prior) * np.log(1 - prior))
        view.trust = float(np.clip(1 - loss / entropy, 0, 1))
    return fitted


def combined(fitted: list[View], views: list[np.ndarray], base: float) -> np.ndarray:
    prior = np.log(np.clip(base, 1e-6, 1 - 1e-6) / np.clip(1 - base, 1e-6, 1))
    most = max(max(v.trust for v in fitted), 1e-6)
    return _chance(prior + sum(v.trust / most * (v.log_odds(x) - prior) for v, x in zip(fitted, views, strict=True)))


COLUMNS = ("doc_id", "text", "source", "lang", "n_chars")


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    kinds = docs.where("doc_id is not null").select("doc_id").distinct().join(known, "doc_id", "left")
    # Quality -1 is no label.
    kinds = kinds.select("doc_id", F.coalesce("quality", F.lit(-1)).cast("int").alias("quality"), F.col("quality").isNotNull().alias("marked"))
    return drawn(docs, kinds, "marked", {True: LABELLED, False: UNLABELLED}, list(COLUMNS), 0, CHARS)


def _fitted(sample: DataFrame) -> tuple[list[View] | None, float]:
    """Both views and the share of good labels; one task fits them, as the sample is bounded, and only the model leaves it."""

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=[*COLUMNS, "quality", "nth"])])
        rows = rows.sort_values(["nth", "doc_id"], kind="stable")
        views = [content(pa.array(rows["text"], pa.string())), metadata(rows)]
        mark = (rows["quality"] >= 0).to_numpy(dtype=bool)
        y = rows["quality"].to_numpy(dtype=float)[mark]
        both = len(set(y)) == 2
        made = co_train([v[mark] for v in views], y, [v[~mark] for v in views]) if both else None
        yield pd.DataFrame({"model": [pickle.dumps(made)], "base": [float(y.mean()) if len(y) else 0.5]})

    made = sample.coalesce(1).mapInPandas(fit, "model binary, base double").first()
    return (None, 0.5) if made is None else (pickle.loads(made["model"]), made["base"])


def quality_scores(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of each row of ``docs``: the chance of quality 1.  Labels count for the ids of ``labelled`` only."""
    allowed = labels.join(labelled.select("doc_id").distinct(), "doc_id", "left_semi")
    fitted, base = _fitted(_sample(docs, allowed))
    held = docs.sparkSession.sparkContext.broadcast(fitted)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if held.value is None:
                found = np.full(len(batch), base)
            else:
                page = batch.select(["source", "lang", "n_chars"]).to_pandas()
                found = combined(held.value, [content(batch.column("text")), metadata(page)], base)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *COLUMNS[1:]).mapInArrow(score, "doc_id long, score double")
