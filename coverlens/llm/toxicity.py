"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

Inputs are words: a learned vector by the word's hash plus learned vectors of its character n-grams (their sum over the root of their number), so
unseen words are read by their characters.  A text is read in overlapping windows of ``WINDOW`` words, ``STRIDE`` apart, the whole text
through; a window's states of both directions are pooled by attention into one logit, and the text's score is that of its worst window.
Training is plain numpy with Adam on a bounded sample of labelled texts: the worst windows of a text carry its label.

The sample: at most ``TRAIN_DOCS`` texts in the order of a hash of their ids, half of them toxic if there are enough, none longer than
``TRAIN_CHARS``.  Everything else covers all rows and whole texts.  Null and empty texts have one empty window and get the score of
no words; without labels of both kinds every score is the share of toxic labels (0 if none).  Repeated rows score alike.
Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.bytehash import LETTERS, words
from coverlens.llm.rows import ROW, text_hashes, without
from coverlens.llm.sampling import drawn
from coverlens.llm.wordfeatures import char_grams, distinct

TRAIN_DOCS = 4000
TRAIN_CHARS = 12_000
WINDOW, STRIDE = 32, 24
WORD_ROWS, CHAR_ROWS = 1 << 16, 1 << 16
GRAMS = (5,)
INPUT, HIDDEN = 16, 8
EPOCHS, BATCH, RATE = 6, 32, 0.015


@dataclass
class Text:
    """One text for training: word rows, and the character rows of each word."""

    word: np.ndarray
    chars: np.ndarray  # rows of the n-grams, word after word
    cuts: np.ndarray  # where each word's n-grams begin, and the end


def _features(block, uniq_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, n-gram rows and their cuts for the chosen words."""
    grams, owner = [], []
    for n in GRAMS:
        found, word = char_grams(block, uniq_at, n)
        grams.append((found >> np.uint64(20)).astype(np.int64) % CHAR_ROWS)
        owner.append(word)
    gram, own = np.concatenate(grams), np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(len(uniq_at) + 1))
    return (block.hash[uniq_at] >> np.uint64(20)).astype(np.int64) % WORD_ROWS, gram[order], cuts


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of a text of n words: all words are in one, and every window but the last is full."""
    return np.arange(0, max(n - WINDOW + STRIDE, 1), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _sum_by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(rows[order]) > 0]) if len(rows) else order
    return rows[order][first], np.add.reduceat(values[order], first, axis=0) if len(rows) else values


class Network:
    """Parameters, scoring and gradients."""

    def __init__(self, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)

        def normal(*shape, scale):
            return draw.normal(0, scale, shape).astype(np.float32)

        self.p = {"word": normal(WORD_ROWS, INPUT, scale=0.1), "char": normal(CHAR_ROWS, INPUT, scale=0.1)}
        for d in "fb":
            self.p[f"W{d}"] = normal(INPUT, 3 * HIDDEN, scale=INPUT**-0.5)
            self.p[f"U{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
            self.p[f"c{d}"] = np.zeros(3 * HIDDEN, np.float32)
        self.p["look"] = normal(2 * HIDDEN, scale=0.3)  # attention
        self.p["out"] = normal(2 * HIDDEN, scale=0.3)
        self.p["bias"] = np.zeros(1, np.float32)

    def inputs(self, word: np.ndarray, chars: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The vector of each word."""
        vectors, n = self.p["word"][word], np.diff(cuts)
        some = np.flatnonzero(n)
        if len(some):
            sums = np.add.reduceat(self.p["char"][chars], cuts[some], axis=0)
            vectors[some] += sums / np.sqrt(n[some, None]).astype(np.float32)
        return vectors

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction over x: (time, window, 3 * HIDDEN) projected inputs."""
        u, h = self.p[f"U{d}"], np.zeros((x.shape[1], HIDDEN), np.float32)
        states = np.empty((len(x), x.shape[1], HIDDEN), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            gates = _sigmoid(x[t, :, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            hu = h @ u[:, 2 * HIDDEN :]
            c = np.tanh(x[t, :, 2 * HIDDEN :] + r * hu)
            if keep is not None:
                keep.append((t, h, z, r, hu, c))
            h = h + z * (c - h)
            states[t] = h
        return states

    def _pool(self, states: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores = np.where(live, states @ self.p["look"], -1e9)
        weights = np.exp(scores - scores.max(axis=0))
        weights = weights * live
        weights /= np.maximum(weights.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weights, states)
        return pooled @ self.p["out"] + self.p["bias"][0], weights, pooled

    def logits(self, projected: dict[str, np.ndarray], at: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Window logits; ``at`` (time, window) are rows of the projected inputs, ``live`` says which count."""
        states = np.concatenate([self._run(projected[d][at], d) for d in "fb"], axis=2)
        return self._pool(states, live)[0]

    def project(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """Inputs of both directions; the last row stands for no word."""
        out = {}
        for d in "fb":
            rows = vectors @ self.p[f"W{d}"] + self.p[f"c{d}"]
            none = np.zeros((1, 3 * HIDDEN), np.float32)
            none[:, :HIDDEN] = -30  # an update gate that stays shut: padding leaves the state as it is
            out[d] = np.concatenate([rows, none])
        return out

    def gradients(self, texts: list[Text], labels: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of one batch; table gradients as (rows, values)."""
        word = np.concatenate([t.word for t in texts])
        chars = np.concatenate([t.chars for t in texts])
        lead = np.cumsum([0, *(len(t.chars) for t in texts)])
        cuts = np.concatenate([*(t.cuts[:-1] + a for t, a in zip(texts, lead, strict=False)), [len(chars)]])
        vectors, projected = self.inputs(word, chars, cuts), {}
        projected = self.project(vectors)
        at, live, owner = window_grid([len(t.word) for t in texts])
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._run(projected[d][at], d, kept[d]) for d in "fb"], axis=2)
        logit, weights, pooled = self._pool(states, live)
        # The worst windows of a text carry its label.
        top = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(top, owner, logit)
        share = np.exp(np.clip((logit - top[owner]) * 4, -30, 0))
        share /= np.bincount(owner, share, len(texts))[owner]
        chance = _sigmoid(logit)
        loss = -np.mean(np.log(np.where(labels > 0, _sigmoid(top), 1 - _sigmoid(top)) + 1e-9))
        d_logit = (share * (chance - labels[owner]) / len(texts)).astype(np.float32)
        g: dict = {"bias": np.array([d_logit.sum()], np.float32), "out": pooled.T @ d_logit}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weights = np.einsum("bh,tbh->tb", d_pooled, states)
        d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
        g["look"] = np.einsum("tb,tbh->h", d_scores, states)
        d_states = weights[:, :, None] * d_pooled + d_scores[:, :, None] * self.p["look"]
        d_vectors = np.zeros((len(vectors) + 1, INPUT), np.float32)
        for i, d in enumerate("fb"):
            u = self.p[f"U{d}"]
            d_x = np.empty((len(at), at.shape[1], 3 * HIDDEN), np.float32)
            d_u, d_h = np.zeros_like(u), np.zeros((at.shape[1], HIDDEN), np.float32)
            for t, h, z, r, hu, c in reversed(kept[d]):
                d_h = d_h + d_states[t, :, i * HIDDEN : (i + 1) * HIDDEN]
                d_c = d_h * z * (1 - c * c)
                d_z = d_h * (c - h) * z * (1 - z)
                d_r = d_c * hu * r * (1 - r)
                d_x[t] = np.concatenate([d_z, d_r, d_c], axis=1)
                d_gate = np.concatenate([d_z, d_r, d_c * r], axis=1)
                d_u += h.T @ d_gate
                d_h = d_h * (1 - z) + d_gate @ u.T
            d_x[~live] = 0
            flat = d_x.reshape(-1, 3 * HIDDEN)
            rows = np.where(live, at, len(vectors)).reshape(-1)
            summed = np.zeros((len(vectors) + 1, 3 * HIDDEN), np.float32)
            touched, sums = _sum_by_row(rows, flat)
            summed[touched] = sums
            g[f"U{d}"], g[f"c{d}"] = d_u, summed[:-1].sum(axis=0)
            g[f"W{d}"] = vectors.T @ summed[:-1]
            d_vectors += summed @ self.p[f"W{d}"].T
        d_vectors = d_vectors[:-1]
        n = np.diff(cuts)
        g["word"] = (word, d_vectors)
        g["char"] = (chars, np.repeat(d_vectors / np.sqrt(np.maximum(n, 1))[:, None].astype(np.float32), n, axis=0))
        return float(loss), g


def window_grid(sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, window) rows of words, which of them exist, and each window's text.  Missing ones name the row behind the last."""
    lead, starts, owner, ends = 0, [], [], []
    for i, n in enumerate(sizes):
        first = window_starts(n)
        starts.append(first + lead)
        owner.append(np.full(len(first), i))
        lead += n
        ends.append(np.full(len(first), lead))
    at = np.arange(WINDOW)[:, None] + np.concatenate(starts)[None, :]
    live = at < np.concatenate(ends)[None, :]
    return np.where(live, at, lead), live, np.concatenate(owner)


def train(texts: list[Text], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam over shuffled batches; table rows are updated where a batch touched them."""
    net, draw = Network(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        rate = RATE * (0.3 if epoch >= epochs - 2 else 1)
        order = draw.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            chosen = order[a : a + BATCH]
            _, g = net.gradients([texts[i] for i in chosen], labels[chosen])
            step += 1
            for k, grad in g.items():
                if isinstance(grad, tuple):
                    rows, grad = _sum_by_row(*grad)
                else:
                    rows = slice(None)
                m = first[k][rows] * 0.9 + 0.1 * grad
                v = second[k][rows] * 0.99 + 0.01 * grad * grad
                first[k][rows], second[k][rows] = m, v
                net.p[k][rows] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def _samples(texts: list[str]) -> list[Text]:
    out = []
    for block in words(pa.array(texts, pa.string()), LETTERS):
        bounds = block.bounds()
        word, chars, cuts = _features(block, np.arange(len(block.hash)))
        for i in range(block.rows):
            a, b = bounds[i], bounds[i + 1]
            out.append(Text(word[a:b], chars[cuts[a] : cuts[b]], cuts[a : b + 1] - cuts[a]))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> DataFrame:
    """(text, toxic): at most ``most`` labelled texts, the two kinds evenly as far as there are enough."""
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = drawn(docs, known, "toxic", {0: most, 1: most}, ["text"], 1, chars)
    return found.orderBy("nth", F.xxhash64("doc_id"), "doc_id").limit(most).select("text", "toxic")


def score_blocks(net: Network, column: pa.Array) -> np.ndarray:
    """The score of every text: the highest of its windows."""
    out = []
    for block in words(column, LETTERS, 1 << 19):
        _, first, back = distinct(block.hash)
        projected = net.project(net.inputs(*_features(block, first)))
        sizes = np.diff(block.bounds())
        at, live, owner = window_grid(sizes)
        places = np.append(back, len(first))  # word -> row of its distinct word; none -> the last
        best = np.full(block.rows, -np.inf, np.float32)
        for a in range(0, len(owner), 4096):
            logit = net.logits(projected, places[at[:, a : a + 4096]], live[:, a : a + 4096])
            np.maximum.at(best, owner[a : a + 4096], logit)
        out.append(_sigmoid(best))
    return np.concatenate([np.zeros(0, np.float32), *out]).astype(np.float64)


def _fitted(sample: DataFrame) -> tuple[Network | None, float]:
    """The network and the share of toxic labels; one task fits it, as the sample is bounded, and only the model leaves it."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches), pa.schema([("text", pa.string()), ("toxic", pa.int64())]))
        truth = found.column("toxic").to_numpy().astype(np.float32)
        net = train(_samples(found.column("text").to_pylist()), truth) if len(set(truth)) == 2 else None
        model = pickle.dumps(net.p if net else None)
        flat = float(truth.mean()) if len(truth) else 0.0
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary()), pa.array([flat])], names=["model", "flat"])

    typed = sample.select("text", F.col("toxic").cast("long").alias("toxic"))
    made = typed.coalesce(1).mapInArrow(fit, "model binary, flat double").collect()
    parameters = pickle.loads(made[0]["model"]) if made else None
    net = None
    if parameters is not None:
        net = Network()
        net.p = parameters
    return net, made[0]["flat"] if made else 0.0


def _scored(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, h, g, score) of each row."""
    net, flat = _fitted(training_sample(labelled, labels))
    held = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = held.value
            found = score_blocks(model, batch.column(3)) if model else np.full(len(batch), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found)], names=[*ROW, "score"])

    rows = docs.select(F.col("doc_id").cast("long"), *text_hashes(), "text")
    return rows.mapInArrow(score, "doc_id long, h long, g long, score double")


def toxicity_scores(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of each row of ``docs``; the model is fitted on ``labelled`` (doc_id, text) with ``labels`` (doc_id, toxic)."""
    return _scored(docs, labelled, labels).select("doc_id", "score")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold; the model learns from all labels.

    A clean text stays though another under its id goes; null ids are judged like others.
    """
    return without(docs, _scored(docs, docs, labels).where(F.col("score") >= threshold))
