"""Words of a block of texts and the character n-grams of its distinct words, for the text models."""

from __future__ import annotations

import numpy as np

from coverlens.llm.bytehash import Words, mix


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, where each first stands, and each word's place among them."""
    return np.unique(hashes, return_index=True, return_inverse=True)


def char_grams(block: Words, chosen: np.ndarray, n: int, edges: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-byte runs of the chosen words and the word (place in ``chosen``) of each.

    With ``edges`` the first and last run of a word also count once more as such, so a model can tell a
    beginning from an inside.  Words shorter than n have none.
    """
    start, end = block.start[chosen], block.end[chosen]
    runs = np.maximum(end - start - n + 1, 0)
    word = np.repeat(np.arange(len(chosen)), runs)
    place = np.arange(len(word)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = start[word] + place
    found = block.range_hash(at, at + n)
    if not edges:
        return found, word
    long = np.flatnonzero(runs > 0)
    head = mix(block.range_hash(start[long], start[long] + n) + np.uint64(1))
    tail = mix(block.range_hash(end[long] - n, end[long]) + np.uint64(2))
    return np.concatenate([found, head, tail]), np.concatenate([word, long, long])
