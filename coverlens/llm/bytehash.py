"""Words and word n-grams of many texts as 64-bit hashes, computed on their UTF-8 bytes with numpy.

A word's hash is a polynomial over its bytes modulo 2**64, taken as a difference of running sums, so the
cost is a few array operations a byte and no Python object a word.  Hashes are the same on every machine.
Memory follows the block of texts (about a megabyte, or one longer text), never the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_ONE = np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(members: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(members)] = True
    return flags


#: Bytes of words that ASCII white space separates, and of words of letters and digits only.
NOT_SPACE = ~table(b" \t\n\x0b\x0c\r")
ALPHANUMERIC = table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
LETTERS = table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_PLACE = mix(np.arange(1001, 1129, dtype=np.uint64) * np.uint64(_BASE)) | _ONE
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; long tables are not kept."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    if n <= 2 * BLOCK_BYTES:
        _powers[:] = made
    return made[0], made[1]


@dataclass
class Words:
    """The words of a block of texts, in order: row of the text, byte range in the block, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: int
    first: int  # row of the first text in its batch
    data: np.ndarray  # lowered bytes
    running: np.ndarray  # running sums, for hashes of other byte ranges

    def bounds(self) -> np.ndarray:
        """Where each text's words begin, and the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = _power(len(self.data) + 1)[1]
        return mix((self.running[end] - self.running[start]) * inverse[start])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes and offsets; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes; a longer text stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def words(column: pa.Array, member: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[Words]:
    """Blocks of words: maximal runs of member bytes, with A-Z lowered."""
    data, offsets = text_bytes(column)
    for first, last in blocks(offsets, size):
        part = LOWER[data[offsets[first] : offsets[last]]]
        n = len(part)
        starts_of_rows = offsets[first : last + 1] - offsets[first]
        inside = member[part]
        edge = np.empty(n + 1, dtype=bool)
        edge[0], edge[n] = (inside[0], inside[n - 1]) if n else (False, False)
        np.not_equal(inside[1:], inside[:-1], out=edge[1:n])
        cuts = np.flatnonzero(edge)
        start, end = cuts[0::2], cuts[1::2]
        # A run that crosses from one text into the next is two words.
        inner = starts_of_rows[1:-1]
        crossing = inner[(inner > 0) & (inner < n)]
        crossing = np.unique(crossing[inside[crossing] & inside[crossing - 1]]) if len(crossing) else crossing
        if len(crossing):
            start, end = np.sort(np.concatenate([start, crossing])), np.sort(np.concatenate([end, crossing]))
        power, inverse = _power(n + 1)
        running = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * power[:n], out=running[1:])
        hashes = mix((running[end] - running[start]) * inverse[start])
        row = np.searchsorted(starts_of_rows, start, side="right") - 1
        yield Words(row, start, end, hashes, last - first, first, part, running)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; runs that cross texts are the caller's to drop."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(hashes) - n + 1, _PLACE[100 + min(n, 20)], dtype=np.uint64)
    for i in range(n):
        total += hashes[i : len(hashes) - n + 1 + i] * _PLACE[i]
    return mix(total)


def shingles(block: Words, n: int) -> list[np.ndarray]:
    """Each text's distinct n-word shingles, sorted; a shorter text's only one is its whole sequence."""
    bounds = block.bounds()
    full = grams(block.hash, n)
    out = []
    for i in range(block.rows):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= n:
            out.append(np.unique(full[a : b - n + 1]))
        elif b > a:
            out.append(grams(block.hash[a:b], int(b - a)))
        else:
            out.append(full[:0])
    return out
