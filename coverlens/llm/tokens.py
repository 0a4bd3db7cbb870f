"""Token ids of many texts with a public vocabulary file, cut at white space so that each piece is encoded once.

Both vocabularies split a text before their merges, and no token crosses white space other than as its
leading space.  A piece's ids are therefore the same wherever it stands: pieces are looked up in a bounded cache and
only unseen ones go through the library.  Texts whose white space or special strings leave a doubt are encoded whole.
"""

from __future__ import annotations

import gc
import os
from array import array
from itertools import islice
from string import ascii_uppercase

import numpy as np

#: Ids are kept as the bytes of unsigned little-endian integers.
ID = np.dtype("<u4")
CACHE = 800_000
BATCH = 8192  # unseen pieces that go through the library at once: its answers are large
_PUNCTUATION = ",.!?;:%*#$&|()[]{}<>=+/\\\"-_@^~`"
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")  # white space to Python only
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Encodes with one file; kept by each Python worker for its life."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.largest = max(self.library.get_vocab().values(), default=0)
        self.cache: dict[str, bytes] = {}
        #: Whether a piece's leading space is part of its tokens.
        self.spaced = self.whole(" a") != self.whole("a")
        #: Whether capitals of ASCII are lower-cased before anything else.
        self.folds = all(self.whole(c) == self.whole(c.lower()) for c in ascii_uppercase)
        self.openers = {s[0] for s in self.special}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=ID).tobytes()

    def _learn(self, new: set[str]) -> None:
        if len(self.cache) + len(new) > CACHE:  # what came first is common
            for piece in list(islice(self.cache, CACHE // 2, None)):
                del self.cache[piece]
        known = self.cache
        folded = []
        if self.folds:  # a special string must not come about by folding
            folded = [(p, p.lower()) for p in new if p.isascii() and not p.islower() and not any(c in p for c in self.openers)]
        if folded:
            new = new.difference(p for p, _ in folded).union(low for _, low in folded if low not in known)
        # Punctuation behind a letter is a token of its own: the word in front of it is often known.
        split, parts = [], set()
        for piece in new:
            core = piece.rstrip(_PUNCTUATION)
            if core != piece and core[-1:].isalpha():
                tail = piece[len(core) :]
                split.append((piece, core, tail))
                parts.add(core)
                parts.add(tail)
            else:
                parts.add(piece)
        unseen = [p for p in parts if p not in known]
        for a in range(0, len(unseen), BATCH):
            part = unseen[a : a + BATCH]
            for piece, found in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[piece] = array("I", found.ids).tobytes()
        for piece, core, tail in split:
            known[piece] = known[core] + known[tail]
        for piece, low in folded:
            known[piece] = known[low]

    def _pieces(self, text: str) -> list[str] | None:
        """The text in pieces that are encoded alone; None if it must be encoded whole."""
        if any(s in text for s in self.special) or any(c in text for c in _SEPARATORS):
            return None
        parts = text.split()
        if not self.spaced:
            return parts
        if len(parts) != text.count(" ") + text.count("\n") + 1:
            return None  # runs of white space, or others than blanks and line ends
        out: list[str] = []
        for n, line in enumerate(text.split("\n")):
            inside = line.split(" ")
            if n:
                out.append("\n")
            out.append(inside[0])
            out.extend([" " + p for p in inside[1:]])
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null is empty."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and a collection would walk through all pieces again and again
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        flat: list[str] = []
        ends: list[int | None] = []  # none: the text is encoded whole
        for text in texts:
            pieces = self._pieces(text) if text else []
            if pieces is not None:
                flat += pieces
            ends.append(None if pieces is None else len(flat))
        found = list(map(self.cache.get, flat))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            self._learn({flat[i] for i in missing})
            for i in missing:
                found[i] = self.cache[flat[i]]
        out, first = [], 0
        for text, end in zip(texts, ends, strict=True):
            out.append(self.whole(text) if end is None else b"".join(found[first:end]))
            first = first if end is None else end
        return out


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def groups(texts: list[str | None], chars: int = 2_000_000):
    """Slices of about so many characters, so that few ids are held at once."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > chars:
            yield first, i
            first, size = i, 0
        size += len(t or "") + 1
    if first < len(texts):
        yield first, len(texts)
