"""Ids of texts by the tokenizers library, with its model called once for each distinct word."""

from __future__ import annotations

import functools
from array import array

from .presplit import Bounded, PreSplit

CACHED_CHUNKS = 700_000
CACHED_WORDS = 200_000


class LibraryIds:
    """Encode texts as the library does without added special tokens, truncation and padding."""

    def __init__(self, path: str):
        self.split = PreSplit(path)
        self._model = self.split.library.model.tokenize
        self.by_word = Bounded(self._word, CACHED_WORDS)
        self.by_chunk = Bounded(self._chunk, CACHED_CHUNKS)
        self.size = max([*self.split.vocab.values(), *self.split.special.values()]) + 1

    def _word(self, word: str) -> bytes:
        return array("I", [t.id for t in self._model(word)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        by_word, words = self.by_word, self.split.words(chunk)
        return by_word[words[0]] if len(words) == 1 else b"".join([by_word[w] for w in words])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a missing text is empty."""
        out = []
        for part, special in self.split.parts(text or ""):
            if special is not None:
                out.append(array("I", [special]).tobytes())
            else:
                out.extend(map(self.by_chunk.__getitem__, self.split.chunks(part)))
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    """One per worker process and file: its caches outlive a task."""
    return LibraryIds(path)
