"""BPE encoding and decoding by a tokenization automaton (operator 9).

The automaton reads tokens and accepts exactly the token sequences that byte-pair merging gives. It starts as one state in
which every symbol loops. Each merge (u, v) -> w, in rank order, applies the merge gadget: the state reached by u is
split off without its v arc; from every state with a u arc, an arc w goes where v led. In the result the state after a
token does not depend on what was read before, so states are named by tokens, and the gadget of rank k leaves these marks:

    cut[u, v] = k    from then on no v follows u
    tail[w] = v      the state after w began as the state after v was at k (its cuts before k hold)
    head[w] = u      the states that have a w arc are those that had a u arc at k (cuts up to k hold)

An arc a -> b is absent iff some cut (x, y) = k holds for it: x on the tail chain of a with k before the next chain
member was made, y on the head chain of b with k not after the next one was made. Arcs are looked up in a transition
table, filled as they are first asked for (the full table has 49,000 x 49,000 entries), so the automaton is deterministic
and every later step is one table look-up.

Encoding a word: every prefix has exactly one accepted path, found left to right over the vocabulary trie. Decoding emits the
arc labels.
"""

from __future__ import annotations

import functools
import hashlib
import sys
from array import array

import numpy as np
from pyspark.sql import DataFrame

from .common import per_batch, texts_of
from .presplit import Bounded, PreSplit

CACHED_CHUNKS = 500_000
CACHED_WORDS = 300_000
CACHED_ARCS = 1_500_000
ALWAYS = sys.maxsize


class Automaton:
    """The tokenization automaton of a merge list over numbered tokens."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.cut: dict[int, int] = {}
        self.tail: dict[int, tuple[int, int]] = {}
        self.head: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocab[a], vocab[b], vocab[a + b])
        self._tails = Bounded(lambda t: self._chain(self.tail, t), 100_000)
        self._heads = Bounded(lambda t: self._chain(self.head, t), 100_000)
        self.arcs = Bounded(self._arc, CACHED_ARCS)

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        """Merge gadget: split the state after u, and let w lead where v led."""
        self.cut[u << 20 | v] = rank
        self.tail[w] = (v, rank)
        self.head[w] = (u, rank)

    @staticmethod
    def _chain(up: dict[int, tuple[int, int]], token: int) -> list[tuple[int, int]]:
        """(token, rank at which the member before it was made from it), from the token itself downwards."""
        chain, made = [], ALWAYS
        while True:
            chain.append((token, made))
            if token not in up:
                return chain
            token, made = up[token]

    def _arc(self, key: int) -> bool:
        cut = self.cut
        heads = self._heads[key & 0xFFFFF]
        for x, before in self._tails[key >> 20]:
            for y, until in heads:
                rank = cut.get(x << 20 | y)
                if rank is not None and rank < before and rank <= until:
                    return False
        return True

    def follows(self, a: int, b: int) -> bool:
        """Whether the state after token a has an arc b."""
        return self.arcs[a << 20 | b]


class AutomatonCodec:
    """Encode texts to ids and decode ids under one tokenizer file."""

    def __init__(self, path: str):
        self.split = PreSplit(path)
        self.automaton = Automaton(self.split.vocab, self.split.merges)
        self.labels = {i: t for t, i in self.split.vocab.items()} | {i: t for t, i in self.split.special.items()}
        self.trie = self._trie()
        self.by_word = Bounded(self.encode_word, CACHED_WORDS)
        self.by_chunk = Bounded(self.encode_chunk, CACHED_CHUNKS)

    def _trie(self) -> dict:
        """Nested dicts by letter; key 0 holds the id of an inner token, key 1 that of a token at a word's end."""
        root: dict = {}
        suffix = self.split.suffix
        for token, number in self.split.vocab.items():
            last = bool(suffix) and token.endswith(suffix)
            node = root
            for letter in token.removesuffix(suffix) if last else token:
                node = node.setdefault(letter, {})
            node[1 if last else 0] = number
        return root

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token as 32-bit integers, along its accepted path."""
        n = len(word)
        arcs, trie, ends = self.automaton.arcs, self.trie, bool(self.split.suffix)
        came: list[int | None] = [None] * (n + 1)  # token that the accepted path of each prefix ends with
        start = [0] * (n + 1)
        for i in range(n):
            state = came[i]
            if i and state is None:
                continue
            node, j = trie, i
            while j < n:
                node = node.get(word[j])
                if node is None:
                    break
                j += 1
                token = node.get(1 if ends and j == n else 0)
                if token is not None and came[j] is None and (not i or arcs[state << 20 | token]):
                    came[j], start[j] = token, i
        path, j = [], n
        while j:
            path.append(came[j])
            j = start[j]
        return array("I", path[::-1]).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        by_word = self.by_word
        return b"".join([by_word[w] for w in self.split.words(chunk)])

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; a missing text is empty."""
        out = []
        for part, special in self.split.parts(text or ""):
            if special is not None:
                out.append(array("I", [special]).tobytes())
            else:
                out.extend(map(self.by_chunk.__getitem__, self.split.chunks(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Arc labels of the ids; this file names no decoder, so labels are joined by blanks as the library does."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(path: str) -> AutomatonCodec:
    """One per worker process and file: its tables outlive a task."""
    return AutomatonCodec(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of (doc_id, text): ids as packed little-endian 32-bit integers.

    A missing or empty text has no ids and decodes to the empty text; repeated rows and missing ids give a row each;
    other columns are ignored.
    """

    def make():
        words = codec(path)

        def work(batch):
            ids = [words.encode(t) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": [words.decode(i) for i in ids]}

        return work

    return per_batch(texts_of(docs), make, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of ``encode_decode``, taken where the ids are made."""

    def make():
        words = codec(path)

        def work(batch):
            counts, of_ids, of_text = [], [], []
            for text in batch.column("text").to_pylist():
                ids = words.encode(text)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(words.decode(ids).encode()).hexdigest())
            return {"doc_id": batch.column("doc_id"), "n_tokens": counts, "ids_sha256": of_ids, "decoded_sha256": of_text}

        return work

    return per_batch(texts_of(docs), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
