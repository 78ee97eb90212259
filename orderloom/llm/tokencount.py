"""Token counts by heap-and-linked-list byte-pair merging (operator 3).

A pre-token starts as its bytes. All adjacent pairs that a merge rule knows lie in a heap by (rank, place); the lowest is
popped again and again, its two symbols are joined in the linked list and the two new neighbour pairs are pushed. Entries
whose symbols have changed meanwhile are skipped. The count is the number of initial symbols minus the merges made; no
identifiers are put out. Chunks and pre-tokens recur, so each worker keeps bounded caches of their counts.
"""

from __future__ import annotations

import functools
from heapq import heapify, heappop, heappush

import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import per_batch, texts_of
from .presplit import Bounded, PreSplit

CACHED_CHUNKS = 500_000
CACHED_WORDS = 400_000


class PairMerger:
    """Counts of pre-tokens under the merge rules of one file."""

    def __init__(self, path: str):
        self.split = PreSplit(path)
        vocab = self.split.vocab
        self.symbol = {c: vocab[c] for c in vocab if len(c) == 1}
        # (left << 20 | right) -> rank << 20 | joined symbol
        self.rules = {
            vocab[a] << 20 | vocab[b]: rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(self.split.merges)
        }
        self.by_word = Bounded(self.count_word, CACHED_WORDS)
        self.by_chunk = Bounded(self.count_chunk, CACHED_CHUNKS)

    def count_word(self, word: str) -> int:
        """Tokens of one pre-token: its symbols minus the merges."""
        rules = self.rules
        symbols = [self.symbol[c] for c in word]
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            rule = rules.get(symbols[i] << 20 | symbols[i + 1])
            if rule is not None:
                heap.append(rule << 32 | i)
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFF
            j = after[i]
            # A symbol that was joined to its left neighbour is -1.
            if symbols[i] < 0 or j >= n or rules.get(symbols[i] << 20 | symbols[j]) != entry >> 32:
                continue
            joined = symbols[i] = entry >> 32 & 0xFFFFF
            symbols[j] = -1
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                rule = rules.get(joined << 20 | symbols[k])
                if rule is not None:
                    heappush(heap, rule << 32 | i)
            h = before[i]
            if h >= 0:
                rule = rules.get(symbols[h] << 20 | joined)
                if rule is not None:
                    heappush(heap, rule << 32 | h)
        return n - merges

    def count_chunk(self, chunk: str) -> int:
        by_word = self.by_word
        return sum([by_word[w] for w in self.split.words(chunk)])

    def count(self, text: str | None) -> int:
        """Tokens of a text; a missing text is empty."""
        total = 0
        for part, special in self.split.parts(text or ""):
            if special is not None:
                total += 1
            else:
                total += sum(map(self.by_chunk.__getitem__, self.split.chunks(part)))
        return total


@functools.lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    """One per worker process and file: its caches outlive a task."""
    return PairMerger(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of (doc_id, text).

    A missing or empty text has 0 bytes and 0 tokens; repeated rows and missing ids give a row each; other columns are
    ignored. ``path`` names a byte-level tokenizer file on every executor.
    """

    def make():
        counter = merger(path)

        def work(batch):
            text = batch.column("text")
            counts = [counter.count(t) for t in text.to_pylist()]
            return {"doc_id": batch.column("doc_id"), "n_bytes": pc.fill_null(pc.binary_length(text), 0).cast("int64"),
                    "n_tokens": counts, "over_limit": [n > limit for n in counts]}

        return work

    return per_batch(texts_of(docs), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
