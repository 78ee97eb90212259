"""Language identification by averaged hashed subword embeddings (operator 2).

A text's subwords are the 2-, 3- and 4-byte windows of its lower-cased UTF-8 form, within words (a blank marks a word's ends), hashed
to buckets. The text is the average of its buckets' embeddings; a linear softmax scores the languages. Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows.

A fifth of that sample is left out of training and calibrates what is rejected. One temperature is fitted to whole texts and
to short pieces of them, with targets smoothed by Laplace's rule, so it has a finite best value where no mistake is made. A
prediction is rejected for a score below those of that language's own texts and pieces, where predicted rightly (the ``ALPHA``
quantile), or for its novelty: the share of the text's subwords that no training text of the predicted language has. Novelty
is rejected from halfway between what the language's own texts reach and what texts of the other languages have at least;
these stand for the languages that nobody labelled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_batch

SAMPLE_ROWS = 4000  # labelled rows at most, in equal shares of the languages; the bound of what is fitted on
BUCKETS = 1 << 14
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.4
ALPHA = 0.001
FOREIGN = 0.01  # quantile of the novelty of other languages' texts
PIECES = 4  # short pieces of each held-out text
KINDS = 1 << 20  # subwords told apart for novelty; their last bits are the bucket
SLICE = 1 << 20  # bytes handled at once
UNKNOWN = "und"

has_letter = re.compile(r"[^\W\d_]").search

_BLANK = np.full(256, 32, np.uint8)
_BLANK[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_BLANK[128:] = np.arange(128, 256)


def subwords(text: str) -> list[np.ndarray]:
    """Numbers of all subwords of a text, in slices; the bucket is their remainder by ``BUCKETS``."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    slices = []
    for at in range(0, len(data), SLICE):
        b = _BLANK[data[at:at + SLICE + 3]]
        keep = np.ones(len(b), bool)
        keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
        b = b[keep]
        x = b.astype(np.uint32)
        letter = b != 32
        found = []
        h = x * np.uint32(0x9E3779B1)
        for n in (2, 3, 4):
            if len(x) < n:
                break
            h = (h[:-1] ^ x[n - 1:]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
            # Blanks only at the ends, and not only blanks.
            if n == 2:
                fits = letter[:-1] | letter[1:]
            else:
                fits = fits_inside(letter, n)
            found.append((h[fits] >> np.uint32(7)) & np.uint32(KINDS - 1))
        slices.append(np.concatenate(found) if found else np.zeros(0, np.uint32))
    return slices


def fits_inside(letter: np.ndarray, n: int) -> np.ndarray:
    """Windows of n bytes whose inner bytes are all letters."""
    inside = letter[1:len(letter) - n + 2].copy()
    for k in range(2, n - 1):
        inside &= letter[k:len(letter) - n + 1 + k]
    return inside


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    """Languages, the product of embeddings and softmax weights by bucket, biases, temperature; by language the least score,
    the most novelty and a bit for each subword that its training texts have."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: np.ndarray | None = None
    most: np.ndarray | None = None
    seen: np.ndarray | None = None

    def logits(self, found: list[np.ndarray]) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for h in found:
            at = h & np.uint32(BUCKETS - 1)
            total += np.bincount(at, minlength=BUCKETS) @ self.weights if len(h) > 2 * BUCKETS else self.weights[at].sum(axis=0, dtype=np.float64)
            n += len(h)
        return total / max(n, 1) + self.bias

    def novelty(self, found: list[np.ndarray], language: int) -> float:
        """Share of subwords that the language's training texts don't have."""
        bits = self.seen[language]
        known = sum(int(((bits[h >> np.uint32(3)] >> (h & np.uint32(7)).astype(np.uint8)) & 1).sum()) for h in found)
        return 1 - known / max(sum(map(len, found)), 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); ``und`` with score 0 where there is no letter or nothing was learned."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        found = subwords(text)
        p = softmax(self.logits(found) / self.temperature)
        best = int(p.argmax())
        rejected = p[best] < self.least[best] or self.novelty(found, best) > self.most[best]
        return self.languages[best], float(p[best]), bool(rejected)


def train(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """Fit a model on labelled texts; each is seen whole and, once an epoch, as a short run of its words."""
    languages = sorted(set(langs))
    usable = [(t, languages.index(g)) for t, g in zip(texts, langs) if t and has_letter(t)]
    if not usable:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(usable))
    held = order[:len(order) // 5] if len(order) >= 20 else order
    fitted = order[len(order) // 5:] if len(order) >= 20 else order

    def features(text: str):
        h = np.concatenate(subwords(text))
        buckets, counts = np.unique(h & np.uint32(BUCKETS - 1), return_counts=True)
        return buckets, (counts / max(len(h), 1)).astype(np.float32)

    whole = {i: features(usable[i][0]) for i in fitted}
    table = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, total = 0, EPOCHS * len(fitted) * 2
    for _ in range(EPOCHS):
        for i in rng.permutation(fitted):
            text, target = usable[i]
            words = text.split()
            begin = int(rng.integers(0, max(1, len(words) - 2)))
            piece = " ".join(words[begin:begin + int(rng.integers(2, 25))])
            for buckets, share in (whole[i], features(piece)):
                rate = RATE * (1 - steps / total)
                steps += 1
                if not len(buckets):
                    continue
                mean = share @ table[buckets]
                gradient = softmax(mean @ out + bias)
                gradient[target] -= 1
                back = out @ gradient
                out -= rate * np.outer(mean, gradient)
                bias -= rate * 0.1 * gradient
                # Scaled up, as an average spreads a step over all subwords of a text.
                table[buckets] -= np.outer(np.minimum(rate * 20 * share, rate), back)
    model = Model(languages, (table @ out).astype(np.float32), bias.astype(np.float64))
    calibrate(model, [usable[i] for i in fitted], [usable[i] for i in held], rng)
    return model


def calibrate(model: Model, fitted: list[tuple[str, int]], held: list[tuple[str, int]], rng: np.random.Generator) -> None:
    """Set the model's temperature and what it rejects, from texts (text, language) learned from and held-out ones."""
    kinds = len(model.languages)
    seen = np.zeros((kinds, KINDS), bool)
    for text, g in fitted:
        for h in subwords(text):
            seen[g, h] = True
    model.seen = np.packbits(seen, axis=1, bitorder="little")
    found = [subwords(t) for t, _ in held]
    pieces = []
    for text, _ in held:
        words = text.split()
        for _ in range(PIECES):
            begin = int(rng.integers(0, max(1, len(words) - 2)))
            pieces.append(subwords(" ".join(words[begin:begin + int(rng.integers(2, 25))])))
    logits = np.array([model.logits(f) for f in found])
    shorter = np.array([model.logits(f) for f in pieces])
    targets = np.array([g for _, g in held])
    if kinds > 1:
        wrong = 1 / (2 * len(held) + 2)
        goal = np.full((len(held), kinds), wrong / (kinds - 1))
        goal[np.arange(len(held)), targets] = 1 - wrong
        goal = np.concatenate([goal, goal.repeat(PIECES, axis=0)])
        every = np.concatenate([logits, shorter])
        grid = np.geomspace(0.05, 20, 60)
        loss = [-(goal * np.log(softmax(every / t) + 1e-300)).sum(axis=1).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    p, pieced = softmax(logits / model.temperature), softmax(shorter / model.temperature)
    right = p.argmax(axis=1) == targets
    model.least, model.most = np.zeros(kinds), np.ones(kinds)
    for g in range(kinds):
        own = right & (targets == g)
        if not own.any():
            continue
        short = pieced[(pieced.argmax(axis=1) == g) & (targets.repeat(PIECES) == g), g]
        model.least[g] = np.quantile(np.concatenate([p[own, g], short]), ALPHA)
        other = [model.novelty(f, g) for f, t in zip(found, targets) if t != g]
        reached = np.quantile([model.novelty(found[i], g) for i in np.flatnonzero(own)], 1 - ALPHA)
        model.most[g] = max(reached, (reached + (np.quantile(other, FOREIGN) if other else 1.0)) / 2)


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most about ``sample_rows`` rows of (doc_id, text, lang), the same ones on every run.

    Rows without language or text are left out. The sample takes as many distinct rows of each language, by a hash of
    doc_id and text, so the bound holds for missing and repeated ids and rows too.
    """
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    row = F.xxhash64("doc_id", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_distinct(row).alias("n")).collect()}
    if not counts:
        return train([], [])
    share = sample_rows / len(counts)
    wanted = F.lit(False)
    drawn = F.pmod(row, F.lit(1 << 40))
    for lang, n in counts.items():
        wanted = wanted | ((F.col("lang") == lang) & (drawn < min(1.0, share / n) * (1 << 40)))
    sample = rows.filter(wanted).select("doc_id", "text", "lang").dropDuplicates().toPandas().sort_values(["doc_id", "text"])
    return train(sample["text"].tolist(), sample["lang"].tolist())


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is 2 modulo 4. A missing id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs (with a column text) and lang_pred, score and rejected in front of them.

    A missing text, or one without a letter, is ``und``, score 0, rejected. Columns of those names are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # fixed size: buckets x languages
    added = ["lang_pred", "score", "rejected"]
    rest = docs.drop(*added)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    schema = "lang_pred string, score double, rejected boolean" + (", " + kept if kept else "")

    def make():
        model = shared.value

        def work(batch):
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            columns = dict(zip(added, map(list, zip(*found)))) if found else {c: [] for c in added}
            return columns | {n: batch.column(n) for n in batch.schema.names}

        return work

    return per_batch(rest, make, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row of (doc_id, text, lang), learned from the same table.

    Repeated rows and missing ids give a row each; an empty table, or one without languages, gives ``und`` throughout.
    """
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is identified, with their own columns; rejected ones go."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    # Under numbered names, so that no column clashes with what is predicted.
    places = [c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)]
    rows = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(docs.columns, places)])
    return predict(rows, model).filter(~F.col("rejected")).select(
        *[F.col(p).alias(c) for c, p in zip(docs.columns, places)])
