"""Quality by weak supervision (operator 7).

Each rule votes good (1) or bad (-1) on a text or abstains (0). How often a rule votes each way on good and on bad texts
is not known; expectation-maximisation estimates it, and the share of good texts, from all votes of the corpus, without labels. A
text is kept if its posterior probability of being good is at least one half. Votes are counted by pattern (at most
3 to the number of rules), so what reaches the driver does not grow with the corpus.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema

FALSE_ALARM = 0.01  # prior of a rule's bad votes on good texts
PRIOR_VOTES = 200  # its weight
RULES = ("symbols", "capitals", "repeated lines", "repeated windows", "exclamations", "word length", "punctuation",
         "variety")
SYMBOLS = "#*$%&|<>"
BLANKS = "\t\n\v\f\r "
_split = re.compile(r"[\x20\x09-\x0D]+").split
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


@dataclass
class Facts:
    """What the rules and the base filter look at."""

    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    n_lines: int = 0
    n_distinct: int = 0
    upper: int = 0
    lower: int = 0
    exclamations: int = 0
    ends: int = 0


def words_of(text: str) -> list[str]:
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return [w for w in _split(text) if w]


def repeat_words(words: list[str], window: int = 5) -> int:
    """Words that lie in a window of words found twice or more in the text, its first place included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    first: dict[tuple, int] = {}
    repeated: list[int] = []
    windows = zip(*(islice(words, k, None) for k in range(window)))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            repeated.append(i)
            repeated.append(j)
    if not repeated:
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.unique(np.array(repeated))
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    return int((np.cumsum(steps)[:-1] > 0).sum())


def facts(text: str | None) -> Facts:
    """Facts of a whole text; a missing text has none."""
    if not text:
        return Facts()
    words = words_of(text)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    data = text.encode("utf-8", "replace")
    return Facts(
        n_words=len(words), word_chars=len(text) - sum(map(text.count, BLANKS)),
        n_symbols=sum(map(text.count, SYMBOLS)), n_dup_lines=dup, n_repeat_words=repeat_words(words), n_lines=lines,
        n_distinct=len(set(words)), upper=len(data) - len(data.translate(None, _UPPER)),
        lower=len(data) - len(data.translate(None, _LOWER)), exclamations=text.count("!"),
        ends=sum(map(text.count, ".,;:?")))


def votes(f: Facts) -> list[int]:
    """One vote a rule: 1 good, -1 bad, 0 none."""

    n = f.n_words
    if not n:
        return [0] * len(RULES)
    letters = f.upper + f.lower
    length = f.word_chars / n
    ended = f.ends / n
    def vote(applies: bool, bad: bool) -> int:
        return 0 if not applies else -1 if bad else 1

    return [
        vote(n >= 5, f.n_symbols >= 0.15 * n),
        vote(letters >= 20, f.upper >= 0.6 * letters),
        vote(f.n_lines >= 4, f.n_dup_lines >= 0.3 * f.n_lines),
        vote(n >= 20, f.n_repeat_words >= 0.15 * n),
        vote(n >= 5, f.exclamations >= 0.3 * n),
        vote(n >= 5, not 2 <= length <= 15),
        vote(n >= 50, ended < 0.004),
        vote(50 <= n <= 2000, f.n_distinct < 0.12 * n),
    ]


def base_failed(f: Facts) -> bool:
    return f.n_words < 10 or 100 * f.n_repeat_words > 20 * f.n_words


@dataclass
class VoteModel:
    """Prior probability of good, and log odds of good over bad for each rule's votes (-1, 1); abstaining says nothing."""

    prior: float
    odds: list[tuple[float, float]]

    def posterior(self, pattern: list[int]) -> float:
        z = math.log(self.prior / (1 - self.prior))
        for v, (bad, good) in zip(pattern, self.odds):
            z += bad if v < 0 else good if v > 0 else 0.0
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 3000) -> VoteModel:
    """Estimate each rule's chance to vote bad, given that it votes, on good and on bad texts.

    Patterns are rows of votes, counts how many texts have them. The start is taken from the votes: each bad one makes good ten
    times less likely. What the votes say decides, with two priors: that a rule gives a false alarm on 1 % of good texts weighs
    as much as ``PRIOR_VOTES`` votes, so it fades as votes come in and settles only what they leave open (a rule that no other
    rule ever agrees with); what it does on bad texts is left to the votes (a tenth of one). A rule is taken to vote bad on
    bad texts no less often than on good ones.
    """
    rules = patterns.shape[1] if patterns.size else len(RULES)
    bad, good = (patterns < 0).astype(float), (patterns > 0).astype(float)
    prior, on_good, on_bad = 0.9, np.full(rules, FALSE_ALARM), np.full(rules, 0.4)
    p = 0.1 ** bad.sum(axis=1) if len(counts) else np.zeros(0)
    for _ in range(rounds if len(counts) else 0):
        weight_good, weight_bad = counts * p, counts * (1 - p)
        new = (weight_good.sum() + 9) / (counts.sum() + 10)
        on_good = (weight_good @ bad + FALSE_ALARM * PRIOR_VOTES) / (weight_good @ (bad + good) + PRIOR_VOTES)
        on_bad = np.maximum((weight_bad @ bad + 0.04) / (weight_bad @ (bad + good) + 0.1), on_good)
        settled, prior = abs(new - prior) < 1e-10, new
        if settled:
            break
        z = math.log(prior / (1 - prior)) + bad @ np.log(on_good / on_bad) + good @ np.log((1 - on_good) / (1 - on_bad))
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    # A rule that voted bad on all bad texts there are still says nothing for certain.
    on_bad = np.minimum(on_bad, 1 - 1e-9)
    odds = [(math.log(g / b), math.log((1 - g) / (1 - b))) for g, b in zip(on_good, on_bad)]
    return VoteModel(float(prior), odds)


FACTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def judged(docs: DataFrame, also: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The base facts, base_failed and the pattern of votes of every row, beside the columns named in ``also``."""
    names = FACTS.replace(" long", "").split(", ")
    kept = [f for f in docs.schema if f.name in also]
    # Taken under numbered names, so that no column of the table clashes.
    rows = docs.select(F.col("text").cast("string").alias("_t"), *[F.col(f"`{f.name}`").alias(f"_{i}") for i, f in enumerate(kept)])
    ddl = FACTS + ", base_failed boolean, votes array<int>" + "".join(
        f", _{i} {f.dataType.simpleString()}" for i, f in enumerate(kept))
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            found = [facts(t) for t in batch.column(0).to_pylist()]
            columns = [[getattr(f, n) for f in found] for n in names]
            columns += [[base_failed(f) for f in found], [votes(f) for f in found]]
            arrays = [pa.array(c, s.type) for c, s in zip(columns, schema)] + batch.columns[1:]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.mapInArrow(run, ddl)


def estimate(found: DataFrame) -> VoteModel:
    """Fit to the vote patterns of all rows that pass the base filter; the others are decided already."""
    rows = found.filter(~F.col("base_failed")).groupBy("votes").agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: r["votes"])
    return expectation_maximisation(np.array([r["votes"] for r in rows]), np.array([r["n"] for r in rows], float))


def posterior(votes, model: VoteModel):
    """Posterior probability of good as a column."""
    z = F.lit(math.log(model.prior / (1 - model.prior)))
    for i, (bad, good) in enumerate(model.odds):
        v = votes[i]
        z = z + F.when(v < 0, bad).when(v > 0, good).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def quality(docs: DataFrame, stored) -> DataFrame:
    """(doc_id, n_words, base facts, base_failed, kept, posterior) of every row of (doc_id, text).

    A missing or empty text has no words and fails the base. Repeated rows and missing ids give a row each; other columns
    are ignored; an empty table gives no rows. ``stored`` stores a frame, so that texts are read once.
    """
    found = stored(judged(docs), "votes")
    p = posterior(F.col("votes"), estimate(found))
    return found.withColumn("posterior", p).select(
        F.col("_0").alias("doc_id"), *FACTS.replace(" long", "").split(", "), "base_failed",
        (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"), "posterior")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass the base filter and are probably good, with their own columns.

    Texts are read twice: once to count votes, once to keep rows.
    """
    model = estimate(judged(docs, ()))
    found = judged(docs, tuple(docs.columns))
    p = posterior(F.col("votes"), model)
    return found.filter(~F.col("base_failed") & (p >= 0.5)).select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
