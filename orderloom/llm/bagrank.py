"""Ranked lexical search over classes of equal bags (operator 11).

Items are the queries, documents what is ranked. A document counts only by how often it has each term of the items and by the
integer m made from its length, so documents that agree in both score alike for every item. They form classes, told by a hash
and verified by the bytes of the counts; each class is scored once and stands for its members in ascending id. No
item takes more than ``k`` documents, so a class keeps its ``k`` smallest ids.

Items are taken in blocks of at most about ``BLOCK_TERMS`` (item, term) rows, each block against all documents; a block's index is all
that the driver and every task hold. Every document is read whole, once a block, and its counts are stored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.shape import stack
from .common import arrow_schema, per_batch, stored

BLOCK_TERMS = 500_000
CELLS = 1 << 21
# A-Z to a-z; every other byte of ASCII that is neither letter nor digit to a blank. Bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

BAGS = "doc_id long, n long, h1 long, h2 long, terms binary, counts binary"
HITS = "item_id long, score long, doc_id long"


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order and with repeats."""
    return (text or b"").translate(FOLD).split()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, repeats) of the items; rows without id or text have none, texts of one id add up, repeated rows count once."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("item_id IS NOT NULL").distinct().select("item_id", F.col("text").cast("binary"))

    def make():
        def work(batch):
            made = [(i, t, n) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for t, n in Counter(terms_of(text)).items()]
            return dict(zip(("item_id", "term", "repeats"), zip(*made))) if made else {"item_id": [], "term": [], "repeats": []}

        return work

    made = per_batch(rows, make, "item_id long, term binary, repeats long")
    return made.groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


class Index:
    """Items of one block: for each of their terms the items that have it, and how often."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        ids = np.array([r[0] for r in rows], np.int64)
        self.items, item = np.unique(ids, return_inverse=True)
        self.vocabulary: dict[bytes, int] = {}
        term = np.array([self.vocabulary.setdefault(bytes(r[1]), len(self.vocabulary)) for r in rows], np.int64)
        order = np.argsort(term, kind="stable")
        self.item, self.repeats = item[order], np.array([r[2] for r in rows], np.int64)[order]
        self.size = np.bincount(term, minlength=len(self.vocabulary))
        self.start = np.cumsum(self.size) - self.size


def bags(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts): all terms of every document, and how often it has each term of the vocabulary, by its number."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"))
    words = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        known = words.value

        def work(batch):
            out = {c: [] for c in ("doc_id", "n", "h1", "h2", "terms", "counts")}
            out["doc_id"] = batch.column(0)
            for text in batch.column(1):
                found = terms_of(text.as_py())
                held = sorted((known[t], n) for t, n in Counter(found).items() if t in known)
                terms, counts = (np.array([h[i] for h in held], "<u4").tobytes() for i in (0, 1))
                digest = np.frombuffer(xxhash.xxh3_128_digest(terms + counts), "<i8")
                for name, value in zip(("n", "h1", "h2", "terms", "counts"), (len(found), *digest.tolist(), terms, counts)):
                    out[name].append(value)
            return out

        return work

    return per_batch(rows, make, BAGS)


def _document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that have each term; the vocabulary is a block's, so its counts are few enough for the driver."""
    schema = arrow_schema("term int, n long")

    def run(batches):
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").astype(np.int64), minlength=size)
        at = np.flatnonzero(seen)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], schema=schema)

    made = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        made[r["term"]] = r["n"]
    return made


class Best:
    """The k best (score, smallest id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.kept = tuple(np.zeros(0, np.int64) for _ in range(4))

    def add(self, scores: np.ndarray, members: list[list[int | None]]) -> None:
        """Scores of classes (rows) for the items (columns), with the ids of each class."""
        least = self.least
        if len(scores) >= self.k:
            # A class has a document at least, so the k-th best class bounds the k-th best document.
            least = np.maximum(least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        made, item = np.nonzero(scores >= least)
        if not len(made):
            return
        sizes = np.array([len(m) for m in members])
        starts = np.cumsum(sizes) - sizes
        flat = [i for m in members for i in m]
        unnamed = np.array([i is None for i in flat], np.int64)
        ids = np.array([0 if i is None else i for i in flat], np.int64)
        times = sizes[made]
        at = np.repeat(starts[made] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        new = (np.repeat(item, times), -np.repeat(scores[made, item], times), unnamed[at], ids[at])
        item, score, unnamed, ids = (np.concatenate(c) for c in zip(self.kept, new))
        order = np.lexsort((ids, unnamed, score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.k]
        self.kept = item[order], score[order], unnamed[order], ids[order]
        full = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.least[self.kept[0][full]] = -self.kept[1][full]


def score(index: Index, weights: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray], m: np.ndarray) -> np.ndarray:
    """Scores of bags (rows) for all items of the block (columns), in 64-bit integers."""
    lengths = np.array([len(t) for t in terms])
    bag, term = np.repeat(np.arange(len(terms)), lengths), np.concatenate(terms).astype(np.int64)
    tf = np.concatenate(counts).astype(np.int64)
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[bag]))
    times = index.size[term]
    at = np.repeat(index.start[term] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    cell = np.repeat(bag, times) * len(index.items) + index.item[at]
    value = np.repeat(part, times) * index.repeats[at]
    total = len(terms) * len(index.items)
    if value.sum(dtype=np.float64) < 2.0 ** 52:
        return np.bincount(cell, value, total).astype(np.int64).reshape(len(terms), -1)
    made = np.zeros(total, np.int64)
    np.add.at(made, cell, value)
    return made.reshape(len(terms), -1)


def _block(docs: DataFrame, rows: list[tuple[int, bytes, int]], k: int) -> DataFrame:
    """(item_id, score, doc_id): for each item of a block its best documents, and more."""
    spark = docs.sparkSession
    index = Index(rows)
    held = stored(bags(docs, index.vocabulary), "bags")
    n_docs, n_terms = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    some = held.filter(F.length("terms") > 0)
    df = _document_counts(some, len(index.vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    m = F.expr(f"25 + (CAST(n AS DECIMAL(20, 0)) * CAST({75 * n_docs} AS DECIMAL(18, 0))) div CAST({n_terms or 1} AS DECIMAL(19, 0))")
    same = ["h1", "h2", "m", "terms", "counts"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id")))
    classes = some.withColumn("m", m).select("doc_id", *same).withColumn("place", place).filter(F.col("place") <= k).groupBy(
        *same).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "doc_id"))), lambda s: s["doc_id"]).alias("members"))
    facts = spark.sparkContext.broadcast((index, weights))
    schema = arrow_schema(HITS)

    def run(batches):
        index, weights = facts.value
        best = Best(len(index.items), k)
        wide = max(1, CELLS // len(index.items))
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("terms", "counts", "m", "members")]
            terms, counts = ([np.frombuffer(b, "<u4") for b in c] for c in columns[:2])
            work = np.cumsum([index.size[t].sum() for t in terms]) if terms else np.zeros(0)
            at = 0
            while at < len(terms):
                to = min(at + wide, max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + CELLS, "right"))))
                best.add(score(index, weights, terms[at:to], counts[at:to], np.array(columns[2][at:to], np.int64)), columns[3][at:to])
                at = to
        item, negative, unnamed, ids = best.kept
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(index.items[item], pa.int64()), pa.array(-negative, pa.int64()),
                 pa.array(ids, pa.int64(), mask=unnamed.astype(bool))], schema=schema)

    return classes.select("terms", "counts", "m", "members").mapInArrow(run, HITS)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0, equal scores by ascending id.

    Every row of docs (doc_id, text) is a document, repeated ones too; missing texts have no terms, rows without id come last among
    equals. Rows of items (item_id, text) without id are no items; different texts of one id add up. Where there is no
    document or no item there are no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    wanted = stored(item_terms(items), "items")
    blocks = -(-wanted.count() // block_terms)
    parts = []
    for number in range(blocks):
        block = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        rows = [(r["item_id"], r["term"], r["repeats"]) for r in block.collect()]
        if rows:
            parts.append(stored(_block(docs, rows, k), "hits"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return stack(parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")
