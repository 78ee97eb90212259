"""Substring deduplication by content-defined chunking (operator 1).

A gear rolling hash over the last 16 bytes proposes cuts, which move on to the next word's start. So cuts depend on nearby text
only, and an insertion shifts no chunk but its own. Chunks are compared by a 128-bit digest, and so are anchors: of any
``ANCHOR_RUNS`` neighbouring runs of ``MIN_WORDS`` words the one that the rolling hash at its end puts first. Two documents
that share a passage of ``MIN_WORDS + ANCHOR_RUNS - 1`` = 50 words share an anchor in it, whatever surrounds it.

Anchors, and runs of ``MIN_WORDS`` words and more of chunks, that a document of smaller id has too are seeds. Each is held
against the first document that has it, byte by byte, and grows to both sides as far as the bytes agree; what has
``MIN_WORDS`` whole words then is a repeated span. So a span is a passage of one document of smaller id. A passage whose
seeds all occur in yet earlier documents is found as far as those have it. The document with the smallest id keeps its
text. Repeats within one document are none of this operator's business.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import among_keys
from .common import arrow_schema, drop_stored, release, stored, texts_of

WINDOW = 16
CUT_BITS = 7
LEAST, MOST = 32, 512
MIN_WORDS = 16
ANCHOR_RUNS = 35
SLICE = 1 << 20

GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])

CHUNKS = "doc_id long, text_hash long, start long, end long, words int, anchor boolean, d1 long, d2 long"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: the sum of the gear values of the last 16 bytes, each shifted by its distance."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def cuts(data: bytes) -> tuple[list[int], np.ndarray]:
    """Ends of the chunks of a text in UTF-8, and where its words start."""
    octets = np.frombuffer(data, np.uint8)
    n = len(octets)
    blank = _BLANK[octets]
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)
    proposed = []
    for at in range(0, n, SLICE):
        low = max(0, at - WINDOW + 1)
        h = gear_hashes(octets[low:at + SLICE])[at - low:]
        # Bits from 15 on depend on all 16 bytes.
        found = np.flatnonzero((h >> np.uint32(15)) & np.uint32((1 << CUT_BITS) - 1) == 0) + at
        proposed.append(found[found >= WINDOW - 1])
    where = np.searchsorted(starts, np.concatenate(proposed) if proposed else np.zeros(0, np.int64), "right")
    wanted = np.unique(starts[where[where < len(starts)]]).tolist() + [n]
    ends, last = [], 0
    for cut in wanted:
        if cut - last < LEAST and cut < n:
            continue
        while cut - last > MOST:
            k = int(np.searchsorted(starts, last + MOST, "right")) - 1
            forced = int(starts[k]) if k >= 0 and starts[k] > last else last + MOST
            while forced < cut and octets[forced] & 0xC0 == 0x80:
                forced += 1
            if forced >= cut:
                break
            ends.append(forced)
            last = forced
        if cut > last:
            ends.append(cut)
            last = cut
    return ends, starts


def anchors(data: bytes, starts: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of the runs of ``MIN_WORDS`` words that are first in some ``ANCHOR_RUNS`` runs, or in all if there are fewer.

    What is first depends on the last 16 bytes of the run's words, which are its own.
    """
    runs = len(starts) - MIN_WORDS + 1
    if runs < 1:
        return []
    octets = np.frombuffer(data, np.uint8)
    blank = _BLANK[octets]
    ends = np.flatnonzero(~blank & np.append(blank[1:], True))
    h = gear_hashes(octets)[ends[MIN_WORDS - 1:]] * np.uint32(0x9E3779B1)
    wide = min(ANCHOR_RUNS, runs)
    views = np.lib.stride_tricks.sliding_window_view(h, wide)
    first = np.unique(np.concatenate([views[at:at + SLICE].argmin(axis=1) + np.arange(at, min(at + SLICE, len(views)))
                                      for at in range(0, len(views), SLICE)]))
    return list(zip(starts[first].tolist(), (ends[first + MIN_WORDS - 1] + 1).tolist()))


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end, words, anchor, d1, d2): all chunks and anchors of the texts, by bytes; rows without id
    or text have none."""
    schema = arrow_schema(CHUNKS)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, hashes, begin, end, words, anchor, digests = [], [], [], [], [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if doc_id is None or not text:
                        continue
                    data = text.encode("utf-8", "surrogatepass")
                    ends, starts = cuts(data)
                    begins = [0, *ends[:-1]]
                    words.append(np.diff(np.searchsorted(starts, [0, *ends])))
                    fixed = anchors(data, starts)
                    words.append(np.full(len(fixed), MIN_WORDS))
                    anchor.append(np.arange(len(ends) + len(fixed)) >= len(ends))
                    begins = begins + [x for x, _ in fixed]
                    ends = ends + [x for _, x in fixed]
                    ids.append(np.full(len(ends), doc_id))
                    hashes.append(np.full(len(ends), xxhash.xxh64_intdigest(data, 42), np.uint64).view(np.int64))
                    begin.extend(begins)
                    end.extend(ends)
                    digests.extend([xxhash.xxh3_128_digest(data[s:e].rstrip()) for s, e in zip(begins, ends)])
                if not ids:
                    continue
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                arrays = [np.concatenate(ids), np.concatenate(hashes), np.array(begin), np.array(end),
                          np.concatenate(words), np.concatenate(anchor), d[:, 0], d[:, 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(a)).cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return texts_of(docs).filter("doc_id IS NOT NULL AND text <> ''").mapInArrow(run, CHUNKS)


def grown(data: bytes, other: bytes, start: int, end: int, to_left: bool) -> tuple[int, int]:
    """A passage that both texts have, carried on to the left or to the right while some place of the other text has it."""
    step, wider = 16, True
    while step:
        low, high = (start - step, end) if to_left else (start, end + step)
        if low >= 0 and high <= len(data) and data[low:high] in other:
            start, end = low, high
            step = step * 2 if wider else step // 2
        else:
            wider, step = False, step // 2
    return start, end


def shared_passages(data: bytes, other: bytes, seeds: list[tuple[int, int]], min_words: int) -> list[tuple[int, int, int]]:
    """(start, end, words) of the passages around the seeds that the other text has byte by byte, cut to whole words."""
    octets = np.frombuffer(data, np.uint8)
    begins = ~_BLANK[octets]
    begins[1:] &= _BLANK[octets[:-1]]
    starts = np.flatnonzero(begins)
    found, reached = [], []
    for s, e in sorted(seeds):
        e = s + len(data[s:e].rstrip())
        if any(x <= s and e <= y for x, y in reached[-2:]) or data[s:e] not in other:
            continue
        for left_first in (False, True):
            x, y = grown(data, other, *grown(data, other, s, e, left_first), not left_first)
            reached.append((x, y))
            if x:
                at = int(np.searchsorted(starts, x))
                x = int(starts[at]) if at < len(starts) else len(data)
            if y < len(data) and not _BLANK[octets[y]] and not _BLANK[octets[y - 1]]:
                y = int(starts[np.searchsorted(starts, y, "right") - 1])
            words = int(np.searchsorted(starts, y) - np.searchsorted(starts, x)) if y > x else 0
            if words >= min_words and (x, y, words) not in found[-2:]:
                found.append((x, y, words))
    return found


SPANS = "doc_id long, text_hash long, start long, end long, n_words long, first_doc_id long"


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, store=stored) -> DataFrame:
    """(doc_id, text_hash, start, end, n_words, first_doc_id): spans, in bytes, that the document first_doc_id, of smaller id, has too.

    Spans of a text may overlap, but none lies within another. Rows of (doc_id, text). Rows without id and missing or empty
    texts have no spans and count nowhere; repeated rows are one
    document; of two texts under one id each is held against the documents of smaller ids. Other columns are ignored.
    """
    found = stored(chunks(docs), "chunks")
    kind = ["d1", "d2", "anchor"]
    # Digests and ids alone are grouped; places follow for digests that repeat.
    first = found.groupBy(*kind).agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))
    first = stored(first.filter("first_doc_id < last_doc_id").drop("last_doc_id"), "repeated")
    # Each step's shuffle files go before the next one writes its own.
    release(docs.sparkSession)
    repeats = among_keys(found, first, {"d1": "d1", "d2": "d2"}).join(first, kind).filter("doc_id > first_doc_id")
    order = Window.partitionBy("doc_id", "text_hash", "anchor").orderBy("start")
    once = repeats.select("doc_id", "text_hash", "start", "end", "words", "anchor", "first_doc_id",
                          F.lag("start").over(order).alias("same"), F.lag("end").over(order).alias("before"))
    once = once.filter("same IS NULL OR same < start")
    run = F.sum(F.when(F.col("before") == F.col("start"), 0).otherwise(1)).over(order)
    whole = Window.partitionBy("doc_id", "text_hash", "anchor", "run")
    seeds = once.withColumn("run", run).withColumn("n", F.sum("words").over(whole)).filter(F.col("anchor") | (F.col("n") >= min_words))
    seeds = store(seeds.groupBy("doc_id", "text_hash", "first_doc_id").agg(
        F.collect_list(F.struct("start", "end")).alias("seeds")), "seeds")
    drop_stored(found)
    drop_stored(first)
    release(docs.sparkSession)
    named = seeds.select(F.explode(F.array("doc_id", "first_doc_id")).alias("doc_id")).distinct()
    texts = store(texts_of(docs).filter("text <> ''").join(named, "doc_id", "left_semi").withColumn(
        "text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash"]), "texts")
    release(docs.sparkSession)
    pairs = seeds.join(texts.select(F.col("doc_id").alias("first_doc_id"), F.col("text").alias("other")), "first_doc_id").join(
        texts, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "first_doc_id", "seeds", "text", "other")
    schema = arrow_schema(SPANS)

    def verify(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                made = []
                for row in batch.slice(at, 256).to_pylist():
                    data, other = (row[n].encode("utf-8", "surrogatepass") for n in ("text", "other"))
                    spans = shared_passages(data, other, [(x["start"], x["end"]) for x in row["seeds"]], min_words)
                    made.extend((row["doc_id"], row["text_hash"], *x, row["first_doc_id"]) for x in spans)
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    order = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end"), "first_doc_id")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return pairs.mapInArrow(verify, SPANS).withColumn("reach", reach).filter("reach IS NULL OR reach < end").drop("reach")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of docs with repeated spans cut out of their texts, and a column n_chars, if there, counted anew.

    Every row stays, also one whose text is all repeats (it is empty then). Columns keep their names and order.
    """
    tables: list[DataFrame] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        tables.append(stored(df, name))
        return tables[-1]

    spans = repeated_spans(docs, min_words, store).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    spans = stored(spans, "spans")
    # The spans rest on a table of their own.
    for table in tables:
        drop_stored(table)
    release(docs.sparkSession)
    joined = docs.join(spans, (F.col("doc_id").cast("long") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    rows = joined.select(F.col("_spans"), *[F.col(f"`{c}`") for c in docs.columns])
    place = docs.columns.index("text") + 1
    schema = arrow_schema(docs._jdf.schema().toDDL())

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for i, spans in enumerate(batch.column(0).to_pylist()):
                if spans:
                    data, kept, last = texts[i].encode("utf-8", "surrogatepass"), [], 0
                    for s in spans:
                        kept.append(data[last:max(last, s["start"])])
                        last = max(last, s["end"])
                    kept.append(data[last:])
                    texts[i] = b"".join(kept).decode("utf-8", "surrogatepass")
            columns = batch.columns[1:]
            columns[place - 1] = pa.array(texts, schema.field(place - 1).type)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    result = rows.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*[F.col(f"`{c}`") for c in docs.columns])
