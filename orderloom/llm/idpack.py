"""Token ids in fixed-width bit-packed blocks (operator 8).

Documents are laid out in ascending doc_id order over shards; a shard is one file, made of blocks. A block holds the ids
of whole documents back to back, each id in the fewest bits that the vocabulary needs, most significant bit first,
and where each of its documents begins. Any document is reached by its block and offset, and a block is unpacked by numpy at
once. The container is Parquet, so that files are written and committed by Spark on whatever store holds them:

    shard int, block int          place in the order
    first long, n_ids long        ids of the shard before the block, ids in it
    width int                     bits of an id
    doc_ids array<long>, starts array<long>    its documents and where they begin in the block
    packed binary                 ceil(n_ids * width / 8) bytes
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, drop_stored, per_batch, stored, texts_of
from .libids import library_ids

BLOCK_IDS = 262_144
# Ids of a shard at most, about; and how few are worth a shard of their own while there are fewer shards than partitions.
SHARD_IDS, SPREAD_IDS = 1 << 26, 1 << 22
# Shards whose places are sent to every task that reads blocks.
SENT_SHARDS = 250_000
SCHEMA = ("shard int, block int, first long, n_ids long, width int, doc_ids array<long>, starts array<long>, "
          "packed binary")


def width_of(size: int) -> int:
    """Fewest bits that hold every id below ``size``."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids (below 2**width) as a bit stream of ``width`` bits each."""
    octets = np.ascontiguousarray(ids, ">u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:
        return octets[:, 4 - width // 8:].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1)[:, 32 - width:]).tobytes()


def unpack(packed: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from the one at place ``start`` on, without reading what lies before."""
    if not count:
        return np.zeros(0, np.uint32)
    begin, end = start * width, (start + count) * width
    octets = np.frombuffer(packed, np.uint8)[begin // 8:-(-end // 8)]
    whole = np.zeros((count, 4), np.uint8)
    if width % 8 == 0:
        whole[:, 4 - width // 8:] = octets.reshape(count, width // 8)
    else:
        bits = np.unpackbits(octets)[begin % 8:begin % 8 + count * width]
        wide = np.zeros((count, 32), np.uint8)
        wide[:, 32 - width:] = bits.reshape(count, width)
        whole = np.packbits(wide, axis=1)
    return whole.view(">u4").ravel().astype(np.uint32)


def _narrow(size: int) -> str:
    """Numpy type that ids below ``size`` travel in."""
    return "<u2" if size <= 1 << 16 else "<u4"


def _encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, place, n_ids, ids): the ids of every text and its end, narrow; places tell rows of one doc_id apart."""

    def make():
        words = library_ids(path)
        kind, end = _narrow(max(words.size, end_id + 1)), np.array([end_id], "<u4").tobytes()

        def work(batch):
            ids = [np.frombuffer(words.encode(text.as_py()) + end, "<u4").astype(kind) for text in batch.column(1)]
            return {"doc_id": batch.column(0), "place": batch.column(2), "n_ids": [len(i) for i in ids], "ids": [i.tobytes() for i in ids]}

        return work

    rows = texts_of(docs).withColumn("place", F.monotonically_increasing_id())
    return per_batch(rows, make, "doc_id long, place long, n_ids long, ids binary")


def _blocks(size: int, block_ids: int):
    """Blocks of one shard, from its documents' ids in order."""
    schema, kind, width = arrow_schema(SCHEMA), _narrow(size), width_of(size)

    def block(shard, number, first, doc_ids, lengths, parts):
        ids = np.frombuffer(b"".join(parts), kind)
        starts = np.concatenate([[0], np.cumsum(lengths[:-1])]).astype(np.int64)
        row = {"shard": [shard], "block": [number], "first": [first], "n_ids": [len(ids)], "width": [width],
               "doc_ids": [doc_ids], "starts": [starts.tolist()], "packed": [pack(ids, width)]}
        return pa.RecordBatch.from_arrays([pa.array(row[f.name], f.type) for f in schema], schema=schema)

    def run(batches):
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, parts, held = [], [], [], 0
        for batch in batches:
            for doc_id, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and held + n > block_ids:
                    yield block(shard, number, first, doc_ids, lengths, parts)
                    number, first = number + 1, first + held
                    doc_ids, lengths, parts, held = [], [], [], 0
                doc_ids.append(doc_id)
                lengths.append(n)
                parts.append(ids.as_py())
                held += n
        if held:
            yield block(shard, number, first, doc_ids, lengths, parts)

    return run


def write_ids(docs: DataFrame, out: str, path: str, end_id: int, shards: int | None = None,
              block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, end it with ``end_id`` and write the shards to the folder ``out``.

    Missing texts are empty (the end id alone). Rows without doc_id come first; rows of one doc_id lie side by side. A text
    larger than a block makes a block of its own. Other columns are ignored; an empty table makes an empty folder.
    Texts are encoded where they are read; only their ids, two bytes each where the vocabulary allows, are stored and
    dealt to the shards, whose number follows from the ids there are unless it is given.
    """
    spark = docs.sparkSession
    rows = stored(_encoded(docs, path, end_id), "encoded", "zstd")
    if shards is None:
        total = rows.agg(F.sum("n_ids")).first()[0] or 0
        some = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SPREAD_IDS))
        shards = max(1, some, -(-total // SHARD_IDS))
    size = max(library_ids(path).size, end_id + 1)
    # Places break ties, so rows that share an id, or have none, are dealt to several shards as well.
    ordered = rows.repartitionByRange(shards, "doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "n_ids", "ids")
    ordered.mapInArrow(_blocks(size, block_ids), SCHEMA).write.option("compression", "zstd").parquet(out)
    drop_stored(rows)


def read_blocks(spark, out: str) -> DataFrame:
    """Blocks of a written folder, each with ``base``: the ids of all shards before its own."""
    blocks = spark.read.schema(SCHEMA).parquet(out)
    # One row a shard, so the unpartitioned window holds as many rows as there are files.
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")), "bases")
    return blocks.join(F.broadcast(base) if base.count() <= SENT_SHARDS else base, "shard")


def read_ids(spark, out: str) -> DataFrame:
    """(doc_id, start, ids) of every document: ids as an array, start the ids of all documents before it."""

    def make():
        def work(batch):
            rows = {"doc_id": [], "start": [], "ids": []}
            for b in batch.to_pylist():
                for doc_id, start, end in _spans(b):
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(b["base"] + b["first"] + start)
                    rows["ids"].append(unpack(b["packed"], b["width"], start, end - start))
            return rows

        return work

    return per_batch(read_blocks(spark, out), make, "doc_id long, start long, ids array<long>")


def _spans(block: dict):
    return zip(block["doc_ids"], block["starts"], [*block["starts"][1:], block["n_ids"]])


def read_digests(spark, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, unpacked from the blocks."""

    def make():
        def work(batch):
            rows = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for b in batch.to_pylist():
                ids = unpack(b["packed"], b["width"], 0, b["n_ids"]).astype("<u4")
                for doc_id, start, end in _spans(b):
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(b["base"] + b["first"] + start)
                    rows["n_tokens"].append(end - start)
                    rows["ids_crc32"].append(zlib.crc32(ids[start:end]))
            return rows

        return work

    return per_batch(read_blocks(spark, out), make, "doc_id long, start long, n_tokens long, ids_crc32 long")
