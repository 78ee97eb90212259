"""Best-fit packing with certified bin counts (operator 6).

Texts become pieces of at most ``capacity`` tokens; the pieces, which carry lengths only, are dealt evenly over partitions and
each partition is packed best-fit decreasing. Dual-feasible functions give a lower bound of each partition's number of
sequences; one that meets its bound is certified and done. The sequences of the others that are not full are opened,
their documents are exchanged between those partitions, and packing runs again, as long as that saves sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_schema, per_batch, stored, texts_of
from .libids import library_ids

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", part int, bin int, offset long, waste long, gap long"


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every text: its ids and the end id, cut every ``capacity`` tokens. A missing text is the end id alone."""

    def make():
        words = library_ids(path)
        end = np.array([end_id], "<u4").tobytes()

        def work(batch):
            rows: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(piece)
                    rows["start"].append(at // 4)
                    rows["length"].append(len(part) // 4)
                    rows["ids_crc32"].append(zlib.crc32(part))
            return rows

        return work

    return per_batch(texts_of(docs), make, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given (descending) order, and the room left in each bin.

    Open bins are stacked by the room they have left, and one integer holds a bit for each room that has a bin; the
    tightest bin that a length fits into is its lowest set bit from that length on.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used, bins, offsets, room_of = 0, 0, [], [], []
    for length in lengths.tolist():
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at, used = capacity, used, used + 1
            room_of.append(capacity)
        bins.append(at)
        offsets.append(capacity - room)
        room -= length
        room_of[at] = room
        if room:
            by_room[room].append(at)
            rooms |= 1 << room
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(room_of, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int, steps: int = 24) -> int:
    """Fewest bins that any packing needs, by two families of dual-feasible functions over the lengths.

    Such a function f has sum f(x) <= 1 for every set that fits a bin, so sum f over all lengths bounds the bins from
    below. First family, for k = 1 ... steps: x/C where (k+1)x/C is whole, else floor((k+1)x/C)/k. Second, for each
    threshold e up to C/2: 0 below e, x/C between, 1 above C-e.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int(counts @ x) // capacity)
    for k in range(1, steps + 1):
        scaled = (k + 1) * x
        # In units of 1 / (k * capacity), exact in integers.
        value = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)
        best = max(best, -(-int(counts @ value) // (k * capacity)))
    number, total = np.cumsum(counts), np.cumsum(counts * x)
    e = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    between = total[capacity - e] - total[e - 1]
    return max(best, int((-(-(large * capacity + between) // capacity)).max(initial=0)))


def _packer(capacity: int):
    """Pack the pieces of one partition; rows come out with their place and the partition's gap to its bound."""

    schema = arrow_schema(PLACED)

    def run(batches):
        held = pa.Table.from_batches(list(batches), schema=pa.schema(list(schema)[:5]))
        if not held.num_rows:
            return
        held = held.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = held.column("length").to_numpy()
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        gap = len(rooms) - lower_bound(lengths, capacity)
        n = len(lengths)
        part = TaskContext.get().partitionId()
        added = [np.full(n, part), bins, offsets, rooms[bins], np.full(n, gap)]
        columns = [held.column(i) for i in range(5)] + [pa.chunked_array([pa.array(a)]) for a in added]
        whole = pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
        yield from whole.to_batches(max_chunksize=10_000)

    return run


def pack_pieces(pieces: DataFrame, capacity: int, per_partition: int = 50_000, rounds: int = 5) -> DataFrame:
    """Pieces with sequence_id and offset; no sequence holds more than ``capacity`` tokens.

    ``pieces`` must be stored (it is read more than once) and have lengths from 1 to ``capacity``. Partitions hold about
    ``per_partition`` pieces whatever the input's size. A repacking is taken only if it needs fewer sequences.
    """

    def place(rows: DataFrame, n: int) -> DataFrame:
        # Dealt in turn: even partitions, whatever ids recur.
        return stored(rows.repartition(max(1, -(-n // per_partition))).mapInArrow(_packer(capacity), PLACED), "packed")

    def bins(rows: DataFrame) -> int:
        return rows.filter("offset = 0").count()

    names = StructType.fromDDL(PIECES).names
    done: list[DataFrame] = []
    placed = place(pieces, pieces.count())
    for number in range(rounds):
        numbered = placed.withColumn("sequence_id", F.expr(f"({number}L << 56) | (cast(part as long) << 24) | bin"))
        is_open = (F.col("gap") > 0) & (F.col("waste") > 0)
        opened = numbered.filter(is_open)
        n, before = opened.count(), bins(opened)
        again = place(opened.select(*names), n) if n and number + 1 < rounds else None
        if again is None or bins(again) >= before:
            done.append(numbered)
            break
        done.append(numbered.filter(~is_open))
        placed = again
    result = done[0]
    for rows in done[1:]:
        result = result.unionByName(rows)
    return result.select(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of all rows of (doc_id, text).

    Missing and empty texts are one piece of the end id. Rows without doc_id and repeated rows are packed like others;
    other columns are ignored; an empty table gives no rows.
    """
    return pack_pieces(stored(pieces_of(docs, path, capacity, end_id), "pieces"), capacity, **options)
