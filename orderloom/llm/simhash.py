"""SimHash near-duplicates by multi-index hashing (operator 4).

A fingerprint has a bit set where more than half of the text's shingle hashes have it. Fingerprints that differ in at most
three bits are linked. Split into two halves, one half of such a pair differs in at most one bit. So each distinct fingerprint is filed
under both halves, and each also visits, for each half, the Hamming ball of radius one around it. Of two halves that
differ in one bit only the one with the bit set has to visit the other, which halves the balls. What meets in a table
entry is verified by its complete distance.

An entry with more than ``ENTRY_ROWS`` rows is split once more by the same rule, on the quarters of the other half; then rows
differ in one quarter only, so an entry holds a bounded number of fingerprints whatever the corpus. Entries put out links
that span their groups, never all pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import among_keys, key_bits
from .common import arrow_schema, drop_stored, per_batch, release, stored, texts_of
from .components import components

SEED = 42
RADIUS = 3
ENTRY_ROWS = 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACE = np.arange(8, dtype=np.uint16) * 256


def shingles(text: str | None, words: int) -> list[bytes]:
    """Runs of so many words, repeats included; the whole sequence if it is shorter, none without a word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [joined]
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return list(map(joined.__getitem__, map(slice, starts[:len(starts) - words + 1].tolist(), ends[words - 1:].tolist())))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle as unsigned integers."""
    found = shingles(text, words)
    return np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(SEED)), np.uint64, len(found))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit integer; 0 for none."""
    if not len(hashes):
        return 0
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + _PLACE).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits((2 * counts > len(hashes)).ravel()).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row of (doc_id, text)."""

    def make():
        def work(batch):
            return {"doc_id": batch.column("doc_id"),
                    "fp": [fingerprint(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]}

        return work

    return per_batch(texts_of(docs), make, "doc_id long, fp long")


def _ball(value, bits: int):
    """The value, and it with each of its set bits cleared, as an array column."""
    flips = [F.when(value.bitwiseAND(F.lit(1 << b)) != 0, value.bitwiseXOR(F.lit(1 << b))) for b in range(bits)]
    return F.array_compact(F.array(value, *flips))


def _entries(prints: DataFrame) -> DataFrame:
    """(half, key, fp): every fingerprint under both its halves and the balls around them."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    halves = F.array(*[F.struct(F.lit(h).alias("half"), _ball(v, 32).alias("keys")) for h, v in ((0, low), (1, high))])
    return prints.select("fp", F.explode(halves).alias("h")).select(
        F.col("h.half").alias("half"), F.explode("h.keys").alias("key"), "fp")


def spanning_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius that connect whatever is connected among the given distinct fingerprints.

    Breadth first: a fingerprint takes along all that are near it and not yet reached, so there are fewer links than
    fingerprints.
    """
    left = np.sort(fps)
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                found = left[near]
                a.extend([at] * len(found))
                b.extend(found.tolist())
                queue.extend(found)
                left = left[~near]
    return np.array(a, np.uint64), np.array(b, np.uint64)


LINKS = "a long, b long, half int, key long, hot boolean"


def _meet(radius: int, most: int | None):
    """Links within each entry of a partition sorted by its key columns; of a larger entry than ``most`` the rows, as hot.

    Rows are (half, key, fp), or (half, key, quarter, part, fp) where nothing is too large any more.
    """
    schema = arrow_schema(LINKS)

    def out(a, b, half, key, hot):
        n = len(a)
        arrays = [a.view(np.int64), b.view(np.int64), np.full(n, half), np.full(n, key), np.full(n, hot)]
        return pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) for x, f in zip(arrays, schema)], schema=schema)

    def close(name, parts, hot):
        fps = np.concatenate(parts)
        if hot:
            return out(fps, fps, name[0], name[1], True) if len(fps) else None
        fps = np.unique(fps)
        if len(fps) < 2:
            return None
        a, b = spanning_links(fps, radius)
        return out(a, b, name[0], name[1], False) if len(a) else None

    def run(batches):
        held, held_rows, name, hot = [], 0, None, False
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys, fps = columns[:-1], columns[-1].view(np.uint64)
            if not len(fps):
                continue
            changed = np.zeros(len(fps), bool)
            changed[0] = True
            for k in keys:
                changed[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(changed)
            ends = np.append(starts[1:], len(fps))
            for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
                same = i == 0 and name == tuple(int(k[s]) for k in keys)
                if not same:
                    if held_rows > 1 or hot:
                        result = close(name, held, hot)
                        if result is not None:
                            yield result
                    # Most entries hold one row, and are complete.
                    if e - s == 1 and e < len(fps):
                        held, held_rows, name, hot = [], 0, None, False
                        continue
                    held, held_rows, name, hot = [], 0, tuple(int(k[s]) for k in keys), False
                held.append(fps[s:e])
                held_rows += e - s
                if most is not None and held_rows > most:
                    hot = True
                    yield close(name, held, True)
                    held = [np.zeros(0, np.uint64)]
        if held_rows > 1 or hot:
            result = close(name, held, hot)
            if result is not None:
                yield result

    return run


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, entry_rows: int = ENTRY_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all within ``radius`` (at most 3) bits of one another."""
    keys = ["half", "key"]
    met = stored(
        _entries(prints).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_meet(radius, entry_rows), LINKS), "met")
    # Rows of too large entries, split by the quarters of the half that the key doesn't hold.
    other = F.expr("CASE WHEN half = 0 THEN shiftrightunsigned(a, 32) ELSE a & 4294967295L END")
    quarters = F.array(*[F.struct(F.lit(q).alias("quarter"), _ball(v, 16).alias("parts"))
                         for q, v in ((0, other.bitwiseAND(F.lit(0xFFFF))), (1, F.shiftright(other, 16)))])
    fine = met.filter("hot").select(*keys, F.col("a").alias("fp"), F.explode(quarters).alias("q")).select(
        *keys, F.col("q.quarter").alias("quarter"), F.explode("q.parts").alias("part"), "fp")
    keys = keys + ["quarter", "part"]
    rest = fine.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_meet(radius, None), LINKS)
    return met.filter("NOT hot").select("a", "b").unionByName(rest.select("a", "b"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of (doc_id, text).

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id reachable over links, the row's own included.
    Texts without a word (missing, empty, blanks) have fingerprint zero and are linked like others. Rows without
    doc_id take part and get the component's smallest id, which is missing if no row of it has one. Repeated rows give a row
    each; other columns are ignored; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, words), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(fingerprint_links(prints.select("fp"), radius))
    named = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = stored(named.join(least, "root").select("fp", "component_id"), "classes")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- texts of a given similarity ---------------------------------------------

BANDS, BAND_SHINGLES = 20, 4
_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(1, 1 << 63, BANDS * BAND_SHINGLES, dtype=np.uint64) | np.uint64(1)
SKETCH_SLACK = 0.2  # how far the sketch may lie below the wanted similarity before a pair is compared in full
ROUNDING = 1e-6  # left to fractions of a number of shingles


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Least value of each of 80 permutations of a text's shingle hashes."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        h = hashes[at:at + 1024]
        h = h ^ (h >> np.uint64(29))
        np.minimum(least, (h[:, None] * _FACTORS[None, :]).min(axis=0), out=least)
    return least


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, copy, fp, bands, sketch, size): a digest of the text's words, the whole text's fingerprint, fingerprints of
    samples of four shingles each, and the number of shingles.

    A sample takes the shingles that come first in four orders, so two texts of similarity s take the same one with
    probability s**4, and then have equal fingerprints of it.
    """

    def make():
        def work(batch):
            rows = {"doc_id": batch.column("doc_id"), "copy": [], "fp": [], "bands": [], "sketch": [], "size": []}
            for text in batch.column("text").to_pylist():
                found = shingles(text, words)
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(SEED)), np.uint64, len(found))
                least = sketch(hashes)
                rows["copy"].append(xxhash.xxh3_128_digest(b"\n".join(found)))
                rows["fp"].append(fingerprint(hashes))
                octets = least.astype("<u8").tobytes()
                step = 8 * BAND_SHINGLES
                rows["bands"].append([xxhash.xxh64_intdigest(octets[i:i + step], i) - (1 << 63)
                                      for i in range(0, len(octets), step)])
                rows["sketch"].append((least & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                rows["size"].append(len(found))
            return rows

        return work

    return per_batch(texts_of(docs), make, "doc_id long, copy binary, fp long, bands array<long>, sketch binary, size long")


def _agreement(left: str, right: str, schema: str):
    """Share of equal sketch values of each row's two sketches, before the other columns."""
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(n).to_pylist()), "<u4").reshape(batch.num_rows, -1) for n in (left, right))
            columns = [batch.column("a"), batch.column("b"), pa.array((a == b).mean(axis=1) if batch.num_rows else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return run


def _similar(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have at least that Jaccard similarity, computed from the whole texts."""
    compared = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def make():
        def work(batch):
            kept: dict[str, list] = {"a": [], "b": []}
            rows = zip(*[batch.column(n).to_pylist() for n in ("a", "b", "ta", "tb")])
            for a, b, ta, tb in rows:
                x, y = set(shingles(ta, words)), set(shingles(tb, words))
                common = len(x & y)
                if common >= similarity * (len(x) + len(y) - common):
                    kept["a"].append(a)
                    kept["b"].append(b)
            return kept

        return work

    return per_batch(compared, make, "a long, b long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not connected yet."""
    for end in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return pairs.filter("coalesce(root_a, a) <> coalesce(root_b, b)").select("a", "b")


def joining_links(ids, labels, sides, places, sets, similarity: float) -> tuple[list[int], list[int]]:
    """Links of at least that similarity which connect all such pairs of documents, given by the hashes of their shingles.

    Documents of one label are connected already. If there are two sides, pairs are of one side and the other, else all.
    ``places`` says where in each document's order the shingle stands that brings all of them together (from 1): a pair that
    has it as the first in common shares no more than what follows, and is left to another shingle where that is too little.
    A link joins two labels, so there are fewer links than labels.
    """
    flat = np.concatenate(sets)
    _, flat = np.unique(flat, return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    follow = sizes - places + 1
    starts = np.cumsum(sizes) - sizes
    marked = np.zeros(int(flat.max()) + 1, np.int32)
    label = np.unique(labels, return_inverse=True)[1]
    second = sides == 1
    share = similarity / (1 + similarity)
    a, b = [], []
    for x in np.flatnonzero(~second).tolist():
        left = label != label[x]
        if second.any():
            left &= second
        else:
            left[:x] = False
        left &= np.minimum(follow, follow[x]) >= share * (sizes + sizes[x]) - ROUNDING
        left = np.flatnonzero(left)
        if not len(left):
            continue
        own = flat[starts[x]:starts[x] + sizes[x]]
        marked[own] = 1
        n = sizes[left]
        at = np.arange(n.sum()) + np.repeat(starts[left] - (np.cumsum(n) - n), n)
        common = np.add.reduceat(marked[flat[at]], np.cumsum(n) - n)
        marked[own] = 0
        found = left[common >= similarity * (sizes[x] + n - common)]
        joined, one = np.unique(label[found], return_index=True)
        a.extend([int(ids[x])] * len(joined))
        b.extend(ids[found[one]].tolist())
        label[np.isin(label, joined)] = label[x]
    return a, b


def _search_entries(similarity: float):
    """``joining_links`` of each task of a partition sorted by task; rows are (task, side, root, doc_id, place, hashes)."""
    schema = arrow_schema("a long, b long")

    def close(parts):
        rows = pa.Table.from_batches(parts)
        side, root, ids, places = (rows.column(i).to_numpy() for i in (1, 2, 3, 4))
        sets = [np.frombuffer(x, "<i8") for x in rows.column(5).to_pylist()]
        a, b = joining_links(ids, root, side, places, sets, similarity)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    def run(batches):
        held, name = [], None
        for batch in batches:
            tasks = batch.column(0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)]
            for s, e in zip(edges, edges[1:]):
                if e > s and tasks[s] != name:
                    if held:
                        yield close(held)
                    held, name = [], tasks[s]
                if e > s:
                    held.append(batch.slice(s, e - s))
        if held:
            yield close(held)

    return run


def meeting_places(sets: DataFrame, similarity: float, store=stored) -> DataFrame:
    """(shingle, doc_id, root, size, place): where documents (doc_id, root, shingles) of two roots meet if they are similar.

    A document's shingles are ordered by how many documents have them, those that one root alone has before all others. Two
    documents of n and m shingles that are similar share s / (1 + s) of n + m, so the first that they share stands early enough
    in both; a document is filed under no later one, and under none of its root alone. What is made of a common passage
    and more than a fifth of its own is in no entry, however many have the passage.
    """
    spread = sets.select("doc_id", "root", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    common = spread.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    ordered = spread.join(common.select("shingle", "n"), "shingle").groupBy("doc_id", "root", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("known"))
    alone = F.col("size") - F.size("known")
    early = (F.col("size") - F.ceil(F.col("size") * similarity - ROUNDING) - alone + 1).cast("int")
    filed = store(ordered.withColumn("early", early).filter("early > 0").select(
        "doc_id", "root", "size", alone.alias("alone"), F.posexplode(F.slice("known", F.lit(1), F.col("early"))).alias("k", "e")).select(
        F.col("e.shingle").alias("shingle"), "doc_id", "root", "size", (F.col("alone") + F.col("k") + 1).alias("place")), "filed")
    smallest = filed.groupBy("shingle").agg(
        F.min("size").alias("smallest"), F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    enough = similarity / (1 + similarity) * (F.col("size") + F.col("smallest")) - ROUNDING
    return filed.join(smallest.select("shingle", "smallest"), "shingle").filter(F.col("size") - F.col("place") + 1 >= enough).drop("smallest")


def _within_entries(banded: DataFrame, roots: DataFrame, texts: DataFrame, words: int, similarity: float, block: int, store=stored) -> DataFrame:
    """Links (a, b) that connect all pairs of that similarity within the entries (band, value) of ``banded``.

    ``texts`` has the text of each of their documents, once.
    Entries whose documents are connected already are left alone. The documents of the others meet by the shingles that
    ``meeting_places`` files them under. Of those that meet, the documents of a root form blocks of
    about ``block`` shingles, small roots share blocks, and each block is searched against each one that is not of the
    same root, in a task of its own.
    """
    entry = ["band", "value"]
    rooted = store(banded.join(roots, F.col("doc_id") == F.col("node"), "left").select(
        *entry, "doc_id", F.coalesce("root", "doc_id").alias("root")), "entries")
    # Up to three documents have been compared one by one.
    apart = rooted.groupBy(*entry).agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")).filter(
        "least < most AND n > 3")
    asked = rooted.join(apart.select(*entry), entry, "left_semi").select("doc_id", "root").distinct()

    def make():
        def work(batch):
            return {"doc_id": batch.column("doc_id"), "root": batch.column("root"),
                    "shingles": [np.unique(shingle_hashes(t, words)).view(np.int64) for t in batch.column("text").to_pylist()]}

        return work

    rows = texts.join(asked, "doc_id").select("doc_id", "root", "text")
    sets = store(per_batch(rows, make, "doc_id long, root long, shingles array<long>").filter(F.size("shingles") > 0), "sets")
    met = store(meeting_places(sets, similarity, store), "met")
    groups = store(met.groupBy("shingle", "root").agg(F.sum("size").alias("own")), "groups")
    apart = groups.groupBy("shingle").agg(F.sum("own").alias("all"), F.count("*").alias("roots")).filter("roots > 1").drop("roots")
    parts = groups.join(apart, "shingle").select(
        "shingle", "root", (F.col("own") > block).alias("alone"),
        F.ceil(F.when(F.col("own") > block, F.col("own")).otherwise(F.col("all")) / block).alias("blocks"))
    drawn = F.pmod(F.xxhash64(F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("root"))), F.col("blocks"))
    members = store(met.join(parts, ["shingle", "root"]).select(
        "shingle", "doc_id", "root", "place", F.when(F.col("alone"), F.col("root")).alias("only"), drawn.alias("part")).withColumn(
        "block", F.xxhash64("only", F.col("only").isNull(), "part")), "members")
    blocks = members.select("shingle", "block", "only").distinct()
    left, right = (blocks.select("shingle", F.col("block").alias(n), F.col("only").alias(f"only_{n}")) for n in ("x", "y"))
    tasks = left.join(right, "shingle").filter(
        "x <= y AND NOT coalesce(only_x = only_y, false)").select(
        "shingle", F.xxhash64("shingle", "x", "y").alias("task"), F.explode(F.when(
            F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("block"), F.lit(0).alias("side")))).otherwise(F.array(
                F.struct(F.col("x").alias("block"), F.lit(0).alias("side")),
                F.struct(F.col("y").alias("block"), F.lit(1).alias("side"))))).alias("p")).select(
        "shingle", F.col("p.block").alias("block"), F.col("p.side").alias("side"), "task")

    def packed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([np.asarray(x, "<i8").tobytes() for x in batch.column(1).to_pylist()], pa.binary())],
                schema=narrow)

    narrow = arrow_schema("doc_id long, hashes binary")
    hashes = sets.select("doc_id", "shingles").mapInArrow(packed, "doc_id long, hashes binary")
    rows = members.join(tasks, ["shingle", "block"]).join(hashes, "doc_id").select(
        "task", "side", "root", "doc_id", "place", "hashes")
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(_search_entries(similarity), "a long, b long")


ENTRY_SHINGLES = 1 << 18  # of the documents that are searched together, about


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, block: int = ENTRY_SHINGLES) -> DataFrame:
    """(doc_id, component_id) of every document that is linked to another; component_id is the smallest of its group.

    Documents are linked if their sets of shingles have a Jaccard similarity of at least ``similarity``, which is computed
    in full for each link; texts without a word are alike. Texts of the same words are one from the start, so that only
    the smallest id of each goes on. Candidates are fingerprints within three bits of each other
    (``fingerprint_links``), and documents that share the fingerprint of a sample of shingles: within such an entry each is
    held against two, drawn anew for each of the 20 samples, so entries of up to three documents are complete and larger
    ones give at most twice as many candidates as they have rows.

    Of a document's candidates one is compared first; of the others only those that it is not connected to by then. The
    documents of entries that are not all connected by then are searched whole, by the shingles that two similar ones
    must share (``meeting_places``).

    Sketches are dropped once the candidates are known, and each step's shuffle files go before the next large one. Texts are
    fetched once, those of all candidates and crowded entries; a filter of their ids keeps most others out of that shuffle.
    Rows without doc_id are left out; repeated rows are one document (of two texts under one id, one is taken).
    """
    tables: list[DataFrame] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        tables.append(stored(df, name))
        return tables[-1]

    sketched = stored(sketches(docs.filter("doc_id IS NOT NULL"), words), "sketches")
    ids = store(sketched.groupBy("doc_id").agg(F.min("copy").alias("copy")), "ids")
    leaders = ids.groupBy("copy").agg(F.min("doc_id").alias("leader"), F.count("*").alias("copies"))
    same = store(ids.join(leaders.filter("copies > 1"), "copy").filter("doc_id > leader").select("doc_id", "leader"), "same")
    made = stored(sketched.join(leaders.select("copy", F.col("leader").alias("doc_id")), ["copy", "doc_id"], "left_semi")
                  .dropDuplicates(["doc_id"]).drop("copy"), "leaders")
    drop_stored(sketched)
    release(docs.sparkSession)
    prints = store(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    near = fingerprint_links(prints.select("fp"))
    across = near.join(prints.select(F.col("fp").alias("a"), F.col("least").alias("la")), "a").join(
        prints.select(F.col("fp").alias("b"), F.col("least").alias("lb")), "b").select(
        F.col("la").alias("a"), F.col("lb").alias("b"))
    banded = made.select("doc_id", F.posexplode(F.concat("bands", F.array("fp"))).alias("band", "value"))
    drawn = F.struct(F.xxhash64("doc_id", "band").alias("h"), F.col("doc_id").alias("id"))
    heads = banded.groupBy("band", "value").agg(
        F.min(drawn).alias("one"), F.max(drawn).alias("two"), F.count("*").alias("n")).filter("one.id <> two.id")
    shared = store(banded.join(heads, ["band", "value"]).select(
        "band", "value", "doc_id", F.col("one.id").alias("one"), F.col("two.id").alias("two"), "n"), "shared")
    release(docs.sparkSession)
    sampled = shared.select(F.col("doc_id").alias("a"), F.explode(F.array("one", "two")).alias("b"))
    pairs = across.unionByName(sampled).filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # The sketch drops what is far from similar; the rest is compared in full.
    both = pairs.join(made.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")), "a").join(
        made.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "sa", "sb")
    ddl = "a long, b long, agreement double"
    likely = store(both.mapInArrow(_agreement("sa", "sb", ddl), ddl).filter(
        F.col("agreement") >= similarity - SKETCH_SLACK).select("a", "b"), "likely")
    drop_stored(made)
    release(docs.sparkSession)
    # Entries of up to three documents give candidates only.
    crowded = shared.filter("n > 3").select("band", "value", "doc_id")
    named = store(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(crowded.select("doc_id")).distinct(), "named")
    asked = among_keys(texts_of(docs), named, {"doc_id": "doc_id"}, key_bits(docs))
    texts = store(asked.join(named, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    release(docs.sparkSession)
    # One by a hash, so that the candidates of a large entry are spread over those drawn for it.
    first = store(likely.groupBy("a").agg(F.min_by("b", F.xxhash64("a", "b")).alias("b")), "first")
    roots = store(components(_similar(first, texts, words, similarity)), "roots")
    later = store(_apart(likely.join(first, ["a", "b"], "left_anti"), roots), "later")
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
        _similar(later, texts, words, similarity))
    roots = store(components(links), "roots")
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
        _within_entries(crowded, roots, texts, words, similarity, block, store)).unionByName(
        same.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")))
    groups = components(links).select(F.col("node").alias("doc_id"), F.col("root").alias("component_id"))
    # The groups rest on tables of their own.
    for table in tables:
        drop_stored(table)
    release(docs.sparkSession)
    return groups


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs less all but the smallest doc_id of each group of similar texts; repeated rows stay once.

    Different texts under one id are documents of their own: one of them goes by the id, the others count as larger than
    every id below 2**62 and are told by 62 bits of a hash. Rows without doc_id stay as they are.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digests = docs.filter("doc_id IS NOT NULL").groupBy(doc_id.alias("_id")).agg(
        F.min(F.xxhash64(text)).alias("_one"), F.max(F.xxhash64(text)).alias("_other"), F.count("*").alias("_n"))
    shared = stored(digests.filter("_n > 1").select("_id", "_one", "_n", (F.col("_one") < F.col("_other")).alias("_differ")), "shared")
    named = docs.withColumn("_key", doc_id)
    if not shared.filter("_differ").isEmpty():
        other = F.col("_differ") & (F.xxhash64(text) != F.col("_one"))
        own = F.xxhash64(doc_id, text).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        named = docs.join(shared, doc_id == F.col("_id"), "left").withColumn(
            "_key", F.when(other, own).otherwise(doc_id)).select(*[F.col(f"`{c}`") for c in docs.columns], "_key")
    groups = similar_groups(named.select(F.col("_key").alias("doc_id"), text.alias("text")), words, similarity)
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias("_gone"))
    rest = named.join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    if shared.isEmpty():
        return rest.drop("_key")
    twice = shared.select(F.col("_id").alias("_twice"))
    again = doc_id == F.col("_twice")
    return rest.join(twice, again, "left_anti").unionByName(
        rest.join(twice, again, "left_semi").dropDuplicates(["_key"])).drop("_key")
