"""Nearest neighbours by randomly rotated one-bit codes (operator 10).

Vectors lie in lists, each around a centroid fitted on a bounded sample. A vector's difference to its centroid, padded by zeros
to at least ``BITS`` dimensions, is rotated by one random orthogonal matrix and stored as its signs, one bit a dimension, with two
scalars: its length and its inner product with its own signs. A query is rotated likewise and its components are rounded to
``PLANES`` bits; the inner product with a code is then a weighted sum of the bits that a plane and the code share. It is
estimated without bias, and its error is bounded with high probability. Only codes travel to the search:

1. In its nearest lists a query takes the vectors of least estimates, ``FIRST`` for each neighbour wanted; they are fetched by number and
   measured in double precision. The k-th least distance among them, one for all lists, is the query's limit.
2. In all lists that it visits, codes whose lower bound is not above the limit survive.
3. The survivors' vectors are fetched and measured likewise.

How many lists a query visits is set on the sample: the fewest that hold ``TARGET`` of its true neighbours.

Of equal vectors only the k + 1 of smallest id can be among anyone's k nearest (ties go to smaller ids), so copies beyond
those are left out first; nothing else is. Equal queries are searched once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import arrow_schema, stored

SAMPLE = 16_384  # vectors at most that centroids and visits are fitted on
TARGET = 0.99
BITS = 512  # least length of a code
PLANES = 6  # bits of a query's components
BLOCK = 32_768  # codes of a list that are searched in one task
SLICE = 4096  # codes that are compared at once
NEAR = 4  # the limit comes from one in so many of the lists visited
FIRST = 3  # vectors measured for each neighbour wanted, to set the limit
EPSILON = 3.0  # error bound in standard deviations of the estimate


@dataclass
class Index:
    """Centroids, the rotation (dimensions x bits), and the number of lists that a query visits."""

    centroids: np.ndarray
    rotation: np.ndarray
    visits: int


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, by inner products."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def fit(sample: np.ndarray, lists: int, k: int, seed: int = 11) -> Index:
    """Centroids by Lloyd's algorithm, and the visits that reach ``TARGET`` of the neighbours within the sample."""
    rng = np.random.default_rng(seed)
    n, dimensions = sample.shape
    lists = max(1, min(lists, n))
    centroids = sample[rng.choice(n, lists, replace=False)].copy()
    for _ in range(10):
        nearest = squared(sample, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=lists)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    nearest = squared(sample, centroids).argmin(1)
    asked = rng.choice(n, min(n, 256), replace=False)
    distance = squared(sample[asked], sample)
    distance[np.arange(len(asked)), asked] = np.inf
    true = np.argsort(distance, axis=1)[:, :min(k, n - 1)] if n > 1 else np.zeros((len(asked), 0), int)
    order = np.argsort(squared(sample[asked], centroids), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None, :].repeat(len(asked), 0), 1)
    needed = np.sort(np.take_along_axis(place, nearest[true], 1).ravel()) if true.size else np.zeros(1, int)
    visits = int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))) - 1)]) + 1
    bits = dimensions * -(-BITS // dimensions)
    # Rows of an orthogonal matrix: what the zeros of a padded vector would meet is left out.
    rotation = np.ascontiguousarray(np.linalg.qr(rng.normal(size=(bits, bits)))[0][:dimensions])
    # The whole corpus is denser than its sample, so neighbours are nearer; one list more covers the edge.
    return Index(centroids, rotation, min(lists, visits + 1))


def encode(vectors: np.ndarray, centroid: np.ndarray, rotation: np.ndarray):
    """(packed signs, length, correction) of the vectors' differences to the centroid."""
    difference = vectors - centroid
    length = np.sqrt((difference * difference).sum(1))
    unit = difference @ rotation / np.where(length > 0, length, 1)[:, None]
    signs = unit > 0
    correction = np.abs(unit).sum(1) / np.sqrt(unit.shape[1])
    return np.packbits(signs, axis=1), length, np.where(length > 0, correction, 1)


def words_of(codes: np.ndarray) -> np.ndarray:
    """Packed codes (n x bytes) as 64-bit words, a row a word."""
    n, size = codes.shape
    whole = np.zeros((n, -(-size // 8) * 8), np.uint8)
    whole[:, :size] = codes
    return np.ascontiguousarray(whole.view(np.uint64).T)


def bounds(codes, length, correction, query, centroid, rotation):
    """Lower and upper bounds of the squared distances of coded vectors to a query."""
    return bounds_of_words(words_of(codes), length, correction, (query - centroid) @ rotation)


def bounds_of_words(words, length, correction, y):
    """The same for codes as ``words_of`` gives them and a query's rotated difference to the centroid."""
    d = len(y)
    far = float(y @ y)
    least, step = y.min(), (y.max() - y.min()) / ((1 << PLANES) - 1) or 1.0
    levels = np.rint((y - least) / step).astype(np.uint8)
    # What rounding moves the query by; a code's signs have length one, so no estimate moves further.
    moved = np.linalg.norm(y - (least + step * levels))
    planes = words_of(np.packbits((levels >> np.arange(PLANES, dtype=np.uint8)[:, None]) & 1, axis=1)).T
    shared = np.bitwise_count(words & planes[:, :, None]).sum(axis=1, dtype=np.uint16)
    ones = np.bitwise_count(words).sum(axis=0, dtype=np.uint16)
    # Signs are twice the bits less one.
    inner = 2 * (step * ((1 << np.arange(PLANES)) @ shared) + least * ones) - (step * levels.sum(dtype=np.int64) + least * d)
    inner = inner / np.sqrt(d) / correction
    error = EPSILON * np.sqrt(far) * np.sqrt(np.maximum(1 - correction**2, 0)) / correction / np.sqrt(max(d - 1, 1))
    middle = length**2 + far - 2 * length * inner
    slack = 2 * length * (error + moved / correction) + 1e-5 * (length**2 + far)
    return middle - slack, middle + slack


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors with a component, none of them missing or not finite, not all zero; floats or doubles."""
    kind = vectors.schema["embedding"].dataType
    floats = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col("embedding") if floats else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~odd
                       & F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """A list column without missing rows as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


FOUND = "query long, number long, bound double"
CODES = "list int, number long, code binary, length double, correction double"


def _file(index):
    """Code of each (number, v) in the list of its nearest centroid."""
    schema = arrow_schema(CODES)

    def run(batches):
        made = index.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(1), batch.num_rows)
            nearest = squared(v, made.centroids).argmin(1)
            codes, length, correction = encode(v, made.centroids[nearest], made.rotation)
            columns = (nearest, batch.column(0), [c.tobytes() for c in codes], length, correction)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _visit(index, sizes: np.ndarray):
    """Lists of each (query, v, wanted), nearest first, and how many of them set its limit.

    Both hold as many vectors as are wanted, if there are as many.
    """
    schema = arrow_schema("query long, lists array<int>, near int")

    def run(batches):
        centroids, visits = index.value.centroids, index.value.visits
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(squared(matrix(batch.column(1), batch.num_rows), centroids), axis=1)
            wanted = batch.column(2).to_numpy(zero_copy_only=False)
            enough = np.minimum((np.cumsum(sizes[order], axis=1) < wanted[:, None]).sum(axis=1) + 1, len(centroids))
            taken = np.maximum(visits, enough)
            columns = (batch.column(0), [o[:n] for o, n in zip(order.astype(np.int32), taken)], np.maximum(-(-visits // NEAR), enough))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _search(index, made_of):
    """Hold each query of a block against the block's codes; rows come sorted by (list, block, role).

    ``made_of`` turns (query, wanted, limit, numbers, low, high) into the pair of columns of ``FOUND``.
    """
    schema = arrow_schema(FOUND)

    def run(batches):
        place, parts, held = None, [], None
        centroids, rotation = index.value.centroids, index.value.rotation
        for batch in batches:
            lists, blocks, roles, numbers = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            changed = (np.diff(lists) != 0) | (np.diff(blocks) != 0) | (np.diff(roles) != 0)
            edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(numbers)]
            out = []
            for s, e in zip(edges, edges[1:]):
                if s == e:
                    continue
                here = (int(lists[s]), int(blocks[s]))
                if here != place:
                    place, parts, held = here, [], None
                if roles[s] == 0:
                    code = np.frombuffer(b"".join(batch.column(4).slice(s, e - s).to_pylist()), np.uint8).reshape(e - s, -1)
                    length, correction = (batch.column(i).slice(s, e - s).to_numpy(zero_copy_only=False) for i in (5, 6))
                    parts.append((numbers[s:e], words_of(code), length, correction))
                    continue
                if not parts:
                    continue
                if held is None:
                    ids, words, length, correction = (np.concatenate(c, axis=-1) for c in zip(*parts))
                    held = [(ids[i:i + SLICE], np.ascontiguousarray(words[:, i:i + SLICE]), length[i:i + SLICE], correction[i:i + SLICE])
                            for i in range(0, len(ids), SLICE)]
                y = (matrix(batch.column(7).slice(s, e - s), e - s) - centroids[here[0]]) @ rotation
                wanted, limit = (batch.column(i).slice(s, e - s).to_numpy(zero_copy_only=False) for i in (8, 9))
                for i in range(e - s):
                    for ids, *codes in held:
                        out.append(made_of(numbers[s + i], wanted[i], limit[i], ids, *bounds_of_words(*codes, y[i])))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def least_estimates(query, wanted, limit, ids, low, high):
    """``FIRST`` vectors of least estimates for each neighbour wanted."""
    n = min(FIRST * int(wanted), len(ids))
    middle = (low + high) / 2
    kept = np.argpartition(middle, n - 1)[:n]
    return np.full(n, query), ids[kept], middle[kept]


def below_limit(query, wanted, limit, ids, low, high):
    """Codes that may be nearer than the limit."""
    kept = np.flatnonzero(low <= limit)
    return np.full(len(kept), query), ids[kept], low[kept]


@dataclass
class Search:
    """An index over vectors and the codes that it led to."""

    good: DataFrame  # vec_id, v: all rows that take part
    once: DataFrame  # number, vec_id, v: what queries are held against
    codes: DataFrame  # list, number, code, length, correction
    index: object  # broadcast Index
    sizes: np.ndarray  # codes of each list

    def queries(self, every: int, k: int) -> tuple[DataFrame, DataFrame]:
        """(query, v, wanted, lists, near) of the different query vectors, and (query, query_id, v) of the queries themselves."""
        mine = F.col("vec_id") % every == 0
        # A query's own vectors are found, too, so that many more are wanted.
        own = self.once.filter(mine).groupBy("vec_id").agg(F.count("*").alias("own"))
        asked = self.good.filter(mine).distinct().join(own, "vec_id", "left")
        wanted = asked.groupBy("v").agg((F.max(F.coalesce("own", F.lit(0))) + k).cast("long").alias("wanted"))
        different = stored(wanted.select(F.monotonically_increasing_id().alias("query"), "v", "wanted"), "queries")
        lists = different.mapInArrow(_visit(self.index, self.sizes), "query long, lists array<int>, near int")
        members = asked.select(F.col("vec_id").alias("query_id"), "v").join(different, "v").select("query", "query_id")
        return stored(different.join(lists, "query"), "visits"), members

    def held_against(self, queries: DataFrame, made_of) -> DataFrame:
        """``FOUND`` of (query, v, wanted, limit, lists)."""
        # A list larger than a block is dealt over several; their number is a row a list.
        blocks = self.codes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        none = lambda kind: F.lit(None).cast(kind)
        held = self.codes.join(blocks, "list").select(
            "list", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "number", "code",
            "length", "correction", none(queries.schema["v"].dataType).alias("v"), none("long").alias("wanted"), none("double").alias("limit"))
        visits = queries.withColumn("list", F.explode("lists")).join(blocks, "list").select(
            "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"),
            F.col("query").alias("number"), none("binary").alias("code"), none("double").alias("length"), none("double").alias("correction"),
            "v", "wanted", "limit")
        rows = held.unionByName(visits).repartition("list", "block").sortWithinPartitions("list", "block", "role")
        return rows.mapInArrow(_search(self.index, made_of), FOUND)

    def measured(self, pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """(query, wanted, vec_id, score) of pairs (query, number): distances in double precision."""
        double = lambda x: x.cast("double")
        square = F.zip_with("v", "q", lambda a, b: (double(a) - double(b)) * (double(a) - double(b)))
        both = pairs.select("query", "number").join(self.once, "number").join(queries.select("query", "wanted", F.col("v").alias("q")), "query")
        return both.select("query", "wanted", "vec_id", F.sqrt(F.aggregate(square, F.lit(0.0), lambda total, x: total + x)).alias("score"))

    def survivors(self, queries: DataFrame) -> DataFrame:
        """(query, number) of all codes whose lower bound is not above their query's limit."""
        near = queries.withColumn("lists", F.slice("lists", F.lit(1), F.col("near"))).withColumn("limit", F.lit(None).cast("double"))
        best = Window.partitionBy("query").orderBy("bound", "number")
        first = self.held_against(near, least_estimates).join(queries.select("query", "wanted"), "query") \
            .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= FIRST * F.col("wanted"))
        nearer = Window.partitionBy("query").orderBy("score", "vec_id")
        limits = self.measured(first, queries).withColumn("n", F.row_number().over(nearer)).filter(F.col("n") == F.col("wanted")) \
            .select("query", (F.col("score") * F.col("score") * (1 + 1e-9)).alias("limit"))
        limited = queries.join(limits, "query", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
        return self.held_against(limited, below_limit).select("query", "number")


def indexed(vectors: DataFrame, k: int) -> Search | None:
    """Fit an index on a bounded sample and store the code of every vector; None if no vector can take part."""
    good = usable(vectors)
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return None
    good = good.filter(F.size("v") == sizes["d"])
    # Queries keep all their rows; only what they are held against loses copies.
    key = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    once = stored(good.distinct().withColumn("n", F.row_number().over(key)).filter(F.col("n") <= k + 1)
                  .select(F.monotonically_increasing_id().alias("number"), "vec_id", "v"), "vectors")
    total = once.count()
    drawn = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) < int(min(1.0, SAMPLE / total) * (1 << 20)) + 1
    sample = np.array([r["v"] for r in once.filter(drawn).select("vec_id", "v").orderBy("vec_id", "v").toLocalIterator()], float)
    if not len(sample):
        sample = np.array([r["v"] for r in once.select("v").limit(SAMPLE).toLocalIterator()], float)
    made = fit(sample, int(min(1024, total**0.5)), k)
    index = vectors.sparkSession.sparkContext.broadcast(made)  # at most 1024 centroids and one rotation
    codes = stored(once.select("number", "v").mapInArrow(_file(index), CODES), "codes")
    counts = np.zeros(len(made.centroids), np.int64)
    for r in codes.groupBy("list").count().collect():
        counts[r["list"]] = r["count"]
    return Search(good, once, codes, index, counts)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row whose vec_id is divisible by ``every``.

    ``vectors`` has vec_id and embedding. Vectors that are missing, zero or hold a missing or non-finite component, rows
    without id, and vectors of another dimension than most take no part. Copies of a row (same id and vector) count
    once; vectors under one id are candidates of their own, and none of them is its own query's neighbour. Every query visits lists
    that hold k others, if there are as many. score is the Euclidean distance in double precision; ties go to the smaller id. Other columns are ignored.
    """
    search = indexed(vectors, k)
    if search is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries, members = search.queries(every, k)
    measured = search.measured(search.survivors(queries), queries)
    first = Window.partitionBy("query").orderBy("score", "vec_id")
    kept = measured.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= F.col("wanted")).drop("n", "wanted")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return members.join(kept, "query").filter(F.col("vec_id") != F.col("query_id")) \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
