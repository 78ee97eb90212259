"""Centroid clustering by progressive search over Walsh-Hadamard coefficients (operator 12).

Vectors of 64 components become integers, and these their Walsh-Hadamard coefficients, an exact integer transform that multiplies
every squared distance by 64. Coefficients are in order of their sign changes, coarse ones first. The
squared differences of the first few bound a distance from below: a vector takes the centroid that is nearest by them, its whole
distance is the mark, and the other centroids go on to finer coefficients only while they are not strictly worse than that. Those
left have all 64 and ties go to the smaller number, so the answer is that of the plain search.

The transform is linear, so sums of a cluster are summed coefficients and are turned back exactly. A round is one pass over
the stored coefficients; tasks put out sums per cluster, and of these at most 64 numbers per centroid reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, stored

DIMS = 64
SCALE = 256
# Below this a squared distance times 64 fits into 64 bits.
LIMIT = 1 << 24
STAGES = (4, 8, 16, 32, 64)
BLOCK = 2048


def _in_order() -> np.ndarray:
    """Places of the coefficients by the sign changes of their pattern."""
    signs = np.array([[bin(r & c).count("1") & 1 for c in range(DIMS)] for r in range(DIMS)])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


ORDER = _in_order()


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows of 64, coarse ones first."""
    out = rows.astype(np.int64)
    half = 1
    while half < DIMS:
        pairs = out.reshape(len(out), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), DIMS)
        half *= 2
    return out[:, ORDER]


def turned_back(sums: list[int]) -> list[int]:
    """The integers whose coefficients these are; they may exceed 64 bits."""
    values = [0] * DIMS
    for place, value in zip(ORDER.tolist(), sums):
        values[place] = value
    half = 1
    while half < DIMS:
        values = [values[i] + values[i + half] if not i & half else values[i - half] - values[i] for i in range(DIMS)]
        half *= 2
    return [v // DIMS for v in values]


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance, from the coefficients of both."""
    numbers, distances = [], []
    for at in range(0, len(rows), BLOCK):
        x = rows[at:at + BLOCK]
        done = STAGES[0]
        coarse = np.zeros((len(x), len(centroids)), np.int64)
        for i in range(done):
            coarse += (x[:, i, None] - centroids[None, :, i]) ** 2
        mark = ((x - centroids[coarse.argmin(axis=1)]) ** 2).sum(axis=1)
        row, number = np.nonzero(coarse <= mark[:, None])
        total = coarse[row, number]
        for stage in STAGES[1:]:
            total = total + ((x[row, done:stage] - centroids[number, done:stage]) ** 2).sum(axis=1)
            left = total <= mark[row]
            row, number, total, done = row[left], number[left], total[left], stage
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(total, starts)
        first = np.flatnonzero(total == least[row])
        first = first[np.unique(row[first], return_index=True)[1]]
        numbers.append(number[first])
        distances.append(least // DIMS)
    return np.concatenate(numbers), np.concatenate(distances)


COEFFICIENTS = "vec_id long, coefficients binary"


def coefficients(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, coefficients) of the vectors of exactly 64 components that are all finite numbers."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v")).filter(
        (F.size("v") == DIMS) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    schema = arrow_schema(COEFFICIENTS)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.floor(SCALE * batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS))
            if np.abs(v).max() >= LIMIT:
                raise ValueError(f"components of {LIMIT // SCALE} and more: squared distances need not fit into a long")
            made = transform(v).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in made], schema.field(1).type)], schema=schema)

    return rows.mapInArrow(run, COEFFICIENTS)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").reshape(-1, DIMS).astype(np.int64)


def _sums(rows: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Vectors and summed coefficients of each cluster."""
    schema = arrow_schema("cluster int, place int, total long")

    def run(batches):
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), DIMS), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                number, _ = nearest(x, centroids)
                counts += np.bincount(number, minlength=len(centroids))
                np.add.at(sums, number, x)
        seen = np.flatnonzero(counts)
        if len(seen):
            cells = np.column_stack([counts[seen], sums[seen]])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(seen, DIMS + 1), pa.int32()), pa.array(np.tile(np.arange(DIMS + 1), len(seen)), pa.int32()),
                pa.array(cells.ravel(), pa.int64())], schema=schema)

    made = rows.mapInArrow(run, "cluster int, place int, total long").groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    cells: dict[int, list[int]] = {}
    for r in made.collect():
        cells.setdefault(r["cluster"], [0] * (DIMS + 1))[r["place"]] = int(r["total"])
    return {c: (v[0], v[1:]) for c, v in cells.items()}


def clusters(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2:", id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors with another number of components than 64, or a missing or non-finite one, take no part. Starts are the k vectors
    whose ids have the smallest digests; vectors without id come last, those of one id in order of their coefficients. Repeated rows are
    vectors of their own. With fewer vectors than k each is a start; without any there are no rows. Components of 65,536 and more are
    refused, as their squared distances need not fit into a long.
    """
    spark = vectors.sparkSession
    rows = stored(coefficients(vectors, id_col, vec_col), "coefficients")
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    starts = rows.withColumn("digest", digest).orderBy(F.asc_nulls_last("digest"), "coefficients").limit(k).collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not starts:
        return spark.createDataFrame([], result)
    points = [turned_back(np.frombuffer(r["coefficients"], "<i4").tolist()) for r in starts]
    for _ in range(rounds):
        for c, (n, sums) in _sums(rows, transform(np.array(points))).items():
            points[c] = [s // n for s in turned_back(sums)]
    last = transform(np.array(points))
    schema = arrow_schema("vec_id long, cluster int, distance long")

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest(_matrix(batch), last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], schema=schema)

    assigned = stored(rows.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    # One row a centroid: k at most.
    inertia = {r["cluster"]: r["n"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    facts = spark.createDataFrame(
        [(c, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
         for c, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(*[n.split()[0] for n in result.split(", ")])
