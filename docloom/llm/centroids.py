"""Exact centroid clustering with a progressive search over Walsh-Hadamard coefficients.

Vectors of ``WIDTH`` components become integers, floor(1024 * x). The integer Walsh-Hadamard transform
keeps distances up to a factor of ``WIDTH``, and puts what vectors have in common into few coefficients.
Each vector meets all centroids coarse to fine: squared differences of the coefficients are added up
block by block, in order of their sign changes. What the later coefficients can add lies between
the squares of the difference and of the sum of the remaining lengths; a centroid whose least
possible distance exceeds the greatest possible distance of another one is strictly worse and
leaves. Those that stay are followed to the last coefficient, so distances are exact and ties are real.

Each round is one pass over the stored vectors. A task adds up the vectors of each centroid, so only
``CENTROIDS * (WIDTH + 1)`` sums reach the driver, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.workspace import local_frame, stage

WIDTH = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
#: The starting vectors are those with the smallest digests of this text and their id.
SEED_TEXT = "3:"
#: Coefficients up to which differences are added before centroids are compared again.
CUTS = (1, 2, 4, 8, 16, 32, WIDTH)
#: Components below this in size fit 64-bit arithmetic; larger ones use Python's integers.
SMALL = 1 << 24
#: Components beyond this are taken for it, and distances and sums beyond ``MOST`` for ``MOST``.
LARGEST = 1 << 62
MOST = (1 << 63) - 1
#: Relative margin that covers the rounding of the bounds, which are floating-point numbers.
MARGIN = 1e-9
#: Vectors that are searched at once.
ROWS = 4096


def _by_sign_changes() -> np.ndarray:
    """Places of the coefficients, coarse to fine."""
    at = np.arange(WIDTH)
    signs = np.array([[bin(i & j).count("1") & 1 for j in at] for i in at])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


ORDER = _by_sign_changes()


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of ``x``, coarse to fine, in exact integers."""
    rows, half = len(x), 1
    while half < WIDTH:
        x = x.reshape(rows, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(rows, WIDTH)[:, ORDER]


def _lengths(coefficients: np.ndarray) -> np.ndarray:
    """Length of every row behind each cut: (rows, cuts)."""
    squares = (coefficients * coefficients)[:, ::-1].astype(float)
    behind = np.cumsum(squares, axis=1)[:, ::-1]
    behind = np.hstack([behind, np.zeros((len(behind), 1))])
    return np.sqrt(behind[:, CUTS])


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of every row, ties to the smaller one, and the squared distance."""
    exact = object if max(np.abs(x).max(), np.abs(centroids).max()) >= SMALL else np.int64
    hx, hc = transform(x.astype(exact)), transform(centroids.astype(exact))
    far_x, far_c = _lengths(hx), _lengths(hc)
    row = np.repeat(np.arange(len(x)), len(centroids))
    own = np.tile(np.arange(len(centroids)), len(x))
    total, done = np.zeros(len(row), exact), 0
    for step, cut in enumerate(CUTS):
        gap = hx[row, done:cut] - hc[own, done:cut]
        total, done = total + (gap * gap).sum(axis=1), cut
        if cut == WIDTH:
            break
        a, b, so_far = far_x[row, step], far_c[own, step], total.astype(float)
        slack = MARGIN * (so_far + a * a + b * b)
        starts = np.searchsorted(row, np.arange(len(x)))
        limit = np.minimum.reduceat(so_far + (a + b) ** 2 + slack, starts)
        stay = so_far + (a - b) ** 2 - slack <= limit[row]
        row, own, total = row[stay], own[stay], total[stay]
    least = np.minimum.reduceat(total, np.searchsorted(row, np.arange(len(x))))
    best = np.flatnonzero(total == least[row])
    best = best[np.unique(row[best], return_index=True)[1]]
    return own[best], total[best] // WIDTH


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as integers."""
    good = (
        f"size(embedding) = {WIDTH} AND "
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    whole = f"floor(double(x) * {SCALE})"
    inside = f"CASE WHEN double(x) * {SCALE} >= {LARGEST}D THEN {LARGEST} WHEN double(x) * {SCALE} <= -{LARGEST}D THEN -{LARGEST} ELSE {whole} END"
    return vectors.filter(good).selectExpr("vec_id", f"transform(embedding, x -> bigint({inside})) AS v")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for first in range(0, batch.num_rows, ROWS):
        part = batch.slice(first, ROWS)
        yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def start(rows: DataFrame) -> np.ndarray:
    """The vectors of the smallest digests; a null id comes last, and equal digests go by the vector."""
    chosen = (
        rows.withColumn("at", F.sha2(F.concat(F.lit(SEED_TEXT), F.col("vec_id").cast("string")), 256))
        .orderBy(F.col("at").asc_nulls_last(), "v")
        .limit(CENTROIDS)
        .select("v")
        .collect()
    )
    return np.array([row.v for row in chosen], dtype=np.int64).reshape(-1, WIDTH)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floored means of the vectors nearest to them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), WIDTH + 1), object)
        for batch in batches:
            for _, x in _blocks(batch):
                cluster, _ = nearest(x, centroids)
                counted = np.hstack([x.astype(object if np.abs(x).max() >= SMALL else np.int64), np.ones((len(x), 1), np.int64)])
                for one in np.unique(cluster):
                    sums[one] += counted[cluster == one].sum(axis=0).astype(object)
        one, place = np.nonzero(np.repeat(sums[:, -1:] > 0, WIDTH + 1, axis=1))
        total = pa.array([Decimal(int(x)) for x in sums[one, place]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(one.astype(np.int32)), pa.array(place.astype(np.int32)), total], ["cluster", "place", "total"]
        )

    parts = (
        rows.mapInArrow(add, "cluster int, place int, total decimal(38,0)")
        .groupBy("cluster", "place")
        .agg(F.sum("total").alias("total"))
        .collect()
    )
    sums = {(row.cluster, row.place): int(row.total) for row in parts}
    out = centroids.copy()
    for one in {cluster for cluster, _ in sums}:
        out[one] = [sums[one, place] // sums[one, WIDTH] for place in range(WIDTH)]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _blocks(batch):
                cluster, distance = nearest(x, centroids)
                distance = np.minimum(distance, MOST).astype(np.int64)
                columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(search, "vec_id long, cluster int, distance long")


def _described(spark: SparkSession, centroids: np.ndarray, found: DataFrame) -> DataFrame:
    """Digest and summed distances of every centroid: at most ``CENTROIDS`` rows."""
    summed = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    inertia = {row.cluster: int(row.n) for row in summed}
    whole = min(sum(inertia.values()), MOST)
    digest = [hashlib.sha256(",".join(map(str, one)).encode()).hexdigest() for one in centroids.tolist()]
    rows = [(i, min(inertia.get(i, 0), MOST), whole, digest[i]) for i in range(len(centroids))]
    return local_frame(spark, rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def clusters(vectors: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """The final centroids, and (vec_id, cluster, distance) of every vector that takes part.

    Vectors that are null, have other than ``WIDTH`` components or null or non-finite ones take no part.
    Rows that repeat count as often as they occur; a null vec_id takes part and comes last among
    the starting vectors. Fewer vectors than ``CENTROIDS`` give fewer centroids, an empty
    table none and no rows. Components beyond 2**62 are taken for that number, and distances beyond the
    largest long for that one; other columns are ignored.
    """
    rows = stage(usable(vectors), "integers")
    centroids = start(rows)
    if len(centroids):
        for _ in range(ROUNDS):
            centroids = moved(rows, centroids)
        rows = assigned(rows, centroids)
    else:
        rows = rows.selectExpr("vec_id", "int(null) AS cluster", "bigint(null) AS distance")
    return centroids, rows


def clustered(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    centroids, found = clusters(vectors)
    found = stage(found, "clusters")
    # one row for each centroid
    few = F.broadcast(_described(vectors.sparkSession, centroids, found))
    return found.join(few, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
