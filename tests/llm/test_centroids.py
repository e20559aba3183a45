import hashlib
import math
import random

import numpy as np
import pytest

from docloom.llm import centroids
from docloom.llm.suite import QUERIES


def whole(x):
    return max(-(1 << 62), min(1 << 62, math.floor(1024 * x)))


def brute(rows):
    kept = [
        (i, [whole(x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:8]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, y)), j) for j, y in enumerate(c))

    for _ in range(10):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        c = [[sum(z) // len(groups[j]) for z in zip(*groups[j])] if j in groups else y for j, y in enumerate(c)]
    most = (1 << 63) - 1
    found = [(i, *near(v)) for i, v in kept]
    inertia = {}
    for _, d, j in found:
        inertia[j] = inertia.get(j, 0) + min(d, most)
    total = min(sum(inertia.values()), most)
    digest = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    out = [(i, j, min(d, most), min(inertia[j], most), total, digest[j]) for i, d, j in found]
    return sorted(out, key=repr)


def run(df):
    return sorted((tuple(r) for r in centroids.clustered(df).collect()), key=repr)


def test_query(spark, data):
    import duckdb

    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{data}/embeddings.parquet'").fetchall()
    found = [tuple(r) for r in QUERIES["op13_hadamard_centroids"](spark, data).collect()]
    assert sorted(found, key=repr) == brute(rows)


def test_transform_keeps_distances():
    rng = np.random.default_rng(3)
    x = rng.integers(-1000, 1000, (50, 64))
    h = centroids.transform(x)
    assert ((h[0] - h[1:]) ** 2).sum(axis=1).tolist() == (64 * ((x[0] - x[1:]) ** 2).sum(axis=1)).tolist()
    assert h[:, 0].tolist() == x.sum(axis=1).tolist()


def test_strictly_worse_centroids_leave_early(monkeypatch):
    """Far centroids leave with the first coefficients, ties stay to the end."""
    x = np.zeros((3, 64), np.int64)
    c = np.stack([np.full(64, 500), np.ones(64), -np.ones(64)]).astype(np.int64)
    assert [a.tolist() for a in centroids.nearest(x, c)] == [[1, 1, 1], [64, 64, 64]]
    seen = []
    real = centroids.np.searchsorted
    monkeypatch.setattr(centroids.np, "searchsorted", lambda a, v: seen.append(len(a)) or real(a, v))
    centroids.nearest(x, c)
    assert seen[0] == 9 and seen[-1] == 6


@pytest.mark.parametrize("count", [0, 1, 5, 300])
def test_odd_vectors(spark, count):
    """Ties, repeats, few vectors, large components, clashing columns, and vectors that take no part."""
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(-2, 3)) / 7 for _ in range(64)], "x") for i in range(count)]
    if count > 5:
        rows += [(i % 7, [0.25] * 64, "x") for i in range(40)] + [(None, [0.5] * 64, "x")] * 2
        rows += [(900, [1e300] * 64, "x"), (901, [-1e300] * 64, "x"), (902, [3e6 + i for i in range(64)], "x")]
    rows += [(990 + i, v, "x") for i, v in enumerate([None, [], [1.0] * 63, [1.0] * 63 + [None], [float("nan")] * 64, [float("inf")] * 64])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string")
    assert run(df) == brute([(i, v) for i, v, _ in rows])
