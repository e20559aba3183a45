import math
import random

import pytest

from docloom.llm import topk
from docloom.llm.suite import QUERIES


def brute(rows, every=50, top=5):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % every == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(b) == len(a)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def test_query(spark, data):
    import duckdb

    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{data}/embeddings.parquet'").fetchall()
    found = [tuple(r) for r in QUERIES["op9_bounded_top_k"](spark, data).collect()]
    assert sorted(found) == brute(rows)


@pytest.mark.parametrize("small", [False, True])
def test_odd_vectors(spark, small, monkeypatch):
    """Many blocks and runs, ties, clusters, repeats and vectors that take no part."""
    if small:
        for name, value in (("ROWS", 16), ("QUERY_ROWS", 4), ("DIMENSIONS", 3), ("RUN", 2)):
            monkeypatch.setattr(topk, name, value)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 3) for _ in range(10)], "x") for i in range(400)]
    rows += [(i, [0.5] * 10, "x") for i in range(400, 460)]
    rows += [(500 + i, v, "x") for i, v in enumerate([None, [], [1.0, None], [float("nan")] * 10, [float("inf")] * 10])]
    rows += [(600, [1.0, 2.0], "x"), (601, [3.0, 4.0], "x"), (None, [1.0] * 10, "x"), (650, [9.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = [tuple(r) for r in topk.top_k(df).collect()]
    assert sorted(found) == brute([(i, v) for i, v, _ in rows])
    assert topk.top_k(df.limit(0)).collect() == []
