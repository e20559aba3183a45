import collections
import math
import re

import pytest

from docloom.llm import joins, mixing
from docloom.llm.suite import QUERIES
from tests.llm.conftest import ODD


def shares(sizes):
    """Targets by the definition: share, stop, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        weights = sum(weight[s] for s in order if s not in stopped)
        over = {s for s in order if s not in stopped and weight[s] * rest / weights > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in stopped else weight[s] * rest / weights for s in order}
        stopped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(found, docs):
    """found: (doc_id, size, source_size, target, taken) by row; docs: (doc_id, text, source)."""
    sizes = collections.Counter()
    for _, text, source in docs:
        sizes[source] += words(text)
    want = shares(sizes)
    of = {(i, words(t)): s for i, t, s in docs}
    taken = collections.Counter()
    for doc_id, size, source_size, target, n in found:
        source = of[doc_id, size]
        assert source_size == sizes[source]
        assert target == pytest.approx(want[source])
        assert 0 <= n <= 3 * size
        taken[source] += n
    for source in sizes:
        assert taken[source] == math.floor(want[source] + 1e-9)


@pytest.mark.parametrize("ranges", [7, 20_000])
def test_query_meets_every_budget(spark, data, ranges, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{data}/documents.parquet'").fetchall()
    found = [tuple(r) for r in QUERIES["op8_source_mix"](spark, data).collect()]
    assert len(found) == len(docs)
    check(found, docs)
    assert sorted(found) == sorted(tuple(r) for r in QUERIES["op8_source_mix"](spark, data).collect())


def test_odd_rows(spark, clashing, none):
    found = mixing.mixed(clashing).select("doc_id", "size", "source_size", "target", "taken").collect()
    check([tuple(r) for r in found], [(r[0], r[1], r[3]) for r in ODD])
    assert mixing.mixed(none).collect() == [] and mixing.mixture(none).collect() == []
    copies = mixing.mixture(clashing)
    assert copies.columns == clashing.columns
    assert all(r.text and r.text.strip() for r in copies.collect())


def test_rows_that_repeat_are_one_group(spark, monkeypatch):
    """Equal rows, and null ids of one text, meet their budgets without one task that holds them all."""
    monkeypatch.setattr(joins, "COPIES", 50)
    docs = [(1, "w w w", "a")] * 400 + [(None, "v v", "b")] * 300 + [(i, "u", "abc"[i % 3]) for i in range(2, 90)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = [tuple(r) for r in mixing.mixed(df).select("doc_id", "size", "source_size", "target", "taken").collect()]
    assert len(found) == len(docs)
    check(found, docs)
    got, sizes = collections.Counter(), collections.Counter()
    for r in mixing.mixture(df).collect():
        got[r.source] += words(r.text)
    for _, text, source in docs:
        sizes[source] += words(text)
    assert set(got) == {"a", "b", "c"} and all(got[s] <= 3 * sizes[s] for s in got)


def test_whole_rows_come_near_the_budget(spark):
    docs = [(i, "w " * (1 + i % 7), "ab"[i % 10 == 0]) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    sizes = collections.Counter()
    for _, t, s in docs:
        sizes[s] += words(t)
    got = collections.Counter()
    for r in mixing.mixture(df).collect():
        got[r.source] += words(r.text)
    for source, target in shares(sizes).items():
        assert abs(got[source] - target) <= 7
