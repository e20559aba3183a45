import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from docloom.llm import joins, manifest
from docloom.llm.suite import QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [None if x is None else str(x) for x in (*row[:4], text)]
    return h(*("-" if x is None else f"{len(x.encode())}:{x}" for x in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        first = at // 3 * 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def brute(rows):
    """Every row's result from whole trees in memory; rows are (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for s in sources}
    trees = {s: levels([leaf(r, r[4]) for r in own[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root, out = top[-1][0] if sources else None, []
    for place, s in enumerate(sources):
        for at, row in enumerate(own[s]):
            proof = siblings(trees[s], at) + siblings(top, place)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for before, after in proof:
                node = h(*before, node, *after)
            flat = [x for before, after in proof for x in before + after]
            out.append((row[0], leaf(row, row[4]), trees[s][-1][0], root, h(*flat), node, node == root))
    return sorted(out, key=repr)


def run(df):
    return sorted((tuple(r) for r in manifest.verified(df).collect()), key=repr)


def plain(df):
    return [tuple(r) for r in df.select(*manifest.FIELDS).collect()]


def test_query(spark, data):
    import duckdb

    rows = duckdb.sql(f"SELECT {', '.join(manifest.FIELDS)} FROM '{data}/documents.parquet'").fetchall()
    found = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, data).collect()), key=repr)
    assert found == brute(rows)
    assert {r[-1] for r in found} == {True, False}


def test_odd_rows(odd, clashing, none):
    assert run(odd) == brute(plain(odd)) == run(clashing)
    assert run(none) == []


@pytest.mark.parametrize("count", [1, 3, 4, 10])
def test_one_source(spark, count):
    rows = [(i, "s", None, 1, f"a\n{i}") for i in range(count)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert run(df) == brute(rows)


def test_repeated_rows_are_numbered_in_pieces(spark, monkeypatch):
    """A third of all rows are one row; equal subtrees are one record."""
    monkeypatch.setattr(joins, "COPIES", 7)
    rows = [(1, "s", "en", 1, "a\nb")] * 100 + [(i, "s" if i % 2 else None, "en", 1, "c") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert run(df) == brute(rows)
    made = manifest.manifest(df)
    assert made.records(1).count() < made.levels[0].count()


def test_records_answer_to_digests(spark):
    """Each record's digest is that of its children, and the way from a top leads to every leaf."""
    rows = [(i, "s", "en", 1, f"text {i}") for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = manifest.manifest(df)
    for height in range(1, len(made.levels) + 1):
        for record in made.records(height).collect():
            assert record.digest == h(*record.children)
    way = F.array().cast("array<struct<before binary, after binary>>")
    tops = made.tops().withColumn("subroot", F.col("digest")).withColumn("way", way)
    reached = {(r["at"], r["digest"]) for r in manifest.descended(made, tops).collect()}
    assert reached == {(r["at"], r["digest"]) for r in made.leaves.collect()}
