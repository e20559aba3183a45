import random
import re

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import minmax
from docloom.llm.components import components
from docloom.llm.suite import QUERIES
from docloom.llm.texts import shingle_sets
from tests.llm.conftest import ODD, thue_morse

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(texts):
    """doc_id -> (set size, component) over rows with ids, all pairs compared."""
    sets = {}
    for i, text in texts:
        sets.setdefault(i, []).append(shingles(text))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= 75 * len(x | y):
                        low, high = sorted((root(a), root(b)))
                        parent[high] = low
    return {i: ([len(x) for x in sets[i]], root(i)) for i in ids}


def check(found, texts):
    want = brute([(i, t) for i, t in texts if i is not None])
    for doc_id, n, component, kept in found:
        if doc_id is None:
            assert component is None and kept
        else:
            assert n in want[doc_id][0]
            assert (component, kept) == (want[doc_id][1], want[doc_id][1] == doc_id)


def test_query_matches_all_pairs(spark, data, texts):
    found = [tuple(r) for r in QUERIES["op4_minmax_dedup"](spark, data).collect()]
    assert len(found) == len(texts)
    check(found, texts)


def test_odd_rows(spark, clashing, none):
    found = [tuple(r) for r in minmax.near_duplicates(clashing).collect()]
    assert len(found) == len(ODD)
    check(found, [(r[0], r[1]) for r in ODD])
    assert minmax.near_duplicates(none).collect() == []
    kept = minmax.deduplicated(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9]
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_copies_without_an_id_of_their_own(spark):
    """Rows that repeat an id or have none: one of each group stays, and clashing names do no harm."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text, "a"), (7, text, "b"), (8, text + " end", "c"), (None, text, "d"), (None, text.upper(), "e")]
    rows += [(None, "", "f"), (None, None, "g"), (None, "other words", "h"), (9, "alone here", "i"), (9, "zwei", "j")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = [tuple(r) for r in minmax.deduplicated(df).collect()]
    assert sorted(r[0] for r in kept if r[0] is not None) == [7, 9]
    assert (9, "alone here", "i") in kept
    assert sorted(r[2] for r in kept if r[0] is None and r[2] not in "de") == ["f", "g", "h"]
    assert sum(r[2] in "de" for r in kept) == 1


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
def test_words_of_much_structure_do_not_link(spark, size):
    rows = [(i, word) for i, word in enumerate(thue_morse(size))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.component_id for r in minmax.near_duplicates(df).orderBy("doc_id").collect()] == [0, 1]


@pytest.mark.parametrize("block", [4, 512])
def test_family_of_near_copies(spark, block, monkeypatch):
    """Copies that differ from each other by much and little, in small and large blocks."""
    monkeypatch.setattr(minmax, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check([tuple(r) for r in minmax.near_duplicates(df).collect()], docs)


def test_links_across_components_are_found(spark):
    """Blocks compare members of different components, and no others."""
    rng = random.Random(3)
    texts = {i: " ".join(f"v{rng.randrange(9)}" for _ in range(12)) for i in range(40)}
    texts |= {i + 40: t + " end" for i, t in texts.items()}
    members = spark.createDataFrame([(7, i, i % 3) for i in texts], "key long, id long, c long")
    df = spark.createDataFrame(list(texts.items()), "node long, text string")
    got = {tuple(r) for r in minmax.across(df, members).collect()}
    want = set()
    for a in texts:
        for b in texts:
            x, y = shingles(texts[a]), shingles(texts[b])
            if a % 3 < b % 3 and 100 * len(x & y) >= 75 * len(x | y):
                want.add((a, b))
    assert got == want and want


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = both[:800], both[100:]
    low, high = minmax.signatures([a, b])
    agree = np.concatenate([low[0] == low[1], high[0] == high[1]]).mean()
    assert abs(agree - 700 / 900) < 0.1
    keys = minmax.band_keys(low, high)
    assert keys.shape == (2, minmax.BANDS) and (keys[0] == keys[1]).sum() > 3


def test_shingles_of_arrow_slices():
    column = pa.array(["zero", "a b c d e f", None, "A B C D E F", ""])
    found = list(shingle_sets(column.slice(1)))
    assert [len(x) for x in found] == [2, 0, 2, 0]
    assert (found[0] == found[2]).all()


def test_components_of_chains_and_repeats(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 40), (40, 30), (50, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 30: 30, 40: 30, 50: 50}
    assert components(df.limit(0)).collect() == []
