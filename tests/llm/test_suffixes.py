import hashlib
import random

import numpy as np
import pytest

from docloom.llm import suffixes
from docloom.llm.suite import QUERIES

LENGTH = suffixes.LENGTH


def brute(rows):
    """Every row's result from all strings of all texts."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for row, (_, text) in enumerate(texts):
        for at in range(len(text) - LENGTH + 1):
            seen.setdefault(text[at : at + LENGTH], []).append((row, at))
    cover = [np.zeros(len(text) + 1, bool) for _, text in texts]
    for places in seen.values():
        if len(places) > 1:
            for row, at in places:
                cover[row][at : at + LENGTH] = True
    out = []
    for (doc_id, text), mask in zip(texts, cover):
        mask = mask[:-1]
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~mask])
        out.append((doc_id, len(text), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    return sorted((tuple(r) for r in suffixes.repeats(df).drop("spans").collect()), key=repr)


def check(spark, rows):
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_query(spark, data, texts):
    found = sorted((tuple(r) for r in QUERIES["op11_suffix_family_dedup"](spark, data).collect()), key=repr)
    assert found == brute(texts)
    assert any(0 < r[2] < r[1] for r in found)


def test_odd_rows(odd, clashing, none):
    """Nulls, empty and very long texts, rows that repeat, clashing columns, an empty table."""
    want = brute([(r[0], r[1]) for r in odd.select("doc_id", "text").collect()])
    assert run(odd) == want == run(clashing)
    assert run(none) == []


def planted(seed):
    """Passages of about the least length, at varied surroundings, within texts and across, one byte off, periodic."""
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefgh \n") for _ in range(n))

    passages = [noise(n) for n in (190, 199, 200, 201, 230, 400, 700)]
    rows = []
    for i in range(60):
        text = noise(rng.randrange(0, 300))
        for _ in range(rng.randrange(0, 4)):
            one = rng.choice(passages)
            cut = rng.randrange(0, 30)
            text += one[cut if rng.random() < 0.3 else 0 :] + noise(rng.randrange(0, 90))
        rows.append((i, text))
    rows += [(100, "ab" * 150), (101, "a" * 500), (102, "x" + "a" * 450), (103, "é" * 130 + "ü" * 120), (104, "é" * 130)]
    rows += [(105, passages[5][:300] + "Z" + passages[5][301:]), (106, "q" * 200), (107, "w" * 199), (None, passages[6]), (None, passages[6])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_planted(spark, seed):
    check(spark, planted(seed))


def test_small_slices_and_hot_anchors(spark, monkeypatch):
    """Texts cut into slices, and anchors of more contexts than one task compares."""
    monkeypatch.setattr(suffixes, "SLICE", 150)
    monkeypatch.setattr(suffixes, "GROUP", 3)
    check(spark, planted(3))


def test_contexts_of_one_line(spark):
    """A common line that is shorter than a passage in many surroundings, some of them alike."""
    rng = random.Random(8)
    line = "permission is hereby granted free of charge to any person obtaining a copy of this software and documentation"
    sides = ["".join(rng.choice("mnopqrst") for _ in range(150)) for _ in range(12)]
    check(spark, [(i, rng.choice(sides) + line + rng.choice(sides) + str(i)) for i in range(80)])


def test_levels_double(spark):
    """Levels are the binary digits of the number of batches, and each batch is scanned against all of them."""
    family = suffixes.Family(spark)
    rng = random.Random(4)
    common = "".join(rng.choice("uvwxyz") for _ in range(260))
    for number in range(6):
        text = "".join(rng.choice("abcdef") for _ in range(400)) + common
        matches = family.add(spark.createDataFrame([(number, text)], "row long, text string"))
        assert matches.isEmpty() == (number == 0)
        sizes = [size for size, _ in family.levels]
        assert sizes == [1 << k for k in (2, 1, 0) if (number + 1) >> k & 1]


def test_anchors_follow_content():
    """A passage has its anchor at the same distance wherever it lies."""
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 256, LENGTH).astype(np.uint8)
    distances = set()
    for size in (0, 1, 77, 300):
        data = np.concatenate([rng.integers(0, 256, size).astype(np.uint8), passage, rng.integers(0, 256, 50).astype(np.uint8)])
        distances.add(int(suffixes.anchors(data)[size]) - size)
    assert len(distances) == 1
