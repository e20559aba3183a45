import zlib

import numpy as np
import pytest

from docloom.llm import toxicity
from docloom.llm.suite import QUERIES
from tests.llm.conftest import ODD

WORDS = ("idiot", "worthless", "moron", "stupid", "disgusting", "pathetic")


@pytest.fixture(scope="module")
def labelled(spark):
    """A corpus of random prose, one part of which holds a bad word."""
    rng = np.random.default_rng(3)
    syllables = "the an re in er on at ed is ou ha st".split()
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[int(rng.integers(40))] = WORDS[i // 4 % len(WORDS)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


@pytest.fixture(scope="module")
def restorer(labelled):
    return toxicity.Restorer(toxicity.character_model(labelled[0]))


@pytest.mark.parametrize(
    ("seen", "plain"),
    [("1d10t", "idiot"), ("stuuuupid", "stupid"), ("m.o.r.o.n", "moron"), ("w0rthl3$$", "worthless"), ("d1sgust1ng", "disgusting"),
     ("iiddiioott", "idiot"), ("stuupiid", "stupid"), ("mmoronn", "moron"), ("wworthless", "worthless")],
)
def test_disguised_words_are_restored(restorer, seen, plain):
    assert plain in restorer.words(seen)


def test_spaced_words_and_plain_words(restorer):
    assert "moron" in restorer.spaced("the m o r o n there")
    assert restorer.words("There,") == ["there"]
    assert restorer.spaced("a b and c") == []


def test_letters_that_repeat_as_a_habit_have_one_path(restorer):
    for word in ("iiddiioott", "letter", "aaa", "bookkeeper", "éé", "xyyx"):
        assert restorer.restore(word, habit=True) == toxicity._RUNS.sub(r"\1", word)


@pytest.mark.parametrize("text", ["m  o  r  o  n", "m\to\tr\to\tn", "m\no\nr\no\nn", "m o  r\to n", "M 0 R 0 N"])
def test_any_white_space_between_letters(restorer, text):
    assert "moron" in restorer.spaced(f"there {text} onere")


def test_short_and_neighbouring_spaced_words(restorer):
    """A blank may end a word: what is spelled with spaces is cut where the model sees words end."""
    assert "red" in restorer.spaced("the r e d one")
    assert "moron" in restorer.spaced("the i s m o r o n there")
    assert restorer.spaced("there is a b and") == []


def test_forms_of_disguise_are_found_and_clean_ones_left(spark, labelled):
    """Recall over planted forms, and plain texts with doubled letters and single characters beside them."""
    docs, labels = labelled
    forms = {
        "doubled": lambda w: "".join(c + c for c in w),
        "part doubled": lambda w: w[:2] + w[1:] + w[-1],
        "blanks": " ".join,
        "double blanks": "  ".join,
        "tabs": "\t".join,
        "lines": "\n".join,
        "leet": lambda w: w.translate(str.maketrans("oies", "0135")),
    }
    planted = [(2000 + i, f"there onere {form(w)} rehast anin") for i, (form, w) in enumerate((f, w) for f in forms.values() for w in WORDS)]
    clean = [(3000 + i, t) for i, t in enumerate(["hasst annin onnere", "a b c d e", "i n t h e", "ed ed ed rree", "1 2 3 4", "o n e r e"])]
    more = spark.createDataFrame(planted + clean, "doc_id long, text string")
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(docs.union(more), labels).collect()}
    assert np.mean([found[i] for i, _ in planted]) >= 0.9
    assert sum(found[i] for i, _ in clean) == 0


def test_viterbi_is_the_best_path(restorer):
    """Against all paths of short words, each path scored on its own."""
    import itertools

    def paths(seen):
        options = []
        for at, char in enumerate(seen):
            own = [(char, toxicity.PLAIN)]
            like = toxicity.LOOKALIKES.get(char, "")
            own += [(x, toxicity.SWAPPED - np.log(len(like))) for x in like]
            if at and seen[at - 1] == char:
                own.append(("", toxicity.AGAIN))
            options.append(own)
        return itertools.product(*options)

    def score(path):
        state, total = 0, 0.0
        for out, cost in path:
            total += cost
            if out:
                gram = state * toxicity.ALPHABET + int(toxicity.FOLD[ord(out)])
                total += float(restorer.model[gram])
                state = gram % toxicity.ALPHABET**3
        return total

    for seen in ("1d10t", "5tt11", "00ps!", "a@a"):
        best = max(paths(seen), key=score)
        assert restorer.restore(seen) == "".join(out for out, _ in best)


def test_held_out_rows_and_disguised_rows(spark, labelled):
    docs, labels = labelled
    more = spark.createDataFrame(
        [(1000, "the rein and 1d10t onere"), (1001, "the m o r o n there"), (1002, "there and onere")],
        "doc_id long, text string",
    )
    found = {r.doc_id: r for r in toxicity.toxicity(docs.union(more), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    right = [found[i].predicted == (i % 4 == 0) for i in range(600) if found[i].held_out]
    assert np.mean(right) > 0.97
    assert [found[i].predicted for i in (1000, 1001, 1002)] == [1, 1, 0]
    kept = toxicity.without_toxic(docs.union(more), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.predicted}


def test_labels_of_held_out_rows_do_not_matter(spark, labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity.toxicity(docs, labels).collect()) == sorted(toxicity.toxicity(docs, turned).collect())


def test_model_counts_every_string(spark):
    from collections import Counter

    texts = ["Éa b", "", None, "  x\n\ny  ", "漢字 ab"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = Counter()
    for row in df.coalesce(1).mapInArrow(toxicity._count, "gram int, n long").collect():
        got[row.gram] += row.n
    joined = []
    for text in texts:
        joined += [0] + [int(toxicity.FOLD[ord(c)]) for c in text or ""]
    joined = [0, 0, 0, *joined, 0, 0, 0]
    kept = [k for i, k in enumerate(joined) if i < 3 or i >= len(joined) - 3 or k or joined[i - 1]]
    want = Counter()
    for i in range(len(kept) - 3):
        a, b, c, d = kept[i : i + 4]
        want[((a * 28 + b) * 28 + c) * 28 + d] += 1
    inner = {k: v for k, v in want.items() if k % 28 and k // 28 % 28}
    assert inner == {k: v for k, v in got.items() if k % 28 and k // 28 % 28}


def test_odd_rows_and_no_labels(spark, clashing, none, labelled):
    labels = labelled[1]
    found = toxicity.toxicity(clashing, labels).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    same = [r.score for r in found if r.doc_id == 1]
    assert same[0] == same[1]
    assert toxicity.toxicity(none, labels).collect() == []
    assert len({r.score for r in toxicity.toxicity(clashing, labels.limit(0)).collect()}) == 1
    strange = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id long, toxic int")
    kept = toxicity.without_toxic(clashing, strange)
    assert kept.columns == clashing.columns


def test_query(spark, data, texts):
    """Every score against a plain loop over words and indicators, under the model and weights of the table."""
    from docloom.llm.texts import table

    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    model = toxicity.character_model(docs)
    fitted = toxicity.fit(docs, labels, model)
    weight = dict(zip(fitted.names, fitted.weights.tolist()))
    own = toxicity.Restorer(model)

    def score(text):
        words = [w for token in (text or "").split() for w in own.words(token)] + own.spaced(text or "")
        seen = {x for w in words for x in (w, w[:4] + "*" if len(w) > 4 else w, w[:5] + "*" if len(w) > 5 else w)}
        return 1 / (1 + np.exp(-(fitted.shift + sum(weight.get(x, 0.0) for x in seen))))

    found = {r.doc_id: r for r in QUERIES["op1_noisy_channel_toxicity"](spark, data).collect()}
    assert found.keys() == {i for i, _ in texts}
    for i, text in texts:
        assert found[i].score == pytest.approx(score(text), abs=1e-6)
        assert found[i].predicted == (found[i].score >= 0.5)
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
