import collections
import math
import random
import re

import public_tokenizers
import pyarrow as pa
import sentencepiece

from docloom.llm import fertility
from docloom.llm.suite import QUERIES
from docloom.llm.texts import chunks
from tests.llm.conftest import ODD, thue_morse

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check(found, texts):
    want = collections.defaultdict(set)
    for i, text in texts:
        want[i].add(base(text))
    for r in found:
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert own in want[r.doc_id]
        assert r.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r.kept and r.base_failed)


def test_query(spark, data, texts):
    found = QUERIES["op3_fertility_quality"](spark, data).collect()
    assert len(found) == len(texts)
    check(found, texts)
    good = [r for r in found if not r.base_failed]
    assert sum(r.kept for r in good) > 0.8 * len(good)


def test_odd_rows(clashing, none):
    found = fertility.quality(clashing).collect()
    assert len(found) == len(ODD)
    check(found, [(r[0], r[1]) for r in ODD])
    assert fertility.quality(none).collect() == []
    assert len(fertility.quality(clashing.drop("lang")).collect()) == len(ODD)


def test_measures_equal_the_tokenizers_own():
    path = public_tokenizers.path(fertility.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["the quick the quick 漢字😀", "", "a", "é\tß  x\u00a0y", "one two three " * 30]
    (chunk,) = chunks(pa.array(texts))
    found = fertility.Tokens(path).measures(chunk)
    for i, text in enumerate(texts):
        ids = [t for w in WORD.findall(text) for t in model.encode(w)]
        counts = collections.Counter(ids)
        entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values()) if ids else 0
        share = sum(map(model.is_byte, ids)) / max(1, len(ids))
        assert found["n_tokens"][i] == len(ids)
        assert abs(found["byte_share"][i] - share) < 1e-9
        assert abs(found["entropy"][i] - entropy) < 1e-9


def test_lines_and_words_of_much_structure():
    for size in (512, 1024, 2048, 4096):
        a, b = thue_morse(size)
        (chunk,) = chunks(pa.array([f"{a}\n{b}\n{a}", f"x {a} y x {b} y"]))
        found = fertility.base_counts(chunk)
        assert found["n_dup_lines"].tolist() == [1, 0]
        assert found["n_repeat_words"].tolist() == [0, 0]


def test_scripts():
    (chunk,) = chunks(pa.array(["abc é", "привет a", "漢字仮", "123 !", ""]))
    assert fertility.scripts(chunk) == ["latin", "cyrillic", "han", "other", "other"]


def test_unusual_texts_are_rejected_per_language(spark):
    rng = random.Random(6)
    words = "the house of green tree stands near river where many people walk every day".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(120)), "en") for i in range(200)]
    noise = "".join(chr(rng.randrange(0x2600, 0x26FF)) + rng.choice("  x") for _ in range(400))
    rows += [(1000, noise, "en"), (1001, " ".join(f"{rng.randrange(16**8):08x}" for _ in range(120)), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in fertility.quality(df).collect()}
    assert not found[1000].kept and not found[1001].kept
    assert all(found[i].kept for i in range(200) if not found[i].base_failed)


def test_a_text_copied_many_times_does_not_set_the_bands(spark):
    rng = random.Random(9)
    words = "the house of green tree stands near river where many people walk extraordinarily notwithstanding zyx qwk".split()
    rows = []
    for i in range(200):
        some = rng.sample(words, 9)
        rows.append((i, " ".join(rng.choice(some) for _ in range(120)), "en"))
    schema = "doc_id long, text string, lang string"
    copies = [(1000 + i, rows[7][1], "en") for i in range(500)]

    def kept(own):
        return {r.doc_id: r.kept for r in fertility.quality(spark.createDataFrame(own, schema)).collect() if r.doc_id < 1000}

    alone = kept(rows)
    assert sum(alone.values()) > 150
    assert kept(rows + copies) == alone
