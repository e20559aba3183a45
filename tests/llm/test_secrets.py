import hashlib
import random
import re
import string

import numpy as np

from docloom.llm import secrets
from docloom.llm.suite import QUERIES
from tests.llm.conftest import ODD

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    written = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
    counts = tuple(sum(k == kind for _, k, _ in found) for kind in range(3))
    return (*counts, hashlib.sha256(written.encode()).hexdigest()), written


def check(found, texts):
    want = {}
    for i, text in texts:
        want.setdefault(i, set()).add(base(text))
    for r in found:
        own = (r.n_assign, r.n_access, r.n_hex, r.base_sha256)
        written = ",".join(x for x in r.spans.split(",") if not x.startswith("random"))
        assert (own, written) in want[r.doc_id]


def test_query(spark, data, texts):
    found = QUERIES["op6_random_secrets"](spark, data).collect()
    assert len(found) == len(texts)
    check(found, texts)


def test_odd_rows(clashing, none):
    found = secrets.secrets(clashing).collect()
    assert len(found) == len(ODD)
    check(found, [(r[0], r[1]) for r in ODD])
    assert secrets.secrets(none).collect() == [] and secrets.without_secrets(none).collect() == []
    masked = secrets.without_secrets(clashing)
    assert masked.columns == clashing.columns
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[9].text.startswith("[SECRET]") and rows[9].n_chars == len(rows[9].text)
    assert rows[3].text is None and rows[1].n_chars == 3


def test_base_patterns_at_their_edges(spark):
    texts = [
        "TOKEN: 'abcdefgh' to\u212Aen=abcdefgh pa\u017fsword=abcdefgh api_key=short apikey==x",
        "AKIA123 AKIAAKIA12345678 xAKIA123456789012y",
        "f" * 31 + " " + "0" * 32 + "G" + "é" * 3 + "a" * 40,
        "password=secret=token=abcdefgh12",
        'secret":   "0123456789abcdef0123456789abcdef"',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(secrets.secrets(df).collect(), list(enumerate(texts)))


def test_random_strings_are_added_and_words_are_not(spark):
    rng = random.Random(8)
    letters = string.ascii_letters + string.digits
    words = "the house stands near a green river where many people walk every single day".split()
    rows, planted = [], {}
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(60))
        if i % 3 == 0:
            key = "".join(rng.choice(letters) for _ in range(44))
            planted[i] = len(text) + 1
            text += f" {key} " + " ".join(rng.choice(words) for _ in range(30))
        elif i % 3 == 1:
            text += " " + "".join(rng.choice(words) for _ in range(9)) + "2 end"
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.secrets(df).collect()}
    hit = sum(found[i] == f"random:{at}:{at + 44}" for i, at in planted.items())
    assert hit > 0.8 * len(planted)
    assert sum(bool(s) for i, s in found.items() if i not in planted) <= 0.1 * hit


def test_battery_tells_random_from_words():
    rng = np.random.default_rng(2)
    levels = [secrets.battery(rng.integers(0, 64, 44), 64) for _ in range(400)]
    assert np.mean(np.array(levels) > 0.05) > 0.9
    assert secrets.battery(np.array([3] * 40), 64) == 0.0
    assert secrets.battery(np.tile([1, 60], 20), 64) < 0.01


def test_encodings():
    assert secrets.encoding("0a1b2c3d") == "hex"
    assert secrets.encoding("MZXW6YTB==") == "base32"
    assert secrets.encoding("Zm9v+a/1") == "base64"
    assert secrets.encoding("onlywords") is None and secrets.encoding("12345") is None


def test_suspicious_rows_lose_nothing():
    import pyarrow as pa

    texts = [None, "", "plain", "token=abcdefgh", "AKIA", "x" * 20, "é" + "0" * 32, "passw\u00f6rd"]
    marked = secrets.suspicious(pa.array(texts))
    for text, m in zip(texts, marked):
        assert m or not base(text)[1]


WORDS = "the house stands near a green river where many people walk every single day".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_a_lone_random_key_is_found(spark):
    rng = random.Random(12)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(44))
    text = f"{prose(rng, 40)} {key} {prose(rng, 40)}"
    at = text.index(key)
    for more in (0, 50):
        rows = [(0, text)] + [(1 + i, prose(rng, 80)) for i in range(more)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = {r.doc_id: r.spans for r in secrets.secrets(df).collect()}
        assert found[0] == f"random:{at}:{at + len(key)}"
        kept = {r.doc_id: r.text for r in secrets.without_secrets(df).collect()}
        assert kept[0] == text.replace(key, secrets.MASK)


def test_copies_do_not_move_the_thresholds(spark):
    rng = random.Random(13)
    letters = string.ascii_letters + string.digits

    def key():
        return "".join(rng.choice(letters) for _ in range(44))

    rows = [(i, f"{prose(rng, 40)} {key()} {prose(rng, 40)}") for i in range(300)]
    # a key that many documents hold, each with other prose beside it, and a document copied many times
    shared = key()
    held = [(1000 + i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for i in range(500)]
    even = " ".join(["qzjxkvbw yphgfumc ldrsniao tezqwkbv"] * 20)
    copies = [(5000 + i, f"{even} {rows[0][1].split()[40]} {even}") for i in range(2000)]

    def limits(own):
        df = spark.createDataFrame(own, "doc_id long, text string")
        return np.array(secrets.thresholds(secrets._levels(df)))

    alone = limits(rows)
    assert abs(limits(rows + held) - alone).max() <= 1
    assert abs(limits(rows + copies) - alone).max() <= 1


def test_keys_of_env_files_and_query_strings(spark):
    rng = random.Random(14)
    letters = string.ascii_letters + string.digits
    rows, planted = [], {}
    for i in range(160):
        key = "".join(rng.choice(letters) for _ in range(44))
        before = ("\nCLIENT_KEY=", "\nexport MY_SERVICE_CLIENT_KEY_2=", " https://a.example/b?sig=", " https://a.example/b?x=1&sig=")[i % 4]
        text = prose(rng, 40) + before + key
        planted[i] = f"random:{len(text) - 44}:{len(text) + 2 * (i % 4 == 3)}"
        rows.append((i, text + (" ", "\n", "&v=2 ", "== ")[i % 4] + prose(rng, 40)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.secrets(df).collect()}
    for kind in range(4):
        hit = [found[i] == planted[i] for i in planted if i % 4 == kind]
        assert sum(hit) > 0.8 * len(hit)
    # and short ones are tested
    assert [x.band for x in secrets.candidates("K=a8Kq03vZx7Lm2Rt9 end")[0]] == [0]


def test_random_spans_of_the_table_by_hand(spark, data, texts):
    """Thresholds and added spans once more, counted in plain Python over all texts."""
    first, fakes, found = {}, set(), []
    for i, text in texts:
        text = text or ""
        spans, tested = secrets.candidates(text)
        taken = [x for x in secrets.base_spans(text)]
        found.append((i, [x for x in spans if all(x.end <= y.start or y.end <= x.start for y in taken)]))
        for t in tested:
            at = (t.key, t.band, t.level)
            first[at] = min(first.get(at, (1 << 70, 0)), (t.decoy_key, t.decoy) if t.decoy >= 0 else (1 << 70, 0))
    fakes = {(k, at[1], level) for at, (k, level) in first.items() if k < 1 << 70}
    limits = []
    for band in range(len(secrets.LENGTHS)):
        real = [at[2] for at in first if at[1] == band]
        fake = [f[2] for f in fakes if f[1] == band]
        limit = secrets.LEVELS + 1
        for k in range(secrets.LEVELS, 0, -1):
            share = [p for s, p in zip(secrets.PROSE_STEPS, secrets.PROSE_SHARES[band]) if s <= k][-1]
            chance = (100 * share + sum(x >= k for x in fake)) / (100 + len(fake))
            if chance * max(len(real), 1) <= 0.1 * max(sum(x >= k for x in real), 1):
                limit = k
        limits.append(limit)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert secrets.thresholds(secrets._levels(df)) == limits
    want = sorted((i, [f"random:{x.start}:{x.end}" for x in own if x.level >= limits[x.band]]) for i, own in found)
    got = [(r.doc_id, [x for x in r.spans.split(",") if x.startswith("random")]) for r in secrets.secrets(df).collect()]
    assert sorted(got) == want


def test_the_rule_does_not_turn_at_a_count():
    """Around a hundred decoys and beyond, decoys of the shares that prose has leave a threshold within a step."""
    steps = np.array(secrets.PROSE_STEPS)
    for prose in secrets.PROSE_SHARES:
        share = np.array(prose)[np.searchsorted(steps, np.arange(1, secrets.LEVELS + 1), "right") - 1]
        last = None
        for decoys in (0, 1, 50, 99, 100, 101, 200, 1000, 100_000):
            fake = np.concatenate([[decoys], np.round(share * decoys)])
            own = secrets._threshold(np.concatenate([[1], np.ones(secrets.LEVELS)]), fake, prose)
            assert last is None or decoys < 99 or abs(own - last) <= 5
            last = own
