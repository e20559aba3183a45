import hashlib
import re

from docloom.llm import pii
from docloom.llm.suite import QUERIES
from tests.llm.conftest import ODD


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
    counts = tuple(sum(k == kind for _, k, _ in found) for kind in range(4))
    return (*counts, hashlib.sha256(written.encode()).hexdigest()), written


def check(found, texts):
    want = {}
    for i, text in texts:
        want.setdefault(i, set()).add(base(text))
    for r in found:
        own = (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)
        written = ",".join(x for x in r.spans.split(",") if not x.startswith("number"))
        assert (own, written) in want[r.doc_id]


def test_query(spark, data, texts):
    found = QUERIES["op10_weak_supervision_pii"](spark, data).collect()
    assert len(found) == len(texts)
    check(found, texts)


def test_odd_rows(clashing, none):
    found = pii.personal_data(clashing).collect()
    assert len(found) == len(ODD)
    check(found, [(r[0], r[1]) for r in ODD])
    assert pii.personal_data(none).collect() == []


def test_base_patterns_at_their_edges(spark):
    texts = [
        "a@b.c@d.e x_y@z.a.b_c@d.e @x.y a@b a@b.c.",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 1.1.1.256.1 9" * 2,
        "4130383451285691 4130-3834 5128 5691 41303834512856910 0000 0000 0000 00",
        "+1 (262) 555-3752 +12345 +1234567890123456 ++49 30 1234567. + 1",
        "漢字 é@é a@漢.b 😀 1.2.3.4😀+49(0)30-1234567",
        "1" * 5000 + " " + "1." * 3000 + "a@" + "b." * 3000 + "c " + "+" + "1 " * 3000,
        "a%b+c@d-e.f-g 12 34 56 78 90 12 34 56 78",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(pii.personal_data(df).collect(), list(enumerate(texts)))


def test_labelers_reliabilities_are_recovered():
    """Patterns drawn from known reliabilities give chances near the true posterior."""
    import itertools

    right = [0.95, 0.9, 0.8, 0.85, 0.7]
    counts, truth = [], {}
    for values in itertools.product((-1, 1), repeat=5):
        yes = no = 0.5
        for v, p in zip(values, right):
            yes *= p if v > 0 else 1 - p
            no *= 1 - p if v > 0 else p
        votes = ",".join(map(str, values))
        counts.append(("number", votes, round(100_000 * (yes + no))))
        truth["number", votes] = yes / (yes + no)
    found = pii.reliabilities(counts)
    assert max(abs(found[k] - truth[k]) for k in truth) < 0.1
    assert pii.reliabilities([]) == {}


def test_supported_numbers_are_added(spark):
    rows = [(i, f"please call phone 262 555 {3000 + i} now") for i in range(60)]
    rows += [(100 + i, f"the version 12345678{i % 10} is out") for i in range(60)]
    rows += [(200 + i, f"mail a{i}@b.com or phone +1 (262) 555-{3000 + i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    assert sum("number:18:30" == found[i] for i in range(60)) > 50
    assert not any("number" in found[100 + i] for i in range(60))


def test_main_path_is_native(spark, odd):
    plan = pii.matches(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_neighbouring_numbers_stay_apart(spark):
    texts = {
        "555-123-4567 555-987-6543": "0:12 13:25",
        "262 555 3752 414 555 3753 608 555 3754": "0:12 13:25 26:38",
        "10.20.30.40 555-123-4567": "0:11 12:24",
        "+1 (262) 555-3752 555-123-4567": "0:17 18:30",
        "030 1233000 089 7653000": "0:11 12:23",
        "12345678 4130383451285691": "0:8 9:25",
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("0L AS doc_id", "text").coalesce(1)
    found = {}
    for r in pii.candidates(pii.matches(df)).filter("kind = 'number'").sort("row", "start").collect():
        found.setdefault(r.row, []).append(f"{r.start}:{r.end}")
    assert [" ".join(x) for x in found.values()] == list(texts.values())


def test_neighbouring_numbers_are_added(spark):
    rows = [(i, f"please call phone 262 555 {3000 + i} 414 555 {4000 + i} now") for i in range(60)]
    rows += [(100 + i, f"the version 12345678{i % 10} is out") for i in range(60)]
    rows += [(200 + i, f"call phone 81.20.30.40 262 555 {5000 + i} now") for i in range(60)]
    rows += [(300 + i, f"mail a{i}@b.com or phone +1 (262) 555-{3000 + i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    assert all(found[i] == "number:18:30,number:31:43" for i in range(60))
    assert not any(found[100 + i] for i in range(60))
    assert all(found[200 + i] == "ip:11:22,number:23:35" for i in range(60))


def test_dialling_codes_vote_on_numbers(spark):
    rows = [(0, "a 2625553752 b"), (1, "a 1234567890 b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    votes = {r.start: r.votes for r in pii._votes(pii.candidates(pii.matches(df.filter("doc_id = 0")))).collect()}
    assert [v.split(",")[2] for v in votes.values()] == ["1"]
    votes = [r.votes for r in pii._votes(pii.candidates(pii.matches(df.filter("doc_id = 1")))).collect()]
    assert [v.split(",")[2] for v in votes] == ["0"]
