import re
from collections import Counter, defaultdict
from math import sqrt

from docloom.llm import urls
from docloom.llm.suite import QUERIES

RULES = [tuple(r) for r in urls.RULES]


def judged(url):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), match[1]) if match else ""
    path = match[2] if match else ""
    fits = [
        (len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def check(found, pages):
    want = {}
    for i, url in pages:
        want.setdefault(i, set()).add(judged(url))
    for r in found:
        options = want[r.page_id]
        assert any((r.host, r.path, r.rule) == o[:3] and (o[3] is None or o[3] == r.verdict) for o in options)
        assert r.verdict in ("allow", "block")


def test_query(spark, data):
    import duckdb

    pages = duckdb.sql(f"SELECT page_id, url FROM '{data}/pages.parquet'").fetchall()
    found = QUERIES["op7_path_template_urls"](spark, data).collect()
    assert len(found) == len(pages)
    check(found, pages)


def test_odd_urls(spark):
    pages = [
        (1, None), (2, ""), (3, "no scheme/x"), (4, "://"), (5, "http://EXAMPLE.ORG"), (6, "http://org/es/"),
        (7, "x://a.example.org/en/1?x://b/c"), (8, "http://xorg/"), (9, "http://É.COM/fr/é#/de/"),
        (9, "http://É.COM/fr/é#/de/"), (None, "http://a.com/de/"), (10, "http://a.net/" + "d/" * 5000),
        (11, "http://a.net//x//"), (12, "http://a.com/fr"),
    ]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, template string")
    found = urls.filtered(df).collect()
    assert len(found) == len(pages)
    check(found, pages)
    assert urls.filtered(df.limit(0)).collect() == []


def test_templates_generalise_and_purity_decides(spark):
    rules = (urls.Rule("h.net", "/spam/1", "block"), urls.Rule("h.net", "/good/1", "allow"))
    pages = [f"http://h.net/{kind}/{n}" for kind in ("spam", "good") for n in range(10, 60)]
    pages += ["http://h.net/about", "http://other.net/spam/7"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    found = {pages[r.page_id]: r for r in urls.filtered(df, rules).collect()}
    assert found["http://h.net/spam/30"].template == "/spam/<num>"
    assert found["http://h.net/about"].template == "/about"
    assert found["http://h.net/spam/30"].verdict == "block"
    assert found["http://h.net/good/30"].verdict == "allow"
    assert found["http://h.net/about"].verdict == "allow" and found["http://other.net/spam/7"].verdict == "allow"


def test_alike_branches_are_merged(spark):
    """A branch without labels takes the share of like branches; one that differs keeps its own."""
    tree = spark.createDataFrame(
        [("h", ["a", "<num>"], 40, 40), ("h", ["b", "<num>"], 38, 40), ("h", ["c", "<num>"], 0, 0), ("h", ["d"], 0, 80)],
        "host string, template array<string>, blocked long, labelled long",
    )
    share = {"/".join(r.template): r.share for r in urls.purities(tree).collect()}
    assert share["c/<num>"] > 0.9 and share["d"] < 0.1
    assert abs(share["a/<num>"] - share["b/<num>"]) < 1e-9


def kind(segment):
    """Wildcard of a segment in a variable node, said anew."""
    end = re.search(r"\.[A-Za-z][A-Za-z0-9]{0,5}$", segment)
    end = end[0] if end else ""
    if not segment:
        return ""
    if re.fullmatch(r"[0-9]+(\.[A-Za-z][A-Za-z0-9]{0,5})?", segment):
        return "<num>" + end
    if re.fullmatch("[0-9A-Fa-f-]{8,}", segment) and re.search("[0-9]", segment):
        return "<hex>"
    return "<mixed>" + end if re.search("[0-9]", segment) else "<word>"


def by_hand(pages, rules):
    """(host, path): template and verdict, from one tree per host in plain Python."""
    seen = Counter()
    for url in pages:
        host, path, *_ = judged(url)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        seen[host, path, best and best.verdict] += 1
    n, blocked, labelled = Counter(), Counter(), Counter()
    for (host, path, verdict), count in seen.items():
        n[host, path] += count
        blocked[host, path] += count * (verdict == "block")
        labelled[host, path] += count * (verdict is not None)
    template = {key: () for key in n}
    segments = {(h, p): [] if p == "" else p.removeprefix("/").split("/") for h, p in n}
    for level in range(max(map(len, segments.values()), default=0)):
        nodes = defaultdict(Counter)
        for key, own in segments.items():
            if level < len(own):
                nodes[key[0], template[key], kind(own[level])][own[level]] += n[key]
        for key, own in segments.items():
            if level < len(own):
                k = kind(own[level])
                values = nodes[key[0], template[key], k]
                many = len(values) >= urls.VALUES
                if k == "<word>":
                    many = len(values) >= urls.WORDS and len(values) >= urls.RARE * values.total()
                segments[key] = own[:level] + [k if many else own[level]] + own[level + 1 :]
        template = {key: tuple(own[: level + 1]) for key, own in segments.items()}
    sums = defaultdict(lambda: [0, 0])
    for key in n:
        at = sums[key[0], template[key]]
        at[0] += blocked[key]
        at[1] += labelled[key]
    host_sum, pool, alike = (defaultdict(lambda: [0, 0]) for _ in range(3))
    shape = {b: (b[0], tuple(x if x == "" or x[0] == "<" else "*" for x in b[1])) for b in sums}
    for b, (bad, all_) in sums.items():
        for at in (host_sum[b[0]], pool[shape[b]]):
            at[0] += bad
            at[1] += all_
    like = set()
    for b, (bad, all_) in sums.items():
        rate = (pool[shape[b]][0] + 0.5) / (pool[shape[b]][1] + 1)
        if all_ == 0 or abs(bad - all_ * rate) <= urls.ALIKE * sqrt(all_ * rate * (1 - rate)):
            like.add(b)
            alike[shape[b]][0] += bad
            alike[shape[b]][1] += all_
    overall = (sum(x[0] for x in sums.values()) + 0.5) / (sum(x[1] for x in sums.values()) + 1)
    found = {}
    for key in n:
        b = (key[0], template[key])
        bad, all_ = host_sum[key[0]]
        own = (bad + urls.PRIOR * overall) / (all_ + urls.PRIOR)
        bad, all_ = alike[shape[b]] if b in like else sums[b]
        share = (bad + urls.PRIOR * own) / (all_ + urls.PRIOR)
        found[key] = ("".join("/" + x for x in template[key]), "block" if share >= urls.REJECT else "allow")
    return found


def agree(found, pages, rules):
    want = by_hand(pages, rules)
    for r in found:
        template, verdict = want[r.host, r.path]
        assert r.template == template
        assert r.rule is not None or r.verdict == verdict


def test_templates_of_the_table_by_hand(spark, data):
    import duckdb

    pages = duckdb.sql(f"SELECT page_id, url FROM '{data}/pages.parquet'").fetchall()
    df = spark.createDataFrame(pages, "page_id long, url string")
    agree(urls.filtered(df).collect(), [url for _, url in pages], urls.RULES)


def test_deep_trees_by_hand(spark):
    """Branches behind the eighth segment, a shared path of 3 000 segments, paths that end inside others."""
    rules = (urls.Rule("h.net", "/a/b/c/d/e/f/g/h/item/1", "block"), urls.Rule("h.net", "/a/b/c/d/e/f/g/h/news/1", "allow"))
    stem = "http://h.net/a/b/c/d/e/f/g/h"
    pages = [f"{stem}/{k}/{n}/{end}" for k in ("item", "news") for n in range(10, 40) for end in ("edit", "view.html")]
    pages += [stem, stem + "/", f"{stem}/item", f"{stem}/item/12"] * 2
    pages += [f"http://long.net/{'d/' * 3000}{n}" for n in range(5)] + ["http://long.net/" + "d/" * 1500]
    pages += [f"http://w.net/{a}{b}/x{b}" for a in "abcd" for b in "efgh"] + [None, "http://w.net", "http://w.net//7//"] * 3
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    found = urls.filtered(df, rules).collect()
    assert len(found) == len(pages)
    agree(found, pages, rules)
    rows = {pages[r.page_id]: r for r in found}
    assert rows[f"{stem}/item/35/edit"].template == "/a/b/c/d/e/f/g/h/item/<num>/edit"
    assert rows[f"{stem}/item/35/edit"].verdict == "block" and rows[f"{stem}/news/35/edit"].verdict == "allow"
