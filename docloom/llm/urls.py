"""URL filter: fixed rules, then a tree of path templates per host.

Rules name a host and a path prefix and hold for subdomains; the longest decides. Other
pages are judged by their template. Paths are read segment by segment, to their last: at each node of a host's
tree, segments that look like numbers, hashes or rarely repeated words become wildcards, and
the rest stay branches. A node with too few paths for a wildcard is finished at once, and segments that
all paths of a node share are passed in one step, so the rounds follow where paths branch. Branches of one host that are alike in shape and do not differ in
their share of blocked pages are merged. A template is rejected if its smoothed share of
blocked labelled pages is high. Distinct paths are counted first, so a page that occurs very
often is one row of the tree.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.joins import spread_join
from docloom.workspace import stage


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: A kind of segment becomes a wildcard from so many values on; words must also be so rare.
VALUES = 3
WORDS, RARE = 10, 0.3
#: Standard errors by which a branch may differ and be merged.
ALIKE = 2.0
#: Labels that the share of the host counts as, and the share from which a template is rejected.
PRIOR = 4.0
REJECT = 0.7

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://`` or url."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), F.regexp_extract(text, r"://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _wildcard(segment: Column) -> Column:
    """What a segment becomes if its node is variable; numbers keep a file ending."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,5})$", 1)
    return (
        F.when(segment == "", "")
        .when(segment.rlike(r"^[0-9]+(\.[A-Za-z][A-Za-z0-9]{0,5})?$"), F.concat(F.lit("<num>"), ending))
        .when(segment.rlike("^[0-9A-Fa-f-]{8,}$") & segment.rlike("[0-9]"), "<hex>")
        .when(segment.rlike("[0-9]"), F.concat(F.lit("<mixed>"), ending))
        .otherwise("<word>")
    )


def _shared(least: Column, most: Column) -> Column:
    """Number of leading segments that two arrays, and so all between them, have in common."""
    same = F.transform(F.arrays_zip(least.alias("a"), most.alias("b")), lambda x: x["a"].eqNullSafe(x["b"]))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(least)).otherwise(differs - 1).cast("int")


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, n and more) with their template, an array of segments and wildcards."""
    node = ["host", "template"]
    plain = F.split(F.regexp_replace("path", "^/", ""), "/")
    tree = stage(
        paths.withColumn("segments", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(plain))
        .withColumn("template", F.array().cast("array<string>")),
        "tree",
    )
    columns = tree.columns
    ended = F.size("segments") == 0
    finished = F.concat("template", "segments")
    done = []
    while True:
        done.append(tree.filter(ended))
        open_ = tree.filter(~ended)
        # a node of fewer paths has too few values for any wildcard
        nodes = stage(
            open_.groupBy(*node)
            .agg(F.count("*").alias("paths"), F.min("segments").alias("least"), F.max("segments").alias("most"))
            .filter(F.col("paths") >= min(VALUES, WORDS))
            .select(*node, "paths", _shared(F.col("least"), F.col("most")).alias("shared")),
            "nodes",
        )
        if nodes.isEmpty():
            done.append(open_.withColumn("template", finished))
            break
        met = stage(spread_join(open_, nodes, node, "paths", "left"), "met")
        done.append(met.filter("paths IS NULL").withColumn("template", finished))
        here = (
            met.filter("paths IS NOT NULL")
            .withColumn("template", F.concat("template", F.slice("segments", 1, F.col("shared"))))
            .withColumn("segments", F.slice("segments", F.col("shared") + 1, F.size("segments")))
            .withColumn("segment", F.get("segments", F.lit(0)))
            .withColumn("kind", _wildcard(F.col("segment")))
        )
        values = (
            here.filter(F.col("segment").isNotNull())
            .groupBy(*node, "kind", "segment")
            .agg(F.sum("n").alias("n"), F.count("*").alias("paths"))
        )
        kinds = values.groupBy(*node, "kind").agg(
            F.count("*").alias("values"), F.sum("n").alias("n"), F.sum("paths").alias("weight")
        )
        word = (F.col("values") >= WORDS) & (F.col("values") >= RARE * F.col("n"))
        variable = stage(
            kinds.filter(F.when(F.col("kind") == "<word>", word).otherwise(F.col("values") >= VALUES)).select(
                *node, "kind", "weight"
            ),
            "variable",
        )
        token = F.when(F.col("weight").isNotNull(), F.col("kind")).otherwise(F.col("segment"))
        tree = stage(
            spread_join(here, variable, [*node, "kind"], "weight", "left")
            .withColumn(
                "template",
                F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.array_append("template", token)),
            )
            .withColumn("segments", F.slice("segments", 2, F.size("segments")))
            .select(*columns),
            "tree",
        )
    found = done[0].select(*columns)
    for part in done[1:]:
        found = found.union(part.select(*columns))
    return found.drop("segments")


def _share(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + PRIOR * prior) / (labelled + PRIOR)


def purities(tree: DataFrame) -> DataFrame:
    """(host, template, paths, share): smoothed share of blocked labelled pages after merging alike branches.

    ``paths`` counts the rows of ``tree``.
    """
    sums = [F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")]
    shape = F.transform("template", lambda x: F.when(x.startswith("<") | (x == ""), x).otherwise("*"))
    branches = stage(
        tree.groupBy("host", "template").agg(*sums, F.count("*").alias("paths")).withColumn("shape", shape), "branches"
    )
    total = branches.agg(*sums).first()
    overall = F.lit(((total.blocked or 0) + 0.5) / ((total.labelled or 0) + 1))

    def beside(frame: DataFrame, rows: DataFrame, prefix: str, *keys: str) -> DataFrame:
        """``frame`` with the sums of ``rows`` over its keys; a host may have very many templates."""
        found = rows.groupBy(*keys).agg(*sums, F.count("*").alias("_weight"))
        found = found.withColumnsRenamed({"blocked": f"{prefix}_blocked", "labelled": f"{prefix}_labelled"})
        return spread_join(frame, stage(found, prefix), list(keys), "_weight", "left").drop("_weight")

    pooled = beside(branches, branches, "pool", "host", "shape")
    rate = (F.col("pool_blocked") + 0.5) / (F.col("pool_labelled") + 1)
    error = F.sqrt(F.col("labelled") * rate * (1 - rate))
    alike = (F.col("labelled") == 0) | (F.abs(F.col("blocked") - F.col("labelled") * rate) <= ALIKE * error)
    marked = stage(pooled.withColumn("alike", alike), "marked")
    merged = beside(beside(marked, marked.filter("alike"), "alike", "host", "shape"), branches, "host", "host")
    own = _share(F.col("host_blocked"), F.col("host_labelled"), overall)
    share = F.when(F.col("alike"), _share(F.col("alike_blocked"), F.col("alike_labelled"), own)).otherwise(
        _share(F.col("blocked"), F.col("labelled"), own)
    )
    return merged.select("host", "template", "paths", share.alias("share"))


def filtered(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and template for every row of ``pages``.

    Pages that a rule decides are the labels of the templates. A null url, or one without
    ``://``, has an empty host and path and is judged as such. Rows that repeat get equal
    verdicts and count as often as they occur; other columns are ignored; an empty table gives
    an empty result. Without labels every template is allowed.
    """
    host, path = parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    judged = parsed.withColumn("rule", rule).withColumn("by_rule", verdict)
    paths = judged.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.sum((F.col("by_rule") == "block").cast("long")).alias("blocked"),
        F.count("by_rule").alias("labelled"),
    )
    tree = templates(paths.fillna(0, ["blocked"]))
    shares = stage(purities(tree), "shares")
    verdicts = stage(
        spread_join(tree, shares, ["host", "template"], "paths").select(
            "host",
            "path",
            "n",
            F.concat_ws("/", F.lit(""), "template").alias("template"),
            F.when(F.col("share") >= REJECT, "block").otherwise("allow").alias("by_template"),
        ),
        "verdicts",
    )
    return spread_join(judged, verdicts, ["host", "path"], "n").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", "by_template").alias("verdict"),
        "template",
    )
