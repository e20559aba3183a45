"""Personal data by weak supervision, in DataFrame functions only.

Fixed patterns give the base spans: e-mail and IP addresses, card and phone numbers. They and
other strings of digits are candidates. Labelers vote on each for, against or not at all: what the
pattern says, a checksum, lists of top-level domains, of area and dialling codes and of reserved
networks, and words in front that point to or away from personal data. Expectation-maximisation over the
counts of all vote patterns estimates how reliable each labeler is. The resulting chances train a
classifier on the looks and surroundings of a span, and candidates that it takes for
personal data are added to the base spans.

Positions come from cutting a text at the matches: a match starts behind all pieces and matches before
it, so starts are running sums of lengths, which count code points.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.workspace import local_frame, stage

#: Base kinds in the order that breaks ties; ``number`` is what the classifier adds.
KINDS = ("email", "ip", "card", "phone", "number")
#: Forms of a single number, so that neighbours stay apart; an address of four parts is passed over whole,
#: and marks between groups are alike where no form is known.
NUMBERS = (
    r"[0-9]++(?:\.[0-9]++){3}",
    r"[0-9]{4}(?:[\x20-][0-9]{4}){3}",
    r"(?:(?:\+[0-9]{1,3}|1)[\x20.-]{0,2})?\(?[0-9]{3}[\x20().-]{1,3}[0-9]{3}[\x20.-]{1,3}[0-9]{4}",
    r"\+?\(?[0-9]{2,5}\)?([\x20.-]{1,3})[0-9]{2,4}(?:\1[0-9]{2,4}){1,3}",
    r"\+?\(?[0-9]{2,5}\)?[\x20-][0-9]{5,8}",
    r"[0-9](?:\x20[0-9]){6,18}",
    r"\+?\(?[0-9]++(?:[().-]{1,3}[0-9]++)*+",
)
#: The patterns. Possessive loops and looks behind keep them linear and change no match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![A-Za-z0-9+.])(?:" + "|".join(NUMBERS) + r")(?![A-Za-z0-9])",
}
#: What a text must hold for a pattern to be tried; a necessary condition, so nothing is missed.
GATES = {
    "email": r"@[A-Za-z0-9-]++\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
    "number": r"[0-9][\x20().0-9-]{5,}[0-9]",
}
#: Fixed values of the labelers.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "ch", "at")
CODES = ("1", "7", "33", "34", "39", "41", "43", "44", "49", "55", "61", "81", "86", "91")
#: Numbers that begin as in national and international dialling: a North American area and exchange, a
#: trunk zero, or two zeros and a code.
DIALLED = rf"^(?:1?[2-9][0-8][0-9][2-9][0-9]{{6}}|0[1-9][0-9]{{7,10}}|00(?:{'|'.join(CODES)})[0-9]{{6,12}})$"
RESERVED = r"^(?:0|10|127|169\.254|192\.168|255)\."
TOWARDS = r"\b(?:e-?mail|mail|contact|phone|tel|telephone|call|fax|mobile|cell|card|visa|credit|account|iban|ssn|reach|address|telefon|correo|courriel)\b"
AWAY = r"\b(?:version|v|isbn|issn|page|pages|section|chapter|figure|table|build|release|license|commit|id|no|order|ticket)\b[\x20.:#]*$"
#: Code points before a match that the context labelers read.
CONTEXT = 32
LABELERS = ("pattern", "checksum", "list", "towards", "away")
ROUNDS = 60


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The checksum of card numbers, for a string of digits."""
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        double = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, double).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + weighed(i))
    return (n > 0) & (total % 10 == 0)


def _octets(text: Column) -> Column:
    """All four parts of an address are at most 255, whatever zeros lead them."""

    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(text, r"\."), small)


def _valid(kind: Column, text: Column, digits: Column) -> Column:
    """Whether a match of the base patterns is kept; no other kind is valid by pattern."""
    n = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", _octets(text))
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(F.lit(False))
    )


def matches(docs: DataFrame) -> DataFrame:
    """A row for every row of ``docs``: row, doc_id, and per kind the matches and what lies between."""
    text = F.coalesce("text", F.lit(""))
    columns = []
    for kind in KINDS:
        some = text.rlike(GATES[kind])
        pieces = F.transform(
            F.split(text, PATTERNS[kind], -1),
            lambda x: F.struct(
                F.length(x).alias("size"),
                F.lower(F.right(x, F.lit(CONTEXT))).alias("before"),
                F.left(x, F.lit(1)).alias("after"),
            ),
        )
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        columns += [F.when(some, pieces).alias(f"{kind}_pieces"), F.when(some, found).alias(f"{kind}_found")]
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *columns)


def _zipped(found: str, pieces: str) -> Column:
    """Every match with the piece before it and the first character of the piece behind it."""
    return F.transform(
        found,
        lambda x, i: F.struct(
            x.alias("text"), F.get(pieces, i).alias("piece"), F.get(pieces, i + 1)["after"].alias("after")
        ),
    )


def candidates(found: DataFrame) -> DataFrame:
    """A row for every match: row, kind, start, end, text, before and after."""
    parts = []
    for kind in KINDS:
        parts.append(
            found.filter(F.size(f"{kind}_found") > 0).select(
                "row",
                F.lit(kind).alias("kind"),
                F.posexplode(_zipped(f"{kind}_found", f"{kind}_pieces")).alias("place", "match"),
            )
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    along = Window.partitionBy("row", "kind").orderBy("place")
    size = F.length("match.text")
    end = F.sum(F.col("match.piece.size") + size).over(along)
    return rows.select(
        "row",
        "kind",
        (end - size).cast("int").alias("start"),
        end.cast("int").alias("end"),
        F.col("match.text").alias("text"),
        F.col("match.piece.before").alias("before"),
        F.col("match.after").alias("after"),
    )


def _votes(rows: DataFrame) -> DataFrame:
    """Candidates with validity, one vote per labeler and the features of the classifier."""
    kind, text, digits = F.col("kind"), F.col("text"), F.col("digits")
    n = F.length("digits")
    rows = rows.withColumn("digits", _digits(text)).withColumn("valid", _valid(kind, text, digits))
    # a run of digits that is no card number is a number, and no candidate twice; an address is a base span
    address = F.when(text.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), _octets(text)).otherwise(False)
    rows = rows.filter(F.col("valid") | (kind == "number") & n.between(7, 19) & ~address)

    def vote(good: Column, bad: Column) -> Column:
        return F.when(good, 1).when(bad, -1).otherwise(0)

    top = F.lower(F.element_at(F.split(text, r"\."), -1))
    dialled = F.lit(False)
    for code in CODES:
        dialled = dialled | digits.startswith(code)
    listed = (
        F.when(kind == "email", vote(top.isin(*DOMAINS), F.lit(False)))
        .when(kind == "ip", vote(F.lit(False), text.rlike(RESERVED)))
        .when(kind == "phone", vote(dialled, ~dialled))
        .when(kind == "number", vote(digits.rlike(DIALLED), F.lit(False)))
        .otherwise(F.lit(0))
    )
    grouped = text.rlike(r"^\(?[0-9]{2,4}[)\x20.-]{1,2}[0-9]{2,4}(?:[\x20.-][0-9]{2,4})+$")
    long = n.between(14, 19)
    votes = [
        vote(F.col("valid") | grouped, (kind == "number") & ~grouped),
        F.when(kind.isin("card", "number") & long, F.when(luhn(digits), 1).otherwise(-1)).otherwise(0),
        listed,
        vote(F.col("before").rlike(TOWARDS), F.lit(False)),
        vote(F.lit(False), F.col("before").rlike(AWAY)),
    ]

    def place(char: Column) -> Column:
        return (
            F.when(F.coalesce(char, F.lit("")) == "", "none")
            .when(char.rlike(r"^\s"), "space")
            .when(char.rlike("^[A-Za-z]"), "letter")
            .when(char.rlike("^[0-9]"), "digit")
            .otherwise("mark")
        )

    features = [
        F.concat(F.lit("kind="), kind),
        F.concat(F.lit("digits="), F.least(n, F.lit(20)).cast("string")),
        F.concat(F.lit("marks="), F.least(F.length(text) - n, F.lit(8)).cast("string")),
        F.concat(F.lit("grouped="), grouped.cast("string")),
        F.concat(F.lit("before="), place(F.right("before", F.lit(1)))),
        F.concat(F.lit("after="), place(F.col("after"))),
        F.concat(F.lit("towards="), votes[3].cast("string")),
        F.concat(F.lit("away="), votes[4].cast("string")),
    ]
    return rows.select(
        "row",
        "kind",
        "start",
        "end",
        "valid",
        F.concat_ws(",", *(v.cast("string") for v in votes)).alias("votes"),
        F.array(*features).alias("features"),
    )


def reliabilities(counts: Sequence[tuple[str, str, int]], rounds: int = ROUNDS) -> dict[tuple[str, str], float]:
    """Chance of being personal data for each (kind, votes), by expectation-maximisation.

    Each labeler is right with a chance of its own for either truth; not voting says nothing. ``counts``
    has a row for each pattern of votes, at most three to the power of the labelers per kind.
    """
    parsed = [(kind, votes, [int(v) for v in votes.split(",")], n) for kind, votes, n in counts]
    chance = {}
    for kind, votes, values, _ in parsed:
        cast = [v for v in values if v]
        chance[kind, votes] = (1 + sum(v > 0 for v in cast)) / (2 + len(cast))
    for _ in range(rounds):
        right = [[[3.0, 1.0], [1.0, 3.0]] for _ in LABELERS]
        prior: dict[str, list[float]] = {}
        for kind, votes, values, n in parsed:
            p = chance[kind, votes]
            total = prior.setdefault(kind, [1.0, 1.0])
            total[0] += p * n
            total[1] += (1 - p) * n
            for own, value in zip(right, values):
                if value:
                    own[0][value < 0] += p * n
                    own[1][value < 0] += (1 - p) * n
        new = {}
        for kind, votes, values, _ in parsed:
            odds = math.log(prior[kind][0] / prior[kind][1])
            for own, value in zip(right, values):
                if value:
                    odds += math.log(own[0][value < 0] / sum(own[0])) - math.log(own[1][value < 0] / sum(own[1]))
            new[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max((abs(new[k] - chance[k]) for k in new), default=0.0)
        chance = new
        if moved < 1e-9:
            break
    return chance


def classified(rows: DataFrame) -> DataFrame:
    """Candidates with the classifier's chance ``p`` of being personal data.

    Only counts of vote patterns and of feature values come to the driver, whose numbers are bounded by
    the labelers and features.
    """
    spark = rows.sparkSession
    counts = [tuple(row) for row in rows.groupBy("kind", "votes").count().collect()]
    chance = [(kind, votes, p) for (kind, votes), p in sorted(reliabilities(counts).items())]
    if not chance:
        return rows.withColumn("p", F.lit(0.0))
    known = local_frame(spark, chance, "kind string, votes string, chance double")
    soft = rows.join(F.broadcast(known), ["kind", "votes"])
    sums = (
        soft.select(F.explode("features").alias("feature"), "chance")
        .groupBy("feature")
        .agg(F.sum("chance").alias("yes"), F.sum(1 - F.col("chance")).alias("no"))
        .collect()
    )
    # every candidate has one value of each feature
    yes = sum(row.yes for row in sums if row.feature.startswith("kind="))
    no = sum(row.no for row in sums if row.feature.startswith("kind="))
    weight = {
        row.feature: math.log((row.yes + 0.5) / (yes + 1)) - math.log((row.no + 0.5) / (no + 1)) for row in sums
    }
    weights = F.create_map(*(F.lit(x) for item in sorted(weight.items()) for x in item))
    odds = F.aggregate(
        "features", F.lit(math.log((yes + 0.5) / (no + 0.5))), lambda acc, x: acc + F.coalesce(weights[x], F.lit(0.0))
    )
    return rows.withColumn("p", 1 / (1 + F.exp(-odds)))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256 and spans for every row of ``docs``.

    Spans that the classifier adds overlap no base span. Null and empty texts have no spans;
    rows that repeat get equal results, a null doc_id is kept, other columns are ignored, and an
    empty table gives an empty result. Without candidates nothing is learned or added.
    """
    found = stage(matches(docs), "matches")
    voted = stage(_votes(candidates(found)), "votes")
    rows = classified(voted).filter(F.col("valid") | (F.col("p") >= 0.5))
    order = F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int")
    gathered = rows.groupBy("row").agg(
        F.collect_list(F.struct("start", order.alias("order"), "end", "valid")).alias("all")
    )

    def joined(spans: Column) -> Column:
        names = F.lit(list(KINDS))
        return F.concat_ws(
            ",",
            F.transform(
                F.array_sort(spans),
                lambda x: F.concat_ws(
                    ":", F.element_at(names, x["order"]), x["start"].cast("string"), x["end"].cast("string")
                ),
            ),
        )

    per_row = gathered.withColumn("base", F.filter("all", lambda x: x["valid"])).withColumn(
        "added",
        F.filter(
            "all",
            lambda x: ~x["valid"]
            & ~F.exists("base", lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])),
        ),
    )

    def count(kind: int) -> Column:
        n = F.size(F.filter("base", lambda x: x["order"] == kind + 1))
        return F.coalesce(F.when(F.col("base").isNotNull(), n), F.lit(0)).cast("long")

    every = found.select("row", "doc_id").join(per_row, "row", "left")
    text = F.coalesce(joined(F.col("base")), F.lit(""))
    return every.select(
        "doc_id",
        *(count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:4])),
        F.sha2(text, 256).alias("base_sha256"),
        F.coalesce(joined(F.concat("base", "added")), F.lit("")).alias("spans"),
    )
