"""Toxicity of texts whose words may be disguised.

A disguised word is taken for a plain one sent through a noisy channel that swaps letters for
look-alikes (``1d10t``), repeats them (``stuuupid``, ``iiddiioott``) and puts white space or marks
between them (``m o r o n``). Its lattice holds, for every character seen, the characters it may stand
for; white space between single characters may stand for nothing or for the end of a word. Viterbi decoding
under a character model finds the likeliest plain words. The model holds the counts of all
four-character strings of all documents. A word with repeated letters is decoded under two channels, one
that repeats now and then and one that does so as a habit, as repeated forms of the corpus count in the model too. Words of
letters of which none follows itself have one path only and stay as they are; a word that is decoded
counts as written as well.

Restored words and their beginnings are then weighed as indicators. Indicators and weights come
from labelled rows outside the held-out fifth: at most ``SAMPLE`` per class, chosen by hash. The
weights are those of a logistic regression, in which words that merely accompany others count for little.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.texts import chunks

#: Characters of the model: blank, a-z, and one for all others.
ALPHABET = 28
OTHER = 27
GRAMS = ALPHABET**4
#: Labelled rows of each class that the classifier may learn from.
SAMPLE = 6_000
#: Indicators that the classifier keeps, and the evidence (G squared) that each needs.
INDICATORS = 500
EVIDENCE = 24.0
#: Strength of the pull that keeps weights small.
PULL = 0.3
#: Lengths of the word beginnings that are indicators besides whole words.
BEGINNINGS = (4, 5)
#: Words whose weight a worker remembers.
REMEMBERED = 300_000

#: Letters that look like the character.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "¡": "i", "£": "l",
}
#: Log probabilities of the channel: a letter as itself, swapped, sent again, followed by a mark.
PLAIN, SWAPPED, AGAIN, MARKED = math.log(0.9), math.log(0.1), math.log(0.05), math.log(0.05)

_SEPARATORS = frozenset("._-*~ ")
_EDGES = ".,;:?\"'()[]{}<>#%&*_-~/\\"
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_RUN = re.compile(r"(.)\1")
_RUNS = re.compile(r"(.)\1+")
_SIGNS = re.compile(r"[^\W\d_].*[0-9@$!|+(€¡£._\-*~]|[0-9@$!|+(€¡£._\-*~].*[^\W\d_]")


def _fold() -> np.ndarray:
    """Model character of every code point: accents and case do not count."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x250):
        base = unicodedata.normalize("NFKD", chr(code))[:1].lower()
        if "a" <= base <= "z":
            table[code] = ord(base) - 96
    for code in (*range(0x09, 0x0E), 0x20, 0xA0):
        table[code] = 0
    return table


FOLD = _fold()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the four-character strings of a partition, one row for each string seen."""
    total = np.zeros(GRAMS, np.int64)
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            codes = np.frombuffer(chunk.data.tobytes().decode().encode("utf-32-le"), np.uint32)
            rows = np.searchsorted(np.flatnonzero((chunk.data & 0xC0) != 0x80), chunk.bounds[1:-1])
            # three blanks before and behind each text
            kinds = np.insert(FOLD[codes], np.repeat(rows, 3), 0)
            kinds = np.concatenate([np.zeros(3, np.uint8), kinds, np.zeros(3, np.uint8)]).astype(np.int64)
            # runs of blanks count as one
            keep = np.ones(len(kinds), bool)
            keep[3:-3] = (kinds[3:-3] > 0) | (kinds[2:-4] > 0)
            kinds = kinds[keep]
            gram = ((kinds[:-3] * ALPHABET + kinds[1:-2]) * ALPHABET + kinds[2:-1]) * ALPHABET + kinds[3:]
            total += np.bincount(gram, minlength=GRAMS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of each character after three others, from all documents.

    Only sums per four-character string reach the driver: at most 28**4 rows at any input size.
    """
    rows = (
        docs.select("text").mapInArrow(_count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(GRAMS)
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    counts = counts.reshape((ALPHABET,) * 4)
    # plain language only: what a disguise looks like is the channel's part
    for axis in range(4):
        np.moveaxis(counts, axis, 0)[OTHER] = 0
    model = np.full(ALPHABET, 1 / ALPHABET)
    for order in range(1, 5):
        part = counts.sum(axis=tuple(range(4 - order)))
        total = part.sum(axis=-1, keepdims=True)
        kinds = (part > 0).sum(axis=-1, keepdims=True)
        # as many kinds were seen, so much weight goes to the shorter context
        model = (part + (kinds + 1) * model) / (total + kinds + 1)
    return np.log(model).astype(np.float32).reshape(-1)


class Restorer:
    """Decodes disguised words under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.known: dict[str, list[str]] = {}

    def restore(self, seen: str, habit: bool = False) -> str:
        """The likeliest plain word behind the characters; time in proportion to their number.

        With ``habit`` the channel is one that repeats as a habit: a character that follows itself was sent again.
        A state is the last three characters sent, so a step has few states and memory
        holds one back pointer for each.
        """
        model, seen = self.model, seen.lower()
        best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        before = ""
        for char in seen:
            if habit and char == before:
                continue
            code = int(FOLD[ord(char)])
            if char == " ":
                options = [(0, char, MARKED)]
            else:
                options = [(code, char, PLAIN)] if char not in _SEPARATORS else [(OTHER, char, PLAIN)]
            like = LOOKALIKES.get(char, "")
            options += [(ord(x) - 96, x, SWAPPED - math.log(len(like))) for x in like]
            silent = MARKED if char in _SEPARATORS else AGAIN if char == before else None
            step: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, path) in best.items():
                if silent is not None and (state not in step or step[state][0] < score + silent):
                    step[state] = (score + silent, path)
                for kind, out, cost in options:
                    gram = state * ALPHABET + kind
                    value = score + cost + float(model[gram])
                    nxt = gram % ALPHABET**3
                    if nxt not in step or step[nxt][0] < value:
                        step[nxt] = (value, (out, path))
            best, before = step, char
        _, path = max(best.values(), key=lambda item: item[0])
        out = []
        while path is not None:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    def words(self, token: str) -> list[str]:
        """The plain words of a token as scored: lower case, without marks at its ends."""
        bare = token.strip(_EDGES).lower()
        plain = bare.rstrip("!")
        if plain.isalpha() and not _RUN.search(plain):
            return [plain]
        doubled = _RUN.search(bare) is not None
        if doubled or _SIGNS.search(bare):
            if bare not in self.known:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                decoded = [self.restore(bare)]
                if doubled:
                    # letters have one path once their repeats are gone
                    decoded.append(_RUNS.sub(r"\1", bare) if bare.isalpha() else self.restore(bare, habit=True))
                self.known[bare] = list(dict.fromkeys([plain, *(word.strip(_EDGES + "!") for word in decoded)]))
            return self.known[bare]
        return [plain] if plain else []

    def spaced(self, text: str) -> list[str]:
        """Words written as single characters with white space between them, one by one and as one."""
        out = []
        for found in _SPACED.finditer(text):
            parts = self.restore(" ".join(found.group().split())).split()
            out += [*parts, "".join(parts)]
        return list(dict.fromkeys(out))


def indicators(word: str) -> list[str]:
    """What a word is weighed by: itself and its beginnings."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class Weighing(NamedTuple):
    """A fitted classifier: the indicators, the weight of each, and the constant."""

    names: list[str]
    weights: np.ndarray
    shift: float

    def score(self, found: Iterable[int]) -> float:
        total = self.shift + float(self.weights[sorted(found)].sum())
        return 1.0 / (1.0 + math.exp(-min(max(total, -30.0), 30.0)))


class Spotter:
    """The indicators of a text, by number; remembers those of each word as written."""

    def __init__(self, model: np.ndarray, names: list[str]):
        self.restorer = Restorer(model)
        self.number = {name: i for i, name in enumerate(names)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _numbers(self, words: list[str]) -> tuple[int, ...]:
        number = self.number
        return tuple({number[x] for word in words for x in indicators(word) if x in number})

    def _token(self, token: str) -> tuple[int, ...]:
        found = self._numbers(self.restorer.words(token))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(token) <= 64:
            self.known[token] = found
        return found

    def found(self, text: str) -> set[int]:
        known, out = self.known, set()
        for token in set(text.split()):
            hit = known[token] if token in known else self._token(token)
            if hit:
                out.update(hit)
        out.update(self._numbers(self.restorer.spaced(text)))
        return out


def held_out() -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most ``SAMPLE`` labelled rows of each class, none held out."""
    rated = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .join(docs.filter("text IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    )
    order = F.xxhash64("doc_id")
    chosen = [rated.filter(F.col("toxic") == kind).orderBy(order, "doc_id").limit(SAMPLE) for kind in (0, 1)]
    # at most 2 * SAMPLE pairs of numbers
    few = F.broadcast(chosen[0].union(chosen[1]))
    return docs.filter("text IS NOT NULL").select("doc_id", "text").join(few, "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> Weighing:
    """Indicators with their weights in a logistic regression.

    Without labels of both classes there are no indicators and every score is the same.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = training_rows(docs, labels)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        counts, total = (Counter(), Counter()), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set()
                for token in set(text.split()):
                    for word in restorer.words(token):
                        found.update(indicators(word))
                for word in restorer.spaced(text):
                    found.update(indicators(word))
                counts[toxic].update(found)
                total[toxic] += 1
        names = list(counts[0].keys() | counts[1].keys()) + [None]
        columns = [[c[x] for x in names[:-1]] + [n] for c, n in zip(counts, total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["name", "clean", "toxic"]
        )

    summed = (
        rows.mapInArrow(tally, "name string, clean long, toxic long")
        .groupBy("name")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ).persist()
    whole = summed.filter("name IS NULL").first()
    clean, toxic = (whole.clean, whole.toxic) if whole else (0, 0)
    if not clean or not toxic:
        summed.unpersist()
        return Weighing([], np.zeros(0), math.log((toxic + 0.5) / (clean + 0.5)) if clean + toxic else -2.0)
    share = toxic / (toxic + clean)
    n = F.col("clean") + F.col("toxic")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    evidence = 2 * (part(F.col("toxic"), n * share) + part(F.col("clean"), n * (1 - share)))
    picked = (
        summed.filter("name IS NOT NULL")
        .withColumn("evidence", evidence)
        .filter((F.col("evidence") >= EVIDENCE) & (F.col("toxic") > n * share))
        .orderBy(F.desc("evidence"), "name")
        .limit(INDICATORS)
        .collect()
    )
    summed.unpersist()
    names = [row.name for row in picked]

    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spotter = Spotter(shared.value, names)
        for batch in batches:
            found = [sorted(spotter.found(text)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], ["found", "toxic"])

    # at most 2 * SAMPLE rows of INDICATORS numbers; each class counts as often as it occurs in the labels
    drawn = rows.mapInArrow(spot, "found array<int>, toxic int").toArrow()
    seen = labels.filter("toxic IS NOT NULL").filter(~held_out()).agg(F.avg((F.col("toxic") > 0).cast("int"))).first()[0]
    y = drawn.column("toxic").to_numpy().astype(np.float32)
    x = np.zeros((len(y), len(names)), np.float32)
    for row, found in enumerate(drawn.column("found").to_pylist()):
        x[row, found] = 1
    weight = np.where(y > 0, seen / max(share, 1e-9), (1 - seen) / max(1 - share, 1e-9)).astype(np.float32)
    return Weighing(names, *_logistic(x, y, weight))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Newton's method; ``PULL`` draws the weights to zero and a thousandth of it the constant."""
    design = np.hstack([x, np.ones((len(x), 1), np.float32)])
    pull = np.full(design.shape[1], PULL)
    pull[-1] = PULL / 1000
    beta = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta.astype(np.float32), -30, 30)))
        slope = design.T @ (weight * (y - p)) - pull * beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(bend.astype(float), slope.astype(float))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-4:
            break
    return beta[:-1], float(beta[-1])


def _scorer(docs: DataFrame, labels: DataFrame):
    """A function that makes, in a task, the function from texts to scores."""
    model = character_model(docs)
    fitted = fit(docs, labels, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        spotter = Spotter(shared.value, fitted.names)
        return lambda texts: [fitted.score(spotter.found(text or "")) for text in texts.to_pylist()]

    return make


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null and empty texts get the score of a text without indicators. Rows that repeat get
    equal scores; a null doc_id counts as not held out and has no label. Other columns are
    ignored, and an empty table gives an empty result.
    """
    make = _scorer(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = make()
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                columns = [part.column(0), part.column(1), pa.array(scores(part.column(2)), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score"])

    scored = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, all columns as they are."""
    make, at = _scorer(docs, labels), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = make()
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                yield part.filter(pa.array([score < 0.5 for score in scores(part.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
