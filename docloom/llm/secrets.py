"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

Candidates are runs of the characters that keys and digests are written in, with letters and
digits. From its characters a candidate's encoding is inferred, and its places in that alphabet are
tested for uniformity (chi-squared), for runs above and below the middle and for correlation of
neighbours. The smallest of the three p-values, times three, is the candidate's level: high
for random strings, near zero for words.

How often prose reaches a level by chance depends on the length. So every candidate has a decoy,
as many letters of the text beside it, that takes the same tests. For each band of lengths the
threshold is the lowest level at which a share ``FALSE_SHARE`` of the candidates above it, at most, would get there by
chance, over all documents. That chance is the share of decoys that get there, pooled with that of a
fixed sample of English prose, which counts as ``PROSE_WEIGHT`` decoys: in a small table the sample speaks, in a
large one the table. A string counts once, however often it occurs. Bands too short to tell
find nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.texts import chunks, runs
from docloom.workspace import stage

#: The base patterns by kind, in the order that breaks ties.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Alphabets of encodings, the narrowest first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: First length of each band; shorter strings are no candidates.
LENGTHS = (16, 20, 24, 32, 40, 64)
#: Steps of the level, and the share of decoys that a threshold may let through.
LEVELS = 50
FALSE_SHARE = 0.1
#: Decoys that the sample of prose counts as in each band.
PROSE_WEIGHT = 100
#: Levels, and for the first length of each band the share of prose that reaches them: 6 000 stretches of letters a
#: length from Python's own manual (``pydoc_data.topics``). Between two levels the share of the lower one holds.
PROSE_STEPS = (1, 2, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50)
PROSE_SHARES = (
    (0.8713, 0.8630, 0.6907, 0.5340, 0.5072, 0.3518, 0.3258, 0.3140, 0.3068, 0.1733, 0.1667, 0.1408),
    (0.8272, 0.7658, 0.5782, 0.4528, 0.3373, 0.3228, 0.2132, 0.1978, 0.1862, 0.1045, 0.0998, 0.0902),
    (0.7403, 0.5987, 0.5068, 0.3180, 0.2258, 0.2157, 0.1418, 0.1327, 0.0723, 0.0695, 0.0677, 0.0333),
    (0.4777, 0.4125, 0.2308, 0.1337, 0.0930, 0.0640, 0.0585, 0.0367, 0.0225, 0.0212, 0.0193, 0.0087),
    (0.2532, 0.1798, 0.0895, 0.0502, 0.0360, 0.0162, 0.0152, 0.0098, 0.0057, 0.0038, 0.0038, 0.0015),
    (0.0128, 0.0052, 0.0022, 0.0002, 0.0002, 0.0002, 0.0002, 0.0002, 0.0002, 0.0002, 0.0002, 0.0002),
)
#: What stands in a text for a secret taken out.
MASK = "[SECRET]"

# a value may follow "="; a name that "=" and a value follow is none
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LENGTHS[0]},}}={{0,2}}(?![A-Za-z0-9+/_=-])")
_RUN = np.zeros(256, bool)
_RUN[[ord(c) for c in ALPHABETS["base64"] + "_-="]] = True
_ASSIGN_HINT = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""


class Span(NamedTuple):
    """Code points ``start`` to ``end`` of a text; ``band`` and ``level`` for candidates."""

    kind: int
    start: int
    end: int
    band: int = -1
    level: int = -1


def _tail(z: float) -> float:
    """Chance that a standard normal is above ``z``."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(places: np.ndarray, size: int) -> float:
    """Three times the smallest p-value of the tests that ``places`` are random in ``size`` symbols."""
    n = len(places)
    counts = np.bincount(places, minlength=size)
    chi = float((counts.astype(float) ** 2).sum()) * size / n - n
    free = size - 1
    # Wilson and Hilferty's normal form, with the exact variance of few draws
    spread = 2 / (9 * free) * (n - 1) / n
    uniform = _tail(((chi / free) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    high = places >= size / 2
    above = int(high.sum())
    below = n - above
    if not above or not below:
        return 0.0
    changes = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * above * below / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = 2 * _tail(abs(changes - mean) / math.sqrt(max(variance, 1e-9)))
    centred = places - places.mean()
    power = float((centred**2).sum())
    serial = 0.0 if power == 0 else 2 * _tail(abs(float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n))
    return min(1.0, 3 * min(uniform, runs_p, serial))


def encoding(text: str) -> str | None:
    """The narrowest alphabet that a candidate is written in; None unless it has letters and digits."""
    bare = text.rstrip("=")
    if not any(c.isdigit() for c in bare) or not any(c.isalpha() for c in bare):
        return None
    return next((name for name, symbols in ALPHABETS.items() if set(bare) <= set(symbols)), None)


def _level(text: str, symbols: str) -> int:
    places = np.array([symbols.index(c) for c in text])
    return int(battery(places, len(symbols)) * LEVELS)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    found = [Span(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [Span(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [Span(2, m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(found, key=lambda x: (x.start, x.kind))


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


class Tested(NamedTuple):
    """A candidate and its decoy: hashes of both, the band, and both levels; no decoy has level -1."""

    key: int
    band: int
    level: int
    decoy_key: int
    decoy: int


def candidates(text: str) -> tuple[list[Span], list[Tested]]:
    """Candidates with their levels, and what counts for the thresholds."""
    found, tested = [], []
    for match in _CANDIDATE.finditer(text):
        bare = match.group().rstrip("=")
        name = encoding(bare)
        if name is None:
            continue
        band = int(np.searchsorted(LENGTHS, len(bare), "right")) - 1
        found.append(Span(3, match.start(), match.end(), band, _level(bare, ALPHABETS[name])))
        n = len(bare)
        beside = text[max(0, match.start() - 3 * n) : match.start()] + text[match.end() : match.end() + 3 * n]
        letters = re.sub("[^a-z]", "", re.sub(r"\S*[0-9]\S*", "", beside).lower())[:n]
        decoy = (_key(letters), _level(letters, _LETTERS)) if len(letters) == n else (0, -1)
        tested.append(Tested(_key(bare), band, found[-1].level, *decoy))
    return found, tested


def suspicious(column: pa.Array) -> np.ndarray:
    """Rows that any pattern or candidate can match; the others are not looked at one by one."""
    column = pc.fill_null(column, "")
    marked = pc.or_(pc.match_substring_regex(column, _ASSIGN_HINT), pc.match_substring(column, "AKIA"))
    marked = marked.to_numpy(zero_copy_only=False).copy()
    for chunk in chunks(column):
        start, end = runs(_RUN[chunk.data], chunk.bounds)
        long = start[end - start >= LENGTHS[0]]
        marked[chunk.first + np.searchsorted(chunk.bounds, long, "right") - 1] = True
    return marked


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[x.kind]}:{x.start}:{x.end}" for x in spans)


_SPAN = "struct<kind:int,start:int,end:int,band:int,level:int>"
_TESTED = "struct<key:bigint,band:int,level:int,decoy_key:bigint,decoy:int>"
_NONE = hashlib.sha256(b"").hexdigest()


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([(name, pa.int32()) for name in Span._fields])
    counted = pa.struct([(name, pa.int64() if "key" in name else pa.int32()) for name in Tested._fields])
    for batch in batches:
        for chunk_start in range(0, batch.num_rows, 1024):
            part = batch.slice(chunk_start, 1024)
            spans, other, digest, tested = [], [], [], []
            for text, marked in zip(part.column(1), suspicious(part.column(1))):
                if not marked:
                    spans.append([]), other.append([]), digest.append(_NONE), tested.append([])
                    continue
                text = text.as_py()
                base = base_spans(text)
                found, pairs = candidates(text)
                spans.append([x._asdict() for x in base])
                other.append(
                    [x._asdict() for x in found if all(x.end <= y.start or y.end <= x.start for y in base)]
                )
                digest.append(hashlib.sha256(_written(base).encode()).hexdigest())
                tested.append([x._asdict() for x in pairs])
            columns = [
                part.column(0),
                pa.array(spans, pa.list_(span)),
                pa.array(other, pa.list_(span)),
                pa.array(digest, pa.string()),
                pa.array(tested, pa.list_(counted)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "other", "base_sha256", "tested"])


def _levels(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(
        _find, f"doc_id long, base array<{_SPAN}>, other array<{_SPAN}>, base_sha256 string, tested array<{_TESTED}>"
    )


def thresholds(tested: DataFrame) -> list[int]:
    """Lowest level of each band of lengths at which candidates count as random; above all where none does.

    A candidate counts once with one of its decoys, and a decoy once, so that neither copies of a document
    nor a key that many documents hold move a threshold. From counts per band and level over all
    documents, a few hundred numbers.
    """
    decoy = F.when(F.col("decoy") >= 0, F.struct("decoy_key", "decoy"))
    pairs = (
        tested.select(F.explode("tested").alias("x")).select("x.*")
        .groupBy("key", "band", "level").agg(F.min(decoy).alias("beside"))
    )
    fakes = pairs.filter("beside IS NOT NULL").select("beside.decoy_key", "band", F.col("beside.decoy").alias("level"))
    counts = np.zeros((len(LENGTHS), LEVELS + 1, 2), np.int64)
    for k, rows in enumerate((pairs, fakes.distinct())):
        for row in rows.groupBy("band", "level").count().collect():
            counts[row.band, row.level, k] = row["count"]
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    return [_threshold(above[band, :, 0], above[band, :, 1], PROSE_SHARES[band]) for band in range(len(LENGTHS))]


def _threshold(candidates: np.ndarray, decoys: np.ndarray, prose: tuple[float, ...]) -> int:
    """Lowest level of a band, from the numbers of candidates and decoys at or above each level."""
    levels = np.arange(1, LEVELS + 1)
    share = np.array(prose)[np.searchsorted(PROSE_STEPS, levels, "right") - 1]
    chance = (PROSE_WEIGHT * share + decoys[1:]) / (PROSE_WEIGHT + decoys[0])
    # one candidate stands for a band that has none
    good = levels[chance * max(candidates[0], 1) <= FALSE_SHARE * np.maximum(candidates[1:], 1)]
    return int(good[0]) if len(good) else LEVELS + 1


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of ``docs``.

    Random strings are added where they overlap no base span. A null or empty text has no spans:
    counts are 0 and ``spans`` is empty. Rows that repeat get equal results, other columns are ignored, and
    an empty table gives an empty result.
    """
    found = stage(_levels(docs), "secrets")
    limits = F.lit(thresholds(found))
    added = F.filter("other", lambda x: x["level"] >= F.element_at(limits, x["band"] + 1))
    every = F.array_sort(
        F.transform(F.concat("base", added), lambda x: F.struct(x["start"], x["kind"], x["end"]))
    )
    names = F.lit(list(KINDS))
    written = F.transform(
        every, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    )

    def count(kind: int):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{KINDS[kind]}") for kind in range(3)),
        "base_sha256",
        F.concat_ws(",", written).alias("spans"),
    )


def masked(text: str, limits: list[int]) -> str:
    """A text with ``MASK`` for every secret; overlapping secrets get one."""
    spans = sorted((x.start, x.end) for x in base_spans(text))
    spans += [(x.start, x.end) for x in candidates(text)[0] if x.level >= limits[x.band]]
    parts, at, open_ = [], 0, 0
    for start, end in sorted(spans):
        if start >= open_:
            parts += [text[at:start], MASK]
        open_ = max(open_, end)
        at = open_
    return "".join([*parts, text[at:]])


def without_secrets(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with secrets masked; ``n_chars``, if there, is the new length."""
    limits = thresholds(stage(_levels(docs).select("tested"), "tested"))
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = suspicious(batch.column(at))
            if not marked.any():
                yield batch
                continue
            texts = batch.column(at).to_pylist()
            columns = list(batch.columns)
            changed = [masked(text, limits) if m else text for text, m in zip(texts, marked)]
            columns[at] = pa.array(changed, columns[at].type)
            if size is not None:
                old = columns[size].to_pylist()
                new = [len(c) if c != t else n for c, t, n in zip(changed, texts, old)]
                columns[size] = pa.array(new, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
