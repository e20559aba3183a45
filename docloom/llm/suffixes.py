"""Repeated passages by a logarithmic family of suffix arrays.

A passage is a string of ``LENGTH`` bytes that starts at two places. Of all suffixes only those at
anchors are kept: in every passage the string of ``GRAM`` bytes with the smallest hash, the
leftmost of equals. Two copies of a passage choose the same anchor at the same distance, so every
copy is seen, with one suffix for some 70 bytes of text. The passages of one anchor lie one behind
the other; together they are its context. An array holds the anchors' strings in the order of
their fingerprints, with the number of suffixes that begin with each.

Texts come in batches. One shuffle gives a batch its array, merge-scans it against the arrays of all
levels, and merges it with those of its size: two levels of one size make one of twice the size, so
there are as many levels as the number of batches has binary digits. A scan finds the anchors that a
batch shares with a level or with itself. The suffixes of these, and no others, are then compared:

* A context that occurs twice consists of repeated passages only, wherever it occurs.
* Where contexts of one anchor differ, their bytes are compared. The bytes behind the anchor and those
  before it, read backwards, are sorted; the common lengths of neighbours give ranks for
  every length, and two contexts share a passage if both ranks agree. Anchors with very many different
  contexts are compared by digests of whole passages instead, counted where they lie before they travel.

Fingerprints of contexts and passages are 128 bits of BLAKE2b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.joins import spread_join
from docloom.llm.texts import chunks
from docloom.workspace import Stage, delete_path, fresh_path, stage

#: Bytes of a passage.
LENGTH = 200
#: Bytes of an anchor's string, a power of two.
GRAM = 64
#: Places that an anchor can have in a passage.
PLACES = LENGTH - GRAM + 1
#: Batches that a whole table is added in.
BATCHES = 4
#: Places of a text that are worked on at once.
SLICE = 1 << 20
#: Different contexts of an anchor, and of a group of anchors, that one task compares by their bytes.
GROUP = 4096

_random = np.random.Generator(np.random.PCG64(11))
_BYTE = _random.integers(0, 1 << 32, size=256, dtype=np.uint32)
_FACTOR = np.uint32(0x9E3779B1)
_CONTEXT = ["c1", "c2"]
_ENTRY = "key long, c1 long, c2 long, row long, start int, stop int, at int, n long"


def anchors(data: np.ndarray) -> np.ndarray:
    """The anchor of the passage at every place of ``data``, for as many places as have one."""
    count = len(data) - LENGTH + 1
    value, width = _BYTE[data], 1
    while width < GRAM:
        value = value[:-width] * _FACTOR + value[width:]
        value ^= value >> np.uint32(15)
        width *= 2
    place = np.full(-(-len(value) // PLACES) * PLACES, np.iinfo(np.uint64).max, np.uint64)
    place[: len(value)] = value.astype(np.uint64) << np.uint64(32) | np.arange(len(value), dtype=np.uint64)
    blocks = place.reshape(-1, PLACES)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:count], ahead[PLACES - 1 : PLACES - 1 + count])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _fingerprints(data: bytes, start: np.ndarray, stop: np.ndarray, size: int) -> np.ndarray:
    """BLAKE2b digests of the strings, as rows of 64-bit numbers."""
    blake = hashlib.blake2b
    raw = b"".join(blake(data[a:b], digest_size=size).digest() for a, b in zip(start.tolist(), stop.tolist()))
    return np.frombuffer(raw, np.int64).reshape(-1, size // 8)


def _slice(data: np.ndarray, bounds: np.ndarray, first: int, size: int) -> tuple[np.ndarray, ...] | None:
    """Contexts that start at ``first`` or in the places behind it, ``size`` in all.

    Returns row, start and stop (from the row's beginning), place of the anchor, key, two numbers of the
    fingerprint, and how often the context occurs one over the other there.
    """
    part = data[first : first + size + LENGTH - 1]
    if len(part) < LENGTH:
        return None
    own = np.searchsorted(bounds, first, "right") - 1
    last = np.searchsorted(bounds, first + len(part), "left")
    low = np.maximum(bounds[own:last] - first, 0)
    count = np.maximum(np.minimum(bounds[own + 1 : last + 1] - first, len(part)) - LENGTH + 1 - low, 0)
    before = np.cumsum(count) - count
    place = np.repeat(low - before, count) + np.arange(int(count.sum()))
    if not len(place):
        return None
    row = np.repeat(np.arange(own, last), count)
    anchor = anchors(part)[place]
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(place)) - 1
    row, start, stop, anchor = row[begin], place[begin], place[end] + LENGTH, anchor[begin]
    raw = part.tobytes()
    context = _fingerprints(raw, start, stop, 16)
    key = _fingerprints(raw, anchor, anchor + GRAM, 8)[:, 0]
    # contexts that repeat one over the other, as in a run of one letter, are one entry
    order = np.lexsort((start, context[:, 1], context[:, 0], row))
    row, start, stop, anchor, key, context = (x[order] for x in (row, start, stop, anchor, key, context))
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (context[1:] != context[:-1]).any(axis=1) | (start[1:] > stop[:-1])
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(row)) - 1
    move = first - bounds[row[head]]
    return (
        row[head], start[head] + move, stop[tail] + move, (anchor - start)[head],
        key[head], context[head, 0], context[head, 1], tail - head + 1,
    )


def entries(texts: DataFrame) -> DataFrame:
    """One row for every context of ``texts`` (row, text), with its place in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1)):
                for first in range(0, len(chunk.data), SLICE):
                    found = _slice(chunk.data, chunk.bounds, first, SLICE)
                    if found is None:
                        continue
                    row, start, stop, at, key, c1, c2, n = found
                    columns = [pa.array(x) for x in (key, c1, c2, rows[chunk.first + row])]
                    columns += [pa.array(x.astype(np.int32)) for x in (start, stop, at)]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(n.astype(np.int64))],
                        ["key", "c1", "c2", "row", "start", "stop", "at", "n"],
                    )

    return texts.select("row", "text").mapInArrow(run, _ENTRY)


class Family:
    """Arrays of all texts added so far, in levels of doubling size."""

    def __init__(self, spark: SparkSession, keep: Callable[[DataFrame, str], DataFrame] = stage) -> None:
        self.spark = spark
        self.keep = keep
        self.levels: list[tuple[int, str]] = []
        self.entries: list[DataFrame] = []
        self.matches: list[DataFrame] = []

    def _level(self, path: str, merged: str) -> DataFrame:
        rows = self.spark.read.parquet(path)
        return rows.select("key", F.col("n").alias("places"), F.lit(0).cast("long").alias("own"), F.expr(merged).alias("n"))

    def add(self, texts: DataFrame) -> DataFrame:
        """Take in a batch (row, text); returns the anchors (key, weight) that it shares, with their number.

        Rows must differ from those of all other batches.
        """
        own = self.keep(entries(texts), "entries")
        self.entries.append(own)
        both = own.select("key", F.col("n").alias("places"), F.col("n").alias("own"), "n")
        size, joined = 1, []
        while self.levels and self.levels[-1][0] == size:
            size, path = 2 * size, self.levels.pop()[1]
            joined.append(path)
            both = both.union(self._level(path, "n"))
        for _, path in self.levels:
            both = both.union(self._level(path, "bigint(0)"))
        path = fresh_path(self.spark, "level")
        # what only larger levels hold stays there
        scan = both.groupBy("key").agg(*(F.sum(name).alias(name) for name in ("places", "own", "n"))).filter("n > 0")
        scan.sortWithinPartitions("key").write.parquet(path)
        self.levels.append((size, path))
        shared_ones = self.spark.read.parquet(path).filter("own > 0 AND places > 1")
        self.matches.append(stage(shared_ones.select("key", F.col("places").alias("weight")), "matches"))
        for old in joined:
            delete_path(self.spark, old)
        return self.matches[-1]

    def found(self) -> DataFrame:
        """The entries of all anchors that a scan found."""
        keys = _union(self.matches).groupBy("key").agg(F.max("weight").alias("weight"))
        return spread_join(_union(self.entries), stage(keys, "keys"), ["key"], "weight").drop("weight")


def _union(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.union(more)
    return rows


def contexts_of(found: DataFrame) -> DataFrame:
    """(key, c1, c2, n) of every context, with one of its places."""
    place = [F.first(name).alias(name) for name in ("row", "start", "stop", "at")]
    return found.groupBy("key", *_CONTEXT).agg(F.sum("n").alias("n"), *place)


def shared(group: np.ndarray, at: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of a shared passage in every context; -1 and -1 without one.

    Contexts are compared within their ``group``; ``at`` is the place of the anchor.
    """
    n, size = len(texts), np.array([len(x) for x in texts])
    behind, before = np.zeros((n, LENGTH), np.uint8), np.zeros((n, PLACES - 1), np.uint8)
    for i, (text, place) in enumerate(zip(texts, at.tolist())):
        whole = np.frombuffer(text, np.uint8)
        behind[i, : size[i] - place] = whole[place : place + LENGTH]
        before[i, :place] = whole[:place][::-1]
    name = group.astype(">i8").view(np.uint8).reshape(n, 8)

    def ranked(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted order, and how many bytes each has in common with the one before it."""
        order = np.argsort(np.hstack([name, side]).view(f"S{8 + side.shape[1]}").reshape(-1), kind="stable")
        equal = np.hstack([side[order][1:] == side[order][:-1], np.zeros((n - 1, 1), bool)])
        common = np.where(group[order][1:] == group[order][:-1], equal.argmin(axis=1), -1)
        return order, np.append(-1, common)

    order_behind, common_behind = ranked(behind)
    order_before, common_before = ranked(before)
    first, last = np.full(n, -1), np.full(n, -1)
    rank_behind, rank_before = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for distance in range(PLACES):
        some = np.flatnonzero((at >= distance) & (at - distance + LENGTH <= size))
        if len(some) < 2:
            continue
        rank_behind[order_behind] = np.cumsum(common_behind < LENGTH - distance)
        rank_before[order_before] = np.cumsum(common_before < distance)
        code = rank_behind[some] * (n + 1) + rank_before[some]
        _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
        hit = some[count[inverse] > 1]
        # distances grow, so places fall
        last[hit] = np.where(last[hit] < 0, at[hit] - distance, last[hit])
        first[hit] = at[hit] - distance
    return first, last


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, c1, c2, at, bytes, n) sorted by key, worked on in groups of whole keys."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        key, c1, c2, at = (np.array([x[k] for x in rows], np.int64) for k in range(4))
        first, last = shared(key, at, [x[4] for x in rows])
        # a context that occurs twice is repeated as a whole, and known
        hit = (first >= 0) & (np.array([x[5] for x in rows]) == 1)
        columns = [c1[hit], c2[hit], first[hit].astype(np.int32), (last[hit] + LENGTH).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["c1", "c2", "low", "high"])

    waiting: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if len(waiting) >= GROUP and row[0] != waiting[-1][0]:
                yield done(waiting)
                waiting = []
            waiting.append(row)
    if waiting:
        yield done(waiting)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every passage of the contexts."""
    for batch in batches:
        for one in range(batch.num_rows):
            text = batch.column(4)[one].as_py()
            start = np.arange(len(text) - LENGTH + 1)
            found = _fingerprints(text, start, start + LENGTH, 16)
            same = [np.full(len(start), batch.column(k)[one].as_py(), np.int64) for k in (1, 2, 5)]
            columns = [pa.array(x) for x in (found[:, 0], found[:, 1], *same)] + [pa.array(start.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["p1", "p2", "c1", "c2", "n", "place"])


def compared(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(c1, c2, low, high): the repeated part of contexts that share an anchor with different ones only."""
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("weight"), F.min("n").alias("least"))
    mixed = stage(counts.filter("weight > 1 AND least = 1").select("key", "weight"), "mixed")
    wanted = spread_join(found, mixed, ["key"], "weight")
    places = wanted.groupBy("row").agg(
        F.collect_list(F.struct("key", *_CONTEXT, "n", "weight", "at", "start", "stop")).alias("places")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "c1", "c2", "at", "bytes", "n", "weight"]
        for batch in batches:
            for one in range(batch.num_rows):
                text, here = batch.column(0)[one].as_py().encode(), batch.column(1)[one].values
                column = {name: here.field(name) for name in ("key", "c1", "c2", "at", "n", "start", "stop", "weight")}
                spans = zip(column["start"].to_pylist(), column["stop"].to_pylist())
                column["bytes"] = pa.array([text[a:b] for a, b in spans], pa.binary())
                yield pa.RecordBatch.from_arrays([column[name] for name in names], names)

    contexts = stage(
        texts.join(places, "row").select("text", "places").mapInArrow(
            cut, "key long, c1 long, c2 long, at int, bytes binary, n long, weight long"
        ),
        "contexts",
    )
    columns = ["key", *_CONTEXT, "at", "bytes", "n"]
    near = (
        contexts.filter(F.col("weight") <= GROUP)
        .select(*columns)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_compared, "c1 long, c2 long, low int, high int")
    )
    many = contexts.filter(F.col("weight") > GROUP).select(*columns)
    if many.isEmpty():
        return near
    passages = stage(many.mapInArrow(_digested, "p1 long, p2 long, c1 long, c2 long, n long, place int"), "passages")
    twice = passages.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("weight")).filter("weight > 1")
    hits = spread_join(passages, stage(twice, "twice"), ["p1", "p2"], "weight")
    return near.union(
        hits.filter("n = 1").groupBy(*_CONTEXT).agg(F.min("place").alias("low"), (F.max("place") + LENGTH).cast("int").alias("high"))
    )


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(row, spans) of every text of (row, text, batch) of which something repeats; spans may overlap."""
    with Stage(texts.sparkSession) as scratch:
        family = Family(texts.sparkSession, scratch)
        for number in range(BATCHES):
            family.add(texts.filter(F.col("batch") == number))
        found = stage(family.found(), "found")
    contexts = stage(contexts_of(found), "contexts")
    whole = contexts.filter("n > 1").select(*_CONTEXT, F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"), "n")
    parts = compared(texts, contexts).withColumn("n", F.lit(1).cast("long"))
    cuts = stage(whole.union(parts), "cuts")
    return (
        spread_join(found.select("row", "start", "stop", *_CONTEXT), cuts, _CONTEXT, "n")
        .select(
            "row",
            (F.col("start") + F.col("low")).alias("start"),
            F.coalesce(F.col("start") + F.col("high"), F.col("stop")).alias("stop"),
        )
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    )


_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, spans) with the maximal runs of repeated bytes and what is left without them."""
    for batch in batches:
        rows, starts, stops = [], [], []
        for one in range(batch.num_rows):
            text, here = batch.column(1)[one].as_py().encode(), batch.column(2)[one].values
            start = stop = np.zeros(0, np.int32)
            if here is not None:
                start, stop = here.field("start").to_numpy(), here.field("stop").to_numpy()
                reach = np.maximum.accumulate(stop)
                head = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
                start, stop = start[head], reach[np.append(head[1:], len(stop)) - 1]
            kept = hashlib.sha256()
            for a, b in zip([0, *stop.tolist()], [*start.tolist(), len(text)]):
                kept.update(text[a:b])
            rows.append((len(text), int((stop - start).sum()), len(start), kept.hexdigest()))
            starts.append(start)
            stops.append(stop)
        if rows:
            runs = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in (starts, stops)], ["start", "stop"])
            spans = pa.ListArray.from_arrays(np.cumsum([0, *map(len, starts)]).astype(np.int32), runs)
            columns = [batch.column(0), *(pa.array(x) for x in zip(*rows)), spans]
            yield pa.RecordBatch.from_arrays(columns, _NAMES)


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans for every row of ``docs``.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the
    same text or another. ``spans`` are the maximal runs of removed bytes. Null texts are empty, and texts of
    fewer bytes lose nothing. Rows that repeat count as other places, whatever their doc_id, which
    may be null. A text of any length is worked on in slices. Other columns are ignored; an empty
    table gives an empty result.
    """
    spark, size = docs.sparkSession, F.octet_length("text")
    path = fresh_path(spark, "texts")
    numbered = docs.filter(size >= LENGTH).select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(BATCHES)).cast("int"))
    numbered.write.partitionBy("batch").parquet(path)
    texts = spark.read.schema(numbered.schema).parquet(path)
    spans = repeated_spans(texts.select("row", "text", "batch"))
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"
    long_ones = texts.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(_kept, columns)
    none = F.lit(0).cast("long")
    short = docs.filter(F.coalesce(size, F.lit(0)) < LENGTH).select(
        F.col("doc_id").cast("long"),
        F.coalesce(size, F.lit(0)).cast("long").alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
        F.array().cast("array<struct<start:int,stop:int>>").alias("spans"),
    )
    return long_ones.union(short)
