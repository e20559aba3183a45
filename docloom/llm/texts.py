"""Words, shingles and hashes of whole Arrow batches of text, on numpy byte arrays.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``; these are single bytes in
UTF-8, so byte positions and code points give the same words. Batches are cut between
documents into chunks of about ``CHUNK_BYTES``, which bounds the memory of a task; a longer
document makes a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are worked on at once.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch: a task holds a batch twice, in the JVM and in Python.
BATCH_ROWS = 1_000

#: Bytes of a string that are hashed side by side with those of others.
LONG = 64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Multipliers that give each place of a window its own weight.
PLACES = np.random.Generator(np.random.PCG64(20240501)).integers(
    1, 1 << 63, size=64, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table, for operators that take Arrow batches.

    Python workers started later look for this package where the driver found it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Words(NamedTuple):
    """Words of a chunk: row of the chunk, first byte, end byte and hash of each."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


class Chunk(NamedTuple):
    """Rows ``first`` to ``last`` (exclusive) of a batch: their bytes and row boundaries."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(column: pa.Array) -> Iterator[Chunk]:
    """The texts of a column, null as empty, in chunks of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Chunk(
            first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        )
        first = last


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes that stay within a row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = bounds[(bounds > 0) & (bounds < len(inside))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cuts] = inside[cuts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number; behind the end come zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(np.uint64).reshape(-1)


#: Keeps the first bytes of eight, by their number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings ``data[start:end]``.

    Strings of up to ``LONG`` bytes are taken in eight bytes at a time, with a mixing step that no two
    values share in between, so that no structure of the text makes hashes agree; longer ones have a
    BLAKE2b digest.
    """
    size = end - start
    value = size.astype(np.uint64) * PLACES[63]
    eights, at = _eights(data), np.flatnonzero(size <= LONG)
    for first in range(0, LONG, 8):
        at = at[size[at] > first]
        if not len(at):
            break
        block = eights[start[at] + first] & _FIRST[np.minimum(size[at] - first, 8)]
        value[at] = mix((value[at] ^ block) * PLACES[61] + PLACES[60])
    for i in np.flatnonzero(size > LONG).tolist():
        value[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return mix(value)


def same_bytes(
    data: np.ndarray, start: np.ndarray, other: np.ndarray, other_start: np.ndarray, size: np.ndarray
) -> np.ndarray:
    """Whether the strings of ``size`` bytes at ``start`` of ``data`` and ``other_start`` of ``other`` agree."""
    same = np.ones(len(size), bool)
    left, at, eight = _eights(data), np.flatnonzero(size <= LONG), np.arange(8)
    for first in range(0, LONG, 8):
        at = at[size[at] > first]
        if not len(at):
            break
        place = other_start[at] + first
        if other is data:
            right = left[place]
        else:
            right = other[np.minimum(place[:, None] + eight, len(other) - 1)].view(np.uint64)[:, 0]
        gap = left[start[at] + first] ^ right
        same[at] &= gap & _FIRST[np.minimum(size[at] - first, 8)] == 0
    for i in np.flatnonzero(size > LONG).tolist():
        a, b = start[i], other_start[i]
        same[i] = np.array_equal(data[a : a + size[i]], other[b : b + size[i]])
    return same


def rows_of(start: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The row in which each position lies."""
    return np.searchsorted(bounds, start, "right") - 1


def words(chunk: Chunk, lower: bool = False) -> Words:
    """All words of a chunk in order; ``lower`` folds A-Z before hashing."""
    start, end = runs(~_SPACE[chunk.data], chunk.bounds)
    data = _LOWER[chunk.data] if lower else chunk.data
    return Words(rows_of(start, chunk.bounds), start, end, span_hashes(data, start, end))


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``size`` words within one row."""
    n = len(found.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(n, np.uint64)
    for place in range(size):
        value += found.hash[place : place + n] * PLACES[place]
    first = np.flatnonzero(found.row[:n] == found.row[size - 1 :])
    return first, mix(value[first])


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its word shingles, A-Z in lower case.

    A row of fewer words has one shingle, the whole sequence; a row without words has none.
    """
    for chunk in chunks(column):
        found = words(chunk, lower=True)
        rows = chunk.last - chunk.first
        counts = np.bincount(found.row, minlength=rows)
        ends = np.cumsum(counts)
        first, value = windows(found, size)
        place = np.searchsorted(first, ends - counts), np.searchsorted(first, ends)
        for row in range(rows):
            if counts[row] >= size:
                yield np.unique(value[place[0][row] : place[1][row]])
            elif counts[row]:
                part = found.hash[ends[row] - counts[row] : ends[row]]
                whole = (part * PLACES[: len(part)]).sum(dtype=np.uint64)
                length = counts[row : row + 1].astype(np.uint64) * PLACES[62]
                yield mix(length + whole)
            else:
                yield np.zeros(0, np.uint64)
