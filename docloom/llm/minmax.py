"""Near-duplicates by min-max hashing.

Each of ``PERMUTATIONS`` hash functions is evaluated once per shingle and both its smallest
and its largest value are kept, so 120 evaluations give a signature of 240 values. Either
value of two sets agrees with a chance equal to their similarity. A band joins five values of
five different functions; with 48 bands a pair at similarity 0.75 is missed with a chance of
2e-6. Every candidate is confirmed on its full shingle sets.

Steps: one pass gives each document its signature and the fingerprint of its set; documents
of equal sets form a class, of which the smallest id goes on. In each bucket of a band the
smallest id is the hub, and every other member is compared with it. Hubs with many members
are cut into salted groups. After these links are merged, most buckets hold one component. In
the others all members of different components are compared, in blocks of ``BLOCK`` members:
a task counts the shared shingles of two blocks by a matrix product and returns links only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.components import components
from docloom.llm.texts import PLACES, mix, shingle_sets
from docloom.workspace import broadcast_if_small, stage

PERMUTATIONS = 120
BANDS = 48
#: Words of a shingle, and the least similarity in hundredths.
SHINGLE = 5
SIMILAR = 75
#: Members that are compared with one copy of a hub, and members of a block.
GROUP = 256
BLOCK = 512
#: Shingles that a matrix product takes at once.
COLUMNS = 4096

_random = np.random.Generator(np.random.PCG64(7))
_FACTOR = _random.integers(1, 1 << 63, size=PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, size=PERMUTATIONS, dtype=np.uint64)
_BAND = np.arange(BANDS)
#: Bands take three minima and two maxima, or two and three, in turn; no function occurs twice in one.
_LOW, _HIGH, _next = [], [], [0, PERMUTATIONS // 2]
for _band in range(BANDS):
    _n = 3 - _band % 2
    _LOW.append([(_next[0] + i) % PERMUTATIONS for i in range(_n)])
    _HIGH.append([(_next[1] + i) % PERMUTATIONS for i in range(5 - _n)])
    _next = [_next[0] + _n, _next[1] + 5 - _n]


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima of every function over non-empty sets: two arrays (sets, functions)."""
    offsets = np.cumsum([0] + [len(x) for x in sets[:-1]])
    values = np.concatenate(sets)
    low = np.empty((PERMUTATIONS, len(sets)), np.uint64)
    high = np.empty_like(low)
    hashed = np.empty_like(values)
    for k in range(PERMUTATIONS):
        np.multiply(values, _FACTOR[k], out=hashed)
        np.add(hashed, _SHIFT[k], out=hashed)
        low[k] = np.minimum.reduceat(hashed, offsets)
        high[k] = np.maximum.reduceat(hashed, offsets)
    return low.T, high.T


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set and band."""
    keys = np.empty((len(low), BANDS), np.uint64)
    for band in range(BANDS):
        columns = [*(low[:, k] for k in _LOW[band]), *(high[:, k] for k in _HIGH[band])]
        value = np.full(len(low), band, np.uint64) * PLACES[10]
        for place, column in enumerate(columns, 11):
            value += column * PLACES[place]
        keys[:, band] = mix(value)
    return keys


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(ids: pa.Array, group: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, x in enumerate(group) if len(x)]
        n = len(group)
        sizes = np.array([len(x) for x in group], np.int64)
        k1, k2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        keys = np.zeros((0, BANDS), np.uint64)
        if full:
            sets = [group[i] for i in full]
            keys = band_keys(*signatures(sets))
            offsets = np.cumsum([0] + [len(x) for x in sets[:-1]])
            values = np.concatenate(sets)
            k1[full] = np.add.reduceat(mix(values ^ PLACES[20]), offsets)
            k2[full] = np.add.reduceat(mix(values ^ PLACES[21]), offsets)
        lengths = np.where(sizes > 0, BANDS, 0)
        bands = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()),
            pa.array(keys.reshape(-1).view(np.int64)),
        )
        columns = [ids, pa.array(sizes), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), bands]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "k1", "k2", "bands"])

    for batch in batches:
        ids, group, size, first = batch.column(0), [], 0, 0
        for item in shingle_sets(batch.column(1), SHINGLE):
            group.append(item)
            size += len(item)
            if size >= 200_000:
                yield out(ids.slice(first, len(group)), group)
                first, group, size = first + len(group), [], 0
        if group:
            yield out(ids.slice(first, len(group)), group)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the fingerprint (k1, k2) of the shingle set, and its band keys."""
    return docs.select("doc_id", "text").mapInArrow(
        _sketch, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hub, salt and kind; a hub's own texts come before its members."""
    group, hubs = None, []
    for batch in batches:
        hub, salt, member, node = (batch.column(i).to_pylist() for i in range(4))
        a, b = [], []
        for i, found in enumerate(shingle_sets(batch.column(4), SHINGLE)):
            if (hub[i], salt[i]) != group:
                group, hubs = (hub[i], salt[i]), []
            if not member[i]:
                hubs.append(found)
                continue
            for own in hubs:
                if 100 * min(len(own), len(found)) < SIMILAR * max(len(own), len(found)):
                    continue
                both = len(np.intersect1d(own, found, assume_unique=True))
                if 100 * both >= SIMILAR * (len(own) + len(found) - both):
                    a.append(hub[i])
                    b.append(node[i])
                    break
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def confirmed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose texts (node, text) are similar on their full sets.

    A member's text travels to its hub ``a``; a hub of many members is copied once for every
    ``GROUP`` of them, so no task gets more members of one hub than that.
    """
    salted = pairs.join(
        pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups")), "a"
    ).select(
        F.col("a").alias("hub"),
        F.pmod(F.xxhash64("b"), "groups").cast("int").alias("salt"),
        F.lit(True).alias("member"),
        F.col("b").alias("node"),
    )
    hubs = salted.select(
        "hub", "salt", F.lit(False).alias("member"), F.col("hub").alias("node")
    ).distinct()
    return (
        salted.union(hubs)
        .join(texts.hint("merge"), "node")
        .select("hub", "salt", "member", "node", "text")
        .repartition("hub", "salt")
        .sortWithinPartitions("hub", "salt", "member")
        .mapInArrow(_compare, "a long, b long")
    )


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # a shingle of one set only is shared by none
    place = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between members of different components in each pair of blocks; rows sorted by these."""

    def links(group: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        ids, parts = np.array([x[0] for x in group]), np.array([x[1] for x in group])
        a = b = np.zeros(0, np.int64)
        if len(group) and (parts != parts[0]).any():
            size = np.array([len(x[2]) for x in group])
            both = shared_counts([x[2] for x in group])
            good = 100 * both >= SIMILAR * (size[:, None] + size[None, :] - both)
            a, b = np.nonzero(good & (parts[:, None] < parts[None, :]))
            a, b = ids[a], ids[b]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    at, group = None, []
    for batch in batches:
        key, i, j, node, part = (batch.column(k).to_pylist() for k in range(5))
        for k, found in enumerate(shingle_sets(batch.column(5), SHINGLE)):
            if (key[k], i[k], j[k]) != at:
                yield links(group)
                at, group = (key[k], i[k], j[k]), []
            group.append((node[k], part[k], found))
    yield links(group)


def across(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between ``members`` (key, id, c) of one bucket and different components c."""
    counted = members.groupBy("key").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    return (
        members.join(counted.filter("low != high").select("key", "blocks"), "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            F.col("id").alias("node"),
            "c",
        )
        .join(texts.hint("merge"), "node")
        .select("key", "i", "j", "node", "c", "text")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(_across, "a long, b long")
        .distinct()
    )


def _fits(small: str, large: str) -> str:
    """The sizes of two sets allow the wanted similarity."""
    return f"100 * least({small}, {large}) >= {SIMILAR} * greatest({small}, {large})"


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Texts that are null, empty or without words have no shingles and link with nothing. Rows
    with a null doc_id link with nothing either: component_id is null and they are kept. Rows
    that repeat a doc_id are one node, and the links of any of their texts count. Other
    columns are ignored; an empty table gives an empty result.
    """
    sketch = stage(sketches(docs), "sketches")
    key = ["k1", "k2", "n_shingles"]
    usable = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(
        usable.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")),
        "classes",
    )
    # one shuffle serves both the aggregate and the join
    bands = classes.select(
        F.explode("bands").alias("key"), F.col("rep").alias("id"), F.col("n_shingles").alias("n")
    ).repartition("key")
    hubs = (
        bands.groupBy("key")
        .agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("members"))
        .filter("members > 1")
    )
    members = stage(
        bands.join(hubs.hint("merge"), "key").select("key", "id", "n", "hub", "members"), "members"
    )
    star = stage(
        members.filter("id != hub.id")
        .filter(_fits("n", "hub.n"))
        .select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
        .distinct(),
        "star",
    )
    nodes = members.select(F.col("id").alias("node")).distinct()
    texts = stage(
        docs.filter("doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("node"), "text")
        .join(nodes.hint("merge"), "node", "left_semi"),
        "texts",
    )
    # ids that repeat link the classes of their texts
    same = usable.groupBy(*key, "doc_id").count().join(classes.select(*key, "rep"), key).filter("doc_id != rep")
    same = same.join(usable.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "doc_id")
    known = stage(
        confirmed(texts, star).union(same.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))),
        "known",
    )
    found = components(known)
    # a bucket of two was compared in full
    part = members.filter("members > 2").join(
        found.withColumnRenamed("node", "id"), "id", "left"
    ).select("key", "id", F.coalesce("component", "id").alias("c"))
    more = stage(across(texts, part), "more")
    if not more.isEmpty():
        found = components(known.union(more))
    result = classes.select(*key, "rep").join(
        found.withColumnRenamed("node", "rep"), "rep", "left"
    ).select(*key, F.coalesce("component", "rep").alias("component"))
    joined = sketch.join(result, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of every group.

    Of rows that share the kept id one stays, that of the smallest text. Rows of a null id link with
    nothing; of those with equal shingle sets one stays, and all without shingles do.
    """
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    rest = docs.filter("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = stage(rest.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    if not again.isEmpty():
        ids = broadcast_if_small(again)
        one = rest.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min_by(F.struct(*docs.columns), F.struct("text")).alias("row")
        )
        rest = rest.join(ids, "doc_id", "left_anti").select(*docs.columns).union(one.select("row.*"))
    unnamed = docs.filter("doc_id IS NULL")
    if unnamed.isEmpty():
        return rest
    unnamed = stage(unnamed.select(F.monotonically_increasing_id().alias("_row"), F.struct(*docs.columns).alias("_doc")), "unnamed")
    sketch = sketches(unnamed.select(F.col("_row").alias("doc_id"), "_doc.text")).filter("n_shingles > 0")
    marked = stage(sketch.select("doc_id", "k1", "k2", "n_shingles"), "marked")
    first = marked.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    copies = marked.join(first, "doc_id", "left_anti").select(F.col("doc_id").alias("_row"))
    return rest.union(unnamed.join(copies, "_row", "left_anti").select("_doc.*"))
