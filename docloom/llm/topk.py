"""Exact top-k by inner product: columnar branch and bound.

Vectors become integers, floor(256 * x). Rows are packed into blocks that hold one dimension
after the other, so that a block of dimensions lies in one piece. Each pair of a block of queries and
a block of candidates adds up scores dimension block by dimension block; after each, a
candidate stays only if its score plus the most that the remaining dimensions can
give (the product of the remaining lengths) reaches the query's k-th best lower bound. The
survivors move together, so later blocks work on fewer columns. Queries meet all candidates in
blocks; each task returns k rows per query, and the best of them are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.workspace import stage

SCALE = 256
EVERY = 50
TOP = 5
#: Rows of a block of queries and of candidates, and dimensions that are added at once.
QUERY_ROWS = 256
ROWS = 4096
DIMENSIONS = 16
#: Candidate blocks that one task meets per block of queries, keeping its bounds.
RUN = 8


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, width) of integer vectors; rows with nulls, non-finite or no components stay out."""
    good = "vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    scaled = f"transform(embedding, x -> double(floor(double(x) * {SCALE})))"
    return vectors.filter(good).selectExpr("vec_id", f"{scaled} AS v", "size(embedding) AS width")


def _packed(vectors: DataFrame, most: int) -> DataFrame:
    """Blocks of about ``most`` rows of one width: ids, and the components dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack(batches, most)

    return vectors.mapInArrow(run, "width int, n int, ids binary, data binary")


def _pack(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:

    def block(width: int, ids: list, parts: list) -> pa.RecordBatch:
        data = np.ascontiguousarray(np.concatenate(parts).T)
        columns = [[width], [len(ids)], [np.array(ids, np.int64).tobytes()], [data.tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["width", "n", "ids", "data"]
        )

    waiting: dict[int, tuple[list, list]] = {}
    for batch in batches:
        widths = batch.column(2).to_numpy()
        for width in np.unique(widths).tolist():
            own = batch.filter(pa.array(widths == width))
            ids, parts = waiting.setdefault(width, ([], []))
            values = own.column(1).flatten().to_numpy().reshape(-1, width)
            for first in range(0, len(values), most):
                ids.extend(own.column(0).slice(first, most).to_pylist())
                parts.append(values[first : first + most])
                if len(ids) >= most:
                    yield block(width, ids, parts)
                    ids, parts = waiting[width] = ([], [])
    for width, (ids, parts) in waiting.items():
        if ids:
            yield block(width, ids, parts)


def _remaining(data: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Length of every row over the dimensions from each cut on: (cuts, rows), rounded up."""
    squares = np.stack([(data[cut:] ** 2).sum(axis=0) for cut in cuts])
    return np.sqrt(squares) * (1 + 1e-9)


class Best:
    """The k best of each query of a block so far: scores falling, ties to smaller ids."""

    def __init__(self, rows: int, top: int):
        self.top = top
        self.score = np.full((rows, top), -np.inf)
        self.id = np.full((rows, top), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of the rows, in any order."""
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.top
        fresh_score = np.full_like(self.score, -np.inf)
        fresh_id = np.full_like(self.id, np.iinfo(np.int64).max)
        fresh_score[row[keep], place[keep]] = score[keep]
        fresh_id[row[keep], place[keep]] = ids[keep]
        score, ids = np.hstack([self.score, fresh_score]), np.hstack([self.id, fresh_id])
        order = np.lexsort((ids, -score), axis=1)[:, : self.top]
        self.score = np.take_along_axis(score, order, axis=1)
        self.id = np.take_along_axis(ids, order, axis=1)


def search_block(query: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Meet one block of candidates; ``query`` and ``data`` are (dimensions, rows)."""
    cuts = [*range(0, len(data), DIMENSIONS), len(data)]
    rest_query, rest = _remaining(query, cuts[1:]), _remaining(data, cuts[1:])
    own = query_ids[:, None] == ids[None, :]
    row, column, score = None, None, None
    for step, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if row is None:
            # the first block of dimensions is one product for all pairs
            partial = query[a:b].T @ data[a:b]
            slack = rest_query[step][:, None] * rest[step][None, :]
            floor = best.score[:, -1]
            if len(ids) > best.top and len(cuts) > 2:
                # the k-th lower bound of this block's other rows is one as well
                low = np.where(own, -np.inf, partial - slack)
                floor = np.maximum(floor, np.partition(low, -best.top, axis=1)[:, -best.top])
            row, column = np.nonzero((partial + slack >= floor[:, None]) & ~own)
            score = partial[row, column]
        else:
            score = score + np.einsum("ij,ij->j", query[a:b][:, row], data[a:b][:, column])
            bound = score + rest_query[step][row] * rest[step][column]
            stay = bound >= best.score[row, -1]
            row, column, score = row[stay], column[stay], score[stay]
    best.add(row, score, ids[column])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by query block and run; the first row of a group carries the queries."""
    names = ["query_id", "vec_id", "score"]

    def done(query_ids: np.ndarray, best: Best) -> pa.RecordBatch:
        row, place = np.nonzero(np.isfinite(best.score))
        columns = [query_ids[row], best.id[row, place], best.score[row, place].astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    at, query, query_ids, best = None, None, None, None
    for batch in batches:
        for i in range(batch.num_rows):
            q, run, width, n, ids, data, q_ids, q_data = (batch.column(k)[i].as_py() for k in range(8))
            if (q, run) != at:
                if at is not None:
                    yield done(query_ids, best)
                query_ids = np.frombuffer(q_ids, np.int64)
                query = np.frombuffer(q_data, np.float64).reshape(width, len(query_ids))
                at, best = (q, run), Best(len(query_ids), TOP)
            search_block(
                query, query_ids, np.frombuffer(data, np.float64).reshape(width, n), np.frombuffer(ids, np.int64), best
            )
    if at is not None:
        yield done(query_ids, best)


def top_k(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the best of all other rows for rows whose id ``every`` divides.

    Vectors that are null, empty or hold null or non-finite components take no part; a query meets
    vectors of its own number of components. Rows that repeat a vec_id are candidates of
    their own, but none of the query's own id. Ties go to the smaller vec_id. Scores are exact
    while they fit 53 bits. Fewer candidates give fewer rows, and none give none.
    """
    rows = stage(usable(vectors), "vectors")
    blocks = stage(_packed(rows, ROWS).withColumn("block", F.monotonically_increasing_id()), "blocks")
    asking = stage(rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]), "asking")
    parts = max(1, asking.count() // (8 * QUERY_ROWS))
    queries = stage(
        _packed(asking.repartition(parts), QUERY_ROWS)
        .select("width", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
        .withColumn("q", F.monotonically_increasing_id()),
        "queries",
    )
    total = max(1, blocks.count() // RUN)
    runs = blocks.withColumn("run", F.pmod(F.xxhash64("block"), F.lit(total)))
    # all vectors may have one width: the run spreads the pairs of blocks before they are made
    asked = queries.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(total - 1).cast("long"))))
    met = (
        asked.join(runs, ["width", "run"])
        .repartition("q", "run")
        .sortWithinPartitions("q", "run")
        .select("q", "run", "width", "n", "ids", "data", "q_ids", "q_data")
        .mapInArrow(_search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= TOP)
        .select("query_id", "rank", "vec_id", "score")
    )
