"""Joins and expansions that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold at least this share of all rows are joined by broadcast: at most so many keys.
HEAVY_KEYS = 10_000
#: Copies of one row that one task makes.
COPIES = 10_000


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join with ``right``, which has each key once and in ``weight`` about how many rows ``left`` has of it.

    Keys that hold a share of ``1 / HEAVY_KEYS`` of these rows are at most ``HEAVY_KEYS``: they are
    broadcast, and their rows stay where they are. All others are too few to fill a task. ``right`` is
    read three times and ``left`` twice.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * HEAVY_KEYS >= F.lit(total)
    few = right.filter(heavy)
    rest = left.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(right.filter(~heavy), keys, how)
    return left.join(F.broadcast(few), keys).select(*rest.columns).union(rest)


def repeated(rows: DataFrame, copies: str, number: str) -> DataFrame:
    """Each row ``copies`` times, with ``number`` counting from 0 instead; many copies are dealt out in pieces."""
    columns = [name for name in rows.columns if name != copies]
    once = rows.filter(F.col(copies) == 1).select(*columns, F.lit(0).cast("long").alias(number))
    pieces = rows.filter(F.col(copies) > 1).select(
        *columns,
        F.col(copies).cast("long").alias("_copies"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies).cast("long") - 1, F.lit(COPIES).cast("long"))).alias("_piece"),
    )
    dealt = pieces.repartition(F.xxhash64(*pieces.columns)).select(
        *columns, F.explode(F.expr(f"sequence(_piece, least(_piece + {COPIES}L, _copies) - 1)")).alias(number)
    )
    return once.union(dealt)
