"""Pages of an ordered result, shallow and deep."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import workspace
from docloom.operators.snapshots import SnapshotTable
from docloom.workspace import stage

#: Up to this row a page is cut from a top-k; deeper pages use a ranged rank.
SHALLOW_ROWS = 100_000

#: Rows that a range of a directory is sized for.
RANGE_ROWS = 500_000
#: Ranges of a directory, unless those would be larger than ``RANGE_ROWS``: each costs a task, a folder and
#: what is sampled for its bounds.
MOST_RANGES = 1_000
#: Seconds for which rows that no directory names may belong to one under way.
VACUUM_AGE = 24 * 3600.0

_ROW_BITS = 33
_IN_RANGE = (1 << _ROW_BITS) - 1

DIRECTORY_SCHEMA = T.StructType(
    [
        T.StructField("range", T.IntegerType()),
        T.StructField("before", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("fields", T.StringType()),
        T.StructField("mark", T.StringType()),
    ]
)


def newest_first(modified: str, key: str) -> list[Column]:
    """Order of a page: modified descending, id as the tie-break."""
    return [F.col(modified).desc_nulls_last(), F.col(key).asc()]


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """1-based position of every row in a total order, without a single-task window.

    Rows are range partitioned and sorted; a row's position is its place inside its
    range plus the sizes of the ranges before it.  The sorted rows are staged first,
    so both passes see the same ranges.  Only the range sizes, one row per partition,
    go through one task.
    """
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_range", F.shiftright("_place", _ROW_BITS))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    in_range = F.col("_place").bitwiseAND(F.lit(_IN_RANGE))
    return placed.join(F.broadcast(starts), "_range").withColumn(
        name, F.col("_start") + in_range + 1
    ).drop("_range", "_place", "_start")


def page(df: DataFrame, order: Sequence[Column], start: int, end: int) -> DataFrame:
    """Rows ``start`` (inclusive, 0-based) to ``end`` (exclusive) of the ordered result."""
    if start < 0 or end < start:
        raise ValueError(f"bad page bounds {start}..{end}")
    if end <= SHALLOW_ROWS:
        return df.orderBy(*order).offset(start).limit(end - start)
    ranked = global_row_number(df, order, "_row_no")
    wanted = (F.col("_row_no") > start) & (F.col("_row_no") <= end)
    return ranked.where(wanted).orderBy("_row_no").drop("_row_no")


def page_by_modified(df: DataFrame, modified: str, key: str, start: int, end: int) -> DataFrame:
    """One page of the rows, newest first."""
    return page(df, newest_first(modified, key), start, end)


def page_by_rownum(
    df: DataFrame, modified: str, key: str, start: int, end: int, name: str = "row_no"
) -> DataFrame:
    """Rows numbered oldest first whose number lies in ``[start, end)``."""
    ranked = global_row_number(df, [F.col(modified).asc(), F.col(key).asc()], name)
    return ranked.where((F.col(name) >= start) & (F.col(name) < end))


class PageDirectory:
    """Ordered rows in ranges, with the number of rows before each range; deep pages read few ranges.

    Layout below ``path``: ``rows-<id>/_range=<n>/`` holds the rows of a build, each with its place in its
    range, and ``directory/v=<n>/`` says where the ranges begin. An instance stays with the build that it
    was opened with, so the pages of one reader fit together while others build anew. Rows that are equal
    in the whole order lie in one range, so the order should end in a key. A table that calls for more than
    ``MOST_RANGES`` ranges gets larger ones, of up to ``RANGE_ROWS`` rows.
    """

    def __init__(self, spark: SparkSession, path: str, range_rows: int = RANGE_ROWS):
        self.spark = spark
        self.path = path
        self.range_rows = range_rows
        self.snapshots = SnapshotTable(spark, f"{path}/directory", DIRECTORY_SCHEMA)
        self.number = self.snapshots.latest()

    @property
    def mark(self) -> str | None:
        """What the build was made from; None before the first."""
        row = self.snapshots.read(self.number).select("mark").first()
        return None if row is None else row.mark

    def build(self, df: DataFrame, order: Sequence[Column], mark: str = "", rows: int | None = None) -> PageDirectory:
        """Sort ``df`` once and publish where its ranges begin; ``rows`` spares a count if it is known."""
        rows = df.count() if rows is None else rows
        most = max(MOST_RANGES, -(-rows // RANGE_ROWS))
        ranges = min(max(1, -(-rows // self.range_rows)), most)
        folder = f"{self.path}/rows-{uuid.uuid4().hex}"
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_RANGE))
        (
            df.repartitionByRange(ranges, *order)
            .withColumn("_range", F.spark_partition_id())
            .sortWithinPartitions("_range", *order)
            .withColumn("_place", place)
            .write.partitionBy("_range")
            .parquet(folder)
        )
        made = (F.lit(folder).alias("folder"), F.lit(df.schema.json()).alias("fields"), F.lit(mark).alias("mark"))
        sizes = self._stored(folder, df.schema).groupBy("_range").agg(F.count("*").alias("rows"))
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select(
            F.col("_range").alias("range"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), "rows", *made
        )
        if rows == 0:
            none = F.lit(None).cast("int").alias("range"), F.lit(0).alias("before"), F.lit(0).alias("rows")
            starts = self.spark.range(1).select(*none, *made)
        self.number = self.snapshots.write(starts)
        return self

    def _stored(self, folder: str, fields: T.StructType) -> DataFrame:
        own = [T.StructField("_place", T.LongType()), T.StructField("_range", T.IntegerType())]
        return self.spark.read.schema(T.StructType([*fields.fields, *own])).parquet(folder)

    def page(self, start: int, end: int, name: str = "row_no") -> DataFrame:
        """Rows ``start`` (inclusive, 0-based) to ``end`` (exclusive) in order, with their 1-based number.

        Reads the ranges that hold them; within a range, the places in the footers spare the rest.
        """
        if start < 0 or end < start:
            raise ValueError(f"bad page bounds {start}..{end}")
        entries = self.snapshots.read(self.number)
        made = entries.select("folder", "fields").first()
        if made is None:
            raise ValueError(f"{self.path}: no directory has been built")
        rows = self._stored(made.folder, T.StructType.fromJson(json.loads(made.fields)))
        touching = (F.col("before") < end) & (F.col("before") + F.col("rows") > start)
        touched = entries.where(touching).orderBy("range").select("range", "before").collect()
        if not touched or start == end:
            return rows.limit(0).withColumn(name, F.col("_place")).drop("_place", "_range")
        first, last = touched[0], touched[-1]
        after, until = F.col("_place") >= start - first.before, F.col("_place") < end - last.before
        if first.range != last.range:
            after, until = (F.col("_range") > first.range) | after, (F.col("_range") < last.range) | until
        starts = workspace.local_frame(self.spark, [tuple(x) for x in touched], "_range int, _before long")
        return (
            rows.where(F.col("_range").between(first.range, last.range) & after & until)
            .join(F.broadcast(starts), "_range")
            .withColumn(name, F.col("_before") + F.col("_place") + 1)
            .drop("_range", "_place", "_before")
            .orderBy(name)
        )

    def vacuum(self, keep: int = 1, older_than: float = VACUUM_AGE) -> int:
        """Remove all but the newest ``keep`` builds, and rows older than ``older_than`` that none names."""
        self.snapshots.prune(keep)
        used = set()
        for number in self.snapshots.versions():
            used.add(self.snapshots.read(number).first().folder.rsplit("/", 1)[-1])
        dropped = 0
        for folder in workspace.child_names(self.spark, f"{self.path}/rows-*"):
            old = workspace.modified_at(self.spark, folder) <= time.time() - older_than
            if folder.rsplit("/", 1)[-1] not in used and old:
                workspace.delete_path(self.spark, folder)
                dropped += 1
        return dropped
