"""Index queries over Spark tables, and the predicates a run adds to them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.keys import find_column
from docloom.model import IndexDef, Tenant
from docloom.workspace import broadcast_if_small, local_frame

#: Up to this many ids travel as an IN list that reaches the scan.
IN_LIST_LIMIT = 1_000
#: Cells that more ids are counted in, and intervals that reach the scan.
ID_CELLS = 10_000
ID_INTERVALS = 200


def query_rows(spark: SparkSession, query: str, args: Mapping | None = None) -> DataFrame:
    """Rows of any SELECT, wrapped so that further predicates can be added to it."""
    text = query.strip().rstrip(";")
    return spark.sql(f"SELECT * FROM (\n{text}\n) q", args=dict(args or {}))


def since_literal(dtype: T.DataType, epoch: int) -> Column:
    """An epoch-second bound as a literal of the column's own type."""
    return since_value(dtype, F.lit(epoch))


def since_value(dtype: T.DataType, epoch: Column) -> Column:
    """Epoch seconds in the type of a modified column."""
    if isinstance(dtype, T.NumericType):
        return epoch.cast(dtype)
    return F.timestamp_seconds(epoch).cast(dtype)


def modified_since(df: DataFrame, column: str, epoch: int) -> DataFrame:
    """Rows whose modified value is at or after the bound; the comparison stays on the
    bare column, so it is pushed into the scan."""
    name = find_column(df, column)
    if name is None:
        raise ValueError(f"modified column {column!r} is not in the query result")
    return df.where(F.col(name) >= since_literal(df.schema[name].dataType, epoch))


def since_marks(df: DataFrame, column: str, marks: Mapping[str, int]) -> DataFrame:
    """Rows of several tenants at or after each tenant's own mark.

    Mark 0 means "from the beginning", rows without a modified value included.  The
    oldest other mark is a literal bound that reaches the scan; the join then applies
    each tenant's own.  A query without the modified column is read whole.
    """
    name = find_column(df, column)
    if name is None:
        return df
    fresh = sorted(tenant for tenant, mark in marks.items() if mark == 0)
    others = [mark for mark in marks.values() if mark != 0]
    if not others:
        return df
    if len(fresh) <= IN_LIST_LIMIT:
        bound = F.col(name) >= since_literal(df.schema[name].dataType, min(others))
        df = df.where((F.col("tenant").isin(fresh) | bound) if fresh else bound)
    own = local_frame(df.sparkSession, list(marks.items()), "tenant string, _mark bigint")
    # the mark in the column's own type: a date is due all day
    due = (F.col("_mark") == 0) | (F.col(name) >= since_value(df.schema[name].dataType, F.col("_mark")))
    return df.join(broadcast_if_small(own, len(marks)), "tenant").where(due).drop("_mark")


def with_ids(df: DataFrame, column: str, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Rows whose id is in a list or in the single column of a DataFrame.

    A short list becomes an IN predicate that the scan can use.  Anything longer is a semi
    join behind a few intervals that cover the ids, which the scan can use as well.  Ids kept
    as text are compared as numbers, and text that is no number matches none.
    """
    name = find_column(df, column)
    if name is None:
        raise ValueError(f"id column {column!r} is not in the query result")
    if not isinstance(ids, DataFrame):
        values = sorted({int(value) for value in ids})
        if len(values) <= IN_LIST_LIMIT:
            return df.where(id_value(df, name).isin(values))
        ids = local_frame(df.sparkSession, [(value,) for value in values], "id bigint")
    keys = ids.toDF("_id").where("_id IS NOT NULL").distinct()
    bounded, rows = id_bound(df, name, keys)
    return bounded.join(broadcast_if_small(keys, rows), id_value(df, name) == F.col("_id"), "left_semi")


def id_value(df: DataFrame, name: str) -> Column:
    """The id column as it is if it holds numbers, which lets a predicate reach the scan."""
    return F.col(name).try_cast("bigint") if isinstance(df.schema[name].dataType, T.StringType) else F.col(name)


def id_bound(df: DataFrame, name: str, keys: DataFrame) -> tuple[DataFrame, int]:
    """Rows within intervals that cover every ``_id`` of ``keys``, and the number of keys.

    The ids are counted in up to ``ID_CELLS`` cells of equal width, whatever their number; the cells are joined
    across all but the widest gaps, which leaves at most ``ID_INTERVALS`` intervals for the scan to skip by.
    """
    bound = keys.agg(F.min("_id").alias("low"), F.max("_id").alias("high"), F.count("_id").alias("n")).first()
    if bound.n == 0:
        return df.where(F.lit(False)), 0
    low, span = float(bound.low), float(bound.high) - float(bound.low) + 1.0
    cell = F.floor((F.col("_id").cast("double") - F.lit(low)) / F.lit(span) * F.lit(ID_CELLS))
    cells = keys.groupBy(cell.alias("cell")).agg(F.min("_id").alias("low"), F.max("_id").alias("high")).collect()
    value = id_value(df, name)
    inside = [value.between(first, last) for first, last in intervals([(c.low, c.high) for c in cells])]
    return df.where(reduce(lambda a, b: a | b, inside)), bound.n


def intervals(cells: Sequence[tuple[int, int]], most: int | None = None) -> list[tuple[int, int]]:
    """At most ``most`` intervals over the given ones, apart at the widest gaps; neighbours are joined."""
    ordered = sorted(cells)
    gaps = sorted(
        (right[0] - left[1], at) for at, (left, right) in enumerate(zip(ordered, ordered[1:]), 1) if right[0] - left[1] > 1
    )
    cuts = sorted(at for _, at in gaps[-((ID_INTERVALS if most is None else most) - 1) :])
    edges = [0, *cuts, len(ordered)]
    return [(ordered[a][0], ordered[b - 1][1]) for a, b in zip(edges, edges[1:])]


def filter_tenants(df: DataFrame, tenants: Sequence[Tenant] | DataFrame, column: str = "tenant") -> DataFrame:
    """Keep the rows of the given tenants; a short list prunes partitions and files.

    A DataFrame of tenants (tenant, enabled) stands for those that are enabled.
    """
    if isinstance(tenants, DataFrame):
        keys = tenants.where("enabled").select(F.col("tenant").alias("_tenant")).distinct()
        return df.join(broadcast_if_small(keys), F.col(column) == F.col("_tenant"), "left_semi")
    ids = sorted({tenant.id for tenant in tenants})
    if len(ids) <= IN_LIST_LIMIT:
        return df.where(F.col(column).isin(ids))
    keys = local_frame(df.sparkSession, [(i,) for i in ids], "_tenant string")
    return df.join(broadcast_if_small(keys, len(ids)), F.col(column) == F.col("_tenant"), "left_semi")


class SharedTables:
    """Tables that hold every tenant, told apart by a column of the query result.

    One scan serves all tenants.
    """

    def __init__(self, spark: SparkSession, tenant_column: str = "tenant", args: Mapping | None = None):
        self.spark = spark
        self.tenant_column = tenant_column
        self.args = dict(args or {})

    def rows(
        self, index: IndexDef, tenants: Sequence[Tenant], marks: Mapping[str, int] | None = None
    ) -> DataFrame:
        df = query_rows(self.spark, index.query_for(None), self.args)
        name = find_column(df, self.tenant_column)
        if name is None:
            raise ValueError(f"tenant column {self.tenant_column!r} is not in the query result")
        if name != "tenant":
            df = df.withColumnRenamed(name, "tenant")
        df = filter_tenants(df, tenants)
        return df if marks is None else since_marks(df, index.modified_column, marks)


class PerTenant:
    """A source that reads each tenant on its own; all are united into one job."""

    def tenant_rows(self, index: IndexDef, tenant: Tenant) -> DataFrame:
        raise NotImplementedError

    def rows(
        self, index: IndexDef, tenants: Sequence[Tenant], marks: Mapping[str, int] | None = None
    ) -> DataFrame:
        parts = []
        for tenant in tenants:
            df = self.tenant_rows(index, tenant)
            mark = 0 if marks is None else marks[tenant.id]
            if mark and find_column(df, index.modified_column) is not None:
                df = modified_since(df, index.modified_column, mark)
            parts.append(df)
        return union_tenants(parts)


class TenantTables(PerTenant):
    """Separate tables per tenant under the same names.

    ``tables(tenant)`` returns the tenant's DataFrames by table name.  Each tenant's
    query text is analysed against its own views, then the results are united, so all
    tenants run in one job.
    """

    def __init__(self, spark: SparkSession, tables: Callable[[Tenant], Mapping[str, DataFrame]]):
        self.spark = spark
        self.tables = tables

    def tenant_rows(self, index: IndexDef, tenant: Tenant) -> DataFrame:
        views = self.tables(tenant)
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        try:
            rows = query_rows(self.spark, index.query_for(tenant.vendor))
        finally:
            for name in views:
                self.spark.catalog.dropTempView(name)
        return tag_tenant(rows, tenant.id)


def tag_tenant(df: DataFrame, tenant: str) -> DataFrame:
    """Add the tenant to every row."""
    return df.withColumn("tenant", F.lit(tenant))


def union_tenants(frames: Sequence[DataFrame]) -> DataFrame:
    """All tenants' rows in one DataFrame; absent columns become null."""
    if not frames:
        raise ValueError("no tenant to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
