"""Batches of documents as one JSON text each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.paging import global_row_number

#: Bytes of documents that an envelope may hold.
MAX_BYTES = 64 * 1024 * 1024


def _json(documents: Column) -> Column:
    return F.to_json(F.struct(documents.alias("results")), {"ignoreNullFields": "false"})


def results_envelopes(
    rows: DataFrame, key: str, batch_count: int, by: Sequence[str] = (), max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``{"results": [...]}`` per batch of at most ``batch_count`` consecutive rows.

    A batch holds rows of one value of the columns ``by`` only, such as the tenant, and these are
    columns of the result, not of the envelope.  Rows get their place from a ranged sort, and a
    group's first place is a minimum, so no group is gathered in one task.

    A batch whose documents come to more than ``max_bytes`` is cut into several envelopes, told apart
    by ``piece``.  None holds more, except for one document that is larger by itself; so what
    one task puts together is bounded whatever the width of the rows.
    """
    columns = [name for name in rows.columns if name not in by]
    order = [*(F.col(name).asc() for name in by), F.col(key).asc()]
    numbered = global_row_number(rows, order, "_row")
    if by:
        starts = numbered.groupBy(*by).agg(F.min("_row").alias("_first"))
        same = None
        for name in by:
            equal = F.col(name).eqNullSafe(F.col(f"_{name}"))
            same = equal if same is None else same & equal
        numbered = numbered.join(
            starts.withColumnsRenamed({name: f"_{name}" for name in by}), same
        ).drop(*(f"_{name}" for name in by))
    else:
        numbered = numbered.withColumn("_first", F.lit(1))
    batch = F.floor((F.col("_row") - F.col("_first")) / F.lit(batch_count)).cast("bigint")
    document = F.struct(*columns)
    sized = numbered.select(
        *by,
        batch.alias("batch_no"),
        "_row",
        document.alias("_doc"),
        F.octet_length(F.to_json(document, {"ignoreNullFields": "false"})).cast("bigint").alias("_bytes"),
    )
    # Documents that end in one half of the bound come to no more than the bound; larger ones stand alone.
    half = max(max_bytes // 2, 1)
    inside = Window.partitionBy(*by, "batch_no").orderBy("_row")
    large = F.col("_bytes") > half
    running = F.sum(F.when(large, 0).otherwise(F.col("_bytes"))).over(inside)
    slot = F.when(large, 0).otherwise(F.floor((running - 1) / half))
    alone = F.sum(F.when(large, 1).otherwise(0)).over(inside)
    placed = sized.withColumn("_slot", slot).withColumn("_alone", F.when(large, alone).otherwise(0))
    change = F.lag(F.struct("_slot", "_alone", F.lit(0))).over(inside)
    placed = placed.withColumn("_new", (F.struct("_slot", "_alone", F.lit(0)) != change).cast("int"))
    pieces = placed.withColumn("piece", F.coalesce(F.sum("_new").over(inside), F.lit(0)).cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct("_row", "_doc")))
    return (
        pieces.groupBy(*by, "batch_no", "piece")
        .agg(F.count(F.lit(1)).alias("records"), F.transform(ordered, lambda m: m["_doc"]).alias("_results"))
        .select(*by, "batch_no", "piece", "records", _json(F.col("_results")).alias("envelope"))
    )
