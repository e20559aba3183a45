"""Query rows to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import convert, keys
from docloom.model import IndexDef


def to_documents(rows: DataFrame, index: IndexDef) -> DataFrame:
    """Documents of query rows that carry a ``tenant`` column.

    Result: ``tenant, doc_id, parent_key, source, changed_at, changed_seq, deleted, doc,
    from_run``.  Everything is a projection; rows keep their partitioning.  Columns
    ``_changed_at`` and ``_changed_seq``, if present, are the event behind the row.
    """
    rows = convert.lowercase_columns(rows)
    id_column = keys.find_column(rows, index.id_column)
    if id_column is None:
        raise ValueError(f"id column {index.id_column!r} is not in the query result")
    event = [name for name in ("_changed_at", "_changed_seq") if name in rows.columns]
    mapping = {name.lower(): spec for name, spec in index.mapping.items()}
    key = keys.doc_id(F.col("tenant"), index.document_type, F.col(id_column))
    if index.parent is None:
        parent = F.lit(None).cast("string")
    else:
        column = keys.find_column(rows, index.parent.column)
        if column is None:
            raise ValueError(f"parent column {index.parent.column!r} is not in the query result")
        parent = keys.parent_key(F.col("tenant"), index.parent.parent_type, F.col(column))
    rows = rows.withColumns({"_doc_id": key, "_parent": parent})
    shaped = convert.apply_epoch_fields(convert.apply_mappers(rows, index.mappers), mapping)
    hidden = {"_doc_id", "_parent", *event}
    visible = [F.col(name) for name in shaped.columns if name not in hidden]
    schema = convert.document_schema(index.mapping, index.mappers)
    typed = convert.typed_fields(shaped, schema)
    empty = F.lit(None).cast("bigint")
    return shaped.select(
        "tenant",
        F.col("_doc_id").alias("doc_id"),
        F.col("_parent").alias("parent_key"),
        convert.row_json(visible).alias("source"),
        (F.col("_changed_at") if event else empty).alias("changed_at"),
        (F.col("_changed_seq") if event else empty).alias("changed_seq"),
        F.lit(False).alias("deleted"),
        F.struct(*typed).alias("doc"),
        F.lit(not event).alias("from_run"),
    )
