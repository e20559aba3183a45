"""Change events: parsing, classification, precedence and deduplication.

A change row has ``tenant_id, object_code, operation_type, object_id, event_time, seq``.
``event_time`` is epoch seconds; ``seq`` is the feed's own order (an offset or event
number) and may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.scalars import try_long
from docloom.workspace import broadcast_if_small, stage

# Operation texts of the feed, by what they ask for.
UPDATE_OPERATIONS = (
    "create",
    "update",
    "access_changed_instance",
    "access_changed_obs",
    "access_changed_group",
)
DELETE_OPERATIONS = ("delete",)
BULK_UPDATE_OPERATIONS = ("bulkupdate",)
BULK_DELETE_OPERATIONS = ("bulkdelete",)
DEPROVISION_OPERATIONS = ("slice_deprovision", "slicedeprovisioned")

UPDATE, DELETE = "update", "delete"
BULK_UPDATE, BULK_DELETE, DEPROVISION = "bulk_update", "bulk_delete", "deprovision"

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("object_code", T.StringType()),
        T.StructField("operation_type", T.StringType()),
        T.StructField("object_id", T.LongType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

# The id is read as text: feeds write it as a number or as a quoted number.
_MESSAGE = "tenant_id string, object_code string, operation_type string, object_id string"


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message JSON to change columns; ``event_time`` and ``seq`` come from the carrier.

    The text stays in ``message`` so that a row that cannot be used can be kept.
    """
    parsed = F.from_json(F.col(value).cast("string"), _MESSAGE)
    return messages.withColumn("_m", parsed).select(
        F.col("_m.tenant_id").alias("tenant_id"),
        F.col("_m.object_code").alias("object_code"),
        F.col("_m.operation_type").alias("operation_type"),
        try_long(F.col("_m.object_id")).alias("object_id"),
        F.col("event_time").cast("bigint").alias("event_time"),
        F.col("seq").cast("bigint").alias("seq"),
        F.col(value).cast("string").alias("message"),
    )


def action_of(operation: Column) -> Column:
    """What an operation asks for; null when it is unknown."""
    name = F.lower(F.trim(operation))
    return (
        F.when(name.isin(*UPDATE_OPERATIONS), UPDATE)
        .when(name.isin(*DELETE_OPERATIONS), DELETE)
        .when(name.isin(*BULK_UPDATE_OPERATIONS), BULK_UPDATE)
        .when(name.isin(*BULK_DELETE_OPERATIONS), BULK_DELETE)
        .when(name.isin(*DEPROVISION_OPERATIONS), DEPROVISION)
    )


def classify(changes: DataFrame) -> DataFrame:
    """Add ``tenant``, ``document_type`` (lower case), ``action`` and ``problem``.

    ``problem`` is null for a usable row; other rows belong in quarantine.
    """
    action = action_of(F.col("operation_type"))
    missing = F.col("tenant_id").isNull() | F.col("object_code").isNull()
    needs_id = F.col("action").isin(UPDATE, DELETE) & F.col("object_id").isNull()
    return (
        changes.withColumn("tenant", F.col("tenant_id"))
        .withColumn("document_type", F.lower(F.trim("object_code")))
        .withColumn("action", action)
        .withColumn(
            "problem",
            F.when(missing | F.col("operation_type").isNull(), "incomplete")
            .when(F.col("action").isNull(), "unknown operation")
            .when(needs_id, "no object id"),
        )
    )


def split_problems(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rows for quarantine)."""
    return (
        classified.where("problem IS NULL").drop("problem"),
        classified.where("problem IS NOT NULL"),
    )


def eligible_changes(changes: DataFrame, completed: DataFrame) -> DataFrame:
    """Changes whose tenant and type (ignoring case) have completed an index run."""
    keys = completed.select("tenant", F.lower("document_type").alias("document_type")).distinct()
    return changes.join(broadcast_if_small(keys), ["tenant", "document_type"], "left_semi")


def latest_change(
    changes: DataFrame, keys: tuple[str, ...] = ("tenant", "document_type", "object_id")
) -> DataFrame:
    """The latest change of each item.

    Ties go to the higher sequence number, then to a delete, then to the operation text.
    The rank keeps one row per item before the shuffle, so a busy item stays cheap.
    """
    is_delete = action_of(F.col("operation_type")) == DELETE
    newest = Window.partitionBy(*keys).orderBy(
        F.col("event_time").desc_nulls_last(),
        F.col("seq").desc_nulls_last(),
        F.coalesce(is_delete, F.lit(False)).desc(),
        F.col("operation_type").desc_nulls_last(),
    )
    return changes.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def bulk_flags(changes: DataFrame) -> DataFrame:
    """Per (tenant, type): any bulk update, bulk delete, deprovision."""
    return changes.groupBy("tenant", "document_type").agg(
        F.bool_or(F.col("action") == BULK_UPDATE).alias("bulk_update"),
        F.bool_or(F.col("action") == BULK_DELETE).alias("bulk_delete"),
        F.bool_or(F.col("action") == DEPROVISION).alias("deprovision"),
    )


def override_bulk(
    changes: DataFrame, flags: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply precedence: deprovision over bulk operations over item changes.

    Returns (item changes that still count, (tenant, type) to delete, tenants to remove).
    A bulk update asks for nothing: the next incremental run picks its rows up.
    """
    flags = stage(bulk_flags(changes), "flags") if flags is None else flags
    removed = flags.where("deprovision").select("tenant").distinct()
    bulk = flags.where("bulk_update OR bulk_delete")
    deleted = flags.where("bulk_delete").select("tenant", "document_type").join(
        removed, "tenant", "left_anti"
    )
    items = (
        changes.where(F.col("action").isin(UPDATE, DELETE))
        .join(broadcast_if_small(removed), "tenant", "left_anti")
        .join(
            broadcast_if_small(bulk.select("tenant", "document_type")),
            ["tenant", "document_type"],
            "left_anti",
        )
    )
    return items, deleted, removed


def split_update_delete(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changes to re-read from the source, changes to delete)."""
    return items.where(F.col("action") == UPDATE), items.where(F.col("action") == DELETE)


def max_event_time(changes: DataFrame) -> DataFrame:
    """High-water mark of the change log per tenant."""
    return changes.groupBy("tenant_id").agg(F.max("event_time").alias("max_event_time"))


def changes_by_type(changes: DataFrame) -> DataFrame:
    """Number of changes per tenant and object code."""
    return changes.groupBy("tenant_id", "object_code").agg(F.count(F.lit(1)).alias("changes"))


def change_log(changes: DataFrame, tenant: str) -> DataFrame:
    """Pending changes of one tenant, in display order."""
    return changes.where(F.col("tenant_id") == tenant).orderBy(*log_order())


def log_order() -> list[Column]:
    return [F.col("object_id").desc(), F.col("object_code").asc(), F.col("event_time").asc()]


def purge(log: DataFrame, read: DataFrame) -> DataFrame:
    """The log without exactly the rows that were read."""
    names = CHANGE_SCHEMA.names
    seen = read.select(*[F.col(name).alias(f"_{name}") for name in names]).distinct()
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return log.join(seen, condition, "left_anti")
